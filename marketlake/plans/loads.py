"""Load plans: landed text to typed, unique rows to the table, then the control table from what was committed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.merge import insert_only, latest, merge_upsert, stamp
from marketlake.operators.watermarks import advance_success
from marketlake.sources.landing import required, typed
from marketlake.specs import SPECS


def prepare(staged: DataFrame, source: str, *recency: str) -> DataFrame:
    """Typed rows with every required field, one for each key: the most recent, or the largest where no recency is given."""
    spec = SPECS[source]
    rows = required(typed(staged, spec), spec)
    if "close" in rows.columns:
        rows = rows.where(F.col("close") > 0)
    names = [f"_key_{i}" for i in range(len(spec.keys))]
    rows = rows.withColumns({n: F.expr(k) for n, k in zip(names, spec.keys, strict=True)})
    return latest(rows, names, *(recency or rows.columns[: -len(names)])).drop(*names)


def load(target: DataFrame, staged: DataFrame, source: str, *recency: str, as_of: Column | None = None) -> DataFrame:
    """The target's new content after one batch, merged as the source's specification says."""
    spec = SPECS[source]
    rows = prepare(staged, source, *recency)
    if as_of is not None:
        rows = stamp(rows, as_of)
    rows = rows.select(*target.columns)
    if spec.merge == "replace":
        return rows
    keys = {k: F.expr(k) for k in spec.keys}
    # Stored rows take far less on disk than in memory, so their size is underrated; the batch's keys meet the table's by shuffle and not in the driver.
    return insert_only(target, rows, keys) if spec.merge == "insert_only" else merge_upsert(target, rows.hint("merge"), spec.keys)


def advance(wm: DataFrame, source: str, committed: DataFrame, date: str, now: Column) -> DataFrame:
    """The control table moved by rows of a committed version, never by what was only fetched."""
    spans = committed.groupBy("symbol").agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    return advance_success(wm, source, spans, now)
