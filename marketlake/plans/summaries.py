"""Aggregates of a stored table, kept by partition and recomputed only where it changed.

A partition's folder never changes: a new version of the partition is a new folder.
So its summary (one row a key: counts, sums, smallest and largest values) is written
once, into the folder itself, under a name that readers of rows pass over, and goes
when the folder goes. ``summary`` computes what is missing in one job over the new
folders alone, then merges the rows of all current folders by key. Reports over a
large table that takes small upserts read the small tables instead.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.plans.store import Conflict, TableStore

#: How a measure is taken from rows and merged from summaries (column ``*`` counts rows).
MEASURES = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def _names(store: TableStore, name: str, path: str) -> tuple[str, str]:
    """A folder's path below the table, and how Spark's file names spell it."""
    own = path.removeprefix(f"{store.root}/{name}/")
    return own, store._path(name, own).toUri().toString().rsplit(f"/{name}/", 1)[1]


def _measures(measures: Mapping[str, tuple[str, str]], merged: bool) -> list[Column]:
    return [MEASURES[kind][merged](F.col(out) if merged else F.lit(1) if c == "*" else F.col(c)).alias(out) for out, (kind, c) in measures.items()]


def refresh(store: TableStore, name: str, label: str, keys: Sequence[str], measures: Mapping[str, tuple[str, str]]) -> list[str]:
    """Writes the missing summaries of the current folders; returns these folders (below the table)."""
    fs = store._fs()
    new = {}
    for path in store._parts(name).values():
        own, spelt = _names(store, name, path)
        if not fs.exists(store._path(name, own, f"_summary_{label}")):
            new[spelt] = own
    if not new:
        return []
    rows = store.spark.read.parquet(*(f"{store.root}/{name}/{own}" for own in new.values()))
    folder = F.regexp_extract(F.col("_metadata.file_path"), f"/{re.escape(name)}/([0-9a-f]{{32}}(?:/_part=[^/]*)?)/[^/]*$", 1)
    numbers = store.spark.createDataFrame(list(enumerate(new)), "_folder int, _spelt string")
    sums = rows.withColumn("_spelt", folder).groupBy("_spelt", *keys).agg(*_measures(measures, False)).join(numbers, "_spelt").drop("_spelt")
    made = f"_made/{uuid.uuid4().hex}"
    # The keys again as the sort order: one file a folder, and pruning by key.
    sums.repartition("_folder", *keys).write.partitionBy("_folder").parquet(f"{store.root}/{name}/{made}")
    there = store._folders(name, made)
    for i, own in enumerate(new.values()):
        source = f"{name}/{made}/_folder={i}"
        if f"_folder={i}" not in there:  # a folder without rows
            sums.where("false").drop("_folder").write.parquet(f"{store.root}/{source}")
        try:
            store._rename(source, f"{name}/{own}/_summary_{label}")
        except Conflict:
            pass  # another job has written the same
    fs.delete(store._path(name, made), True)
    return list(new.values())


def summary(store: TableStore, name: str, label: str, keys: Sequence[str], measures: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row a key with the measures over the table's current rows; only folders without a summary are read.

    measures: output name -> (count, sum, min or max; column). A label stands for one set of keys and measures.
    """
    refresh(store, name, label, keys, measures)
    paths = [f"{p}/_summary_{label}" for p in store._parts(name).values()]
    return store.spark.read.parquet(*paths).groupBy(*keys).agg(*_measures(measures, True))
