"""Keyed upserts as joins. Parquet has no MERGE, so each function returns the table's new content.

Keys match null-safely by default: two rows whose key part is null in both are the
same row. A source is always made unique on its key first, or one batch could
insert a key twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Sequence[str], *recency: Column) -> DataFrame:
    """The first row of each key in the given order (which should be total)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*recency))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest(df: DataFrame, keys: Sequence[str], *recency: str) -> DataFrame:
    """The row of each key with the largest recency. Partial aggregation shrinks large batches before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    whole = not set(rest) - set(recency)  # then the recency holds the row, which needn't travel twice
    best = F.max(F.struct(*recency)) if whole else F.max_by(F.struct(*rest), F.struct(*recency))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)


def first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row of each key that comes first in ascending order, nulls last.

    Tasks keep one row a key before the shuffle, so a key that a third of all rows share (a null one, say) costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(*(x for c in order for x in (F.col(c).isNull(), F.col(c))))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), place).alias("_row"))
    return best.select(*keys, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)


def matches(keys: Sequence[str], null_safe: bool = True) -> Column:
    """Rows aliased ``t`` and ``s`` have the same key."""
    same = [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) if null_safe else F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys]
    return reduce(lambda a, b: a & b, same)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Matched rows are replaced, others inserted. ``source`` is unique on its keys."""
    kept = target.alias("t").join(source.select(*keys).alias("s"), matches(keys, null_safe), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def merge_partial(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Matched rows take only the columns of ``update`` from the source; others are inserted whole."""
    t, s = target.withColumn("_in_t", F.lit(True)).alias("t"), source.select(*target.columns).withColumn("_in_s", F.lit(True)).alias("s")
    both = t.join(s, matches(keys), "full_outer")
    new = lambda c: F.col("_in_t").isNull() | (F.col("_in_s").isNotNull() & F.lit(c in update))
    pick = lambda c: F.when(new(c), F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c)
    return both.select(*(pick(c) for c in target.columns))


def insert_only(target: DataFrame, source: DataFrame, keys: Mapping[str, Column] | Sequence[str], null_safe: bool = True) -> DataFrame:
    """Rows of the source whose key isn't in the target are appended; keys may be expressions by name."""
    if not isinstance(keys, Mapping):
        keys = {k: F.col(k) for k in keys}
    names = [f"_key_{i}" for i in range(len(keys))]
    s = first(source.withColumns(dict(zip(names, keys.values(), strict=True))), names, *source.columns)
    t = target.select(*(e.alias(n) for n, e in zip(names, keys.values(), strict=True)))
    new = s.alias("t").join(t.alias("s"), matches(names, null_safe), "left_anti").select(*target.columns)
    return target.unionByName(new)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], changes: Mapping[str, Column]) -> DataFrame:
    """Changes rows that the source matches. Expressions see the target's columns as ``t.x`` and the source's as ``s.x``.

    The match is told by a flag of its own and not by a column that may be null.
    """
    t, s = target.alias("t"), source.withColumn("_hit", F.lit(True)).alias("s")
    same = reduce(lambda a, b: a & b, (F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys))
    pick = lambda c: F.when(F.col("s._hit"), changes[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in changes else F.col(f"t.{c}").alias(c)
    return t.join(s, same, "left").select(*(pick(c) for c in target.columns))


def update_where(df: DataFrame, predicate: Column, changes: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(predicate, F.lit(False))
    return df.select(*(F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in df.columns))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is null stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def preferred_file(df: DataFrame, key: str, file: str, preferred: str) -> DataFrame:
    """Rows of one file a key: the smallest that holds ``preferred``, else the smallest."""
    best = df.groupBy(key).agg(F.coalesce(F.min(F.when(F.col(file).contains(preferred), F.col(file))), F.min(file)).alias(file))
    return df.join(best, [key, file], "left_semi")


def stamp(df: DataFrame, as_of: Column, symbol: str = "symbol") -> DataFrame:
    """The standard metadata columns: the symbol's number and the load date."""
    from marketlake.functions import scalar

    return df.withColumns({"symbol_id": scalar.symbol_id(F.col(symbol)), "load_date": as_of})
