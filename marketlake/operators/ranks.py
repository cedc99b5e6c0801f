"""Places in an order, and short lists, where a few groups hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.merge import matches
from marketlake.plans.scratch import scratch


def place_within(df: DataFrame, group: str, *order: Column | str, place: str = "place") -> DataFrame:
    """``df`` with each row's place (from 1) in its group, in the given order, which should be total.

    A window over the group would sort it in one task, however large it is. Here rows are
    dealt out by ranges of (group, order), so a group takes as many tasks as it needs; each
    task knows its rows' places among its own, and what the group has in earlier tasks
    comes from one count a task and group. The sorted rows are written to the shared
    folder first, because both readings must see the same ranges. Null is a group too.
    """
    spark = df.sparkSession
    rows = df.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    path = scratch(spark, "places")
    rows.withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).write.parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.groupBy("_task", F.col(group).alias("_group")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_group").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    out = rows.alias("r").join(offsets.alias("o"), (F.col("r._task") == F.col("o._task")) & F.col(f"r.{group}").eqNullSafe(F.col("o._group")))
    return out.select(*(F.col(f"r.`{c}`") for c in df.columns), (F.col("r._at") - F.col("_first") + F.col("_before") + 1).alias(place))


def listed(rows: DataFrame, group: Sequence[str], value: str, most: int, between: str, name: str) -> DataFrame:
    """The first ``most`` of each group's distinct values as text, and how many more there are: one bounded row a group.

    Values are counted apart before they meet; of each group a task passes on no more rows than the list takes.
    """
    values = rows.select(*group, value).where(F.col(value).isNotNull()).distinct()
    total = values.groupBy(*group).agg(F.count("*").alias("_n"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(value))
    some = values.withColumn("_rank", rank).where(F.col("_rank") <= most).groupBy(*group).agg(F.array_sort(F.collect_list(value)).alias("_list"))
    more = F.when(F.col("_n") > most, F.concat(F.lit(f"{between}+"), F.col("_n") - most)).otherwise("")
    both = total.alias("t").join(some.alias("s"), matches(group))
    return both.select(*(F.col(f"t.`{c}`") for c in group), F.concat(F.array_join("_list", between), more).alias(name))
