"""Landed files into a table, each file once.

The stream's checkpoint remembers files; every micro-batch is made unique and
upserted by key. A batch that is run again after a failure gives the same table,
so late and repeated rows need no state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlake.plans.store import TableStore
from marketlake.sources import landing

#: What the stream knows of a file; its content isn't read by the stream.
FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def ingest(
    spark: SparkSession, path: str, columns: Sequence[str], store: TableStore, table: str, keys: Sequence[str], checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame], files_per_batch: int = 1000, partition: str | None = None,
) -> None:
    """Takes all files that are new since the last call, then returns. ``prepare`` types a batch and makes it unique on the keys.

    The stream is one of files; each batch reads its own (``files_per_batch`` at most) with their headers, so columns bind by name.
    """

    def merge(batch: DataFrame, _: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]
        if paths:
            store.upsert(table, prepare(landing.read_csv(spark, paths, columns, glob="*")), keys, partition)

    rows = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_per_batch).load(path).select("path")
    rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
