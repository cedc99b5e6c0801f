"""A folder that the driver and all executors see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Where that is unset and Spark runs in one process (tests, a laptop) it is under a temporary one; on a cluster that raises ValueError.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        root = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in a new folder: worked out once, however often and by however many columns it is read."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
