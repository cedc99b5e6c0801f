"""Small helpers that several operators share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z only: ``lower`` would also touch other letters."""
    return F.translate(c, UPPER, UPPER.lower())


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder that the driver and all executors see, under ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset and Spark runs in one
    process (tests, a laptop) a temporary folder takes its place for the rest of the
    application; on a cluster that raises ValueError.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            root = current
        else:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
            root = tempfile.mkdtemp(prefix="spark-checkpoint-")
            spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def mounted(path: str) -> str:
    """The folder as a plain path, for files that tasks map into memory."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"a mounted spark.checkpoint.dir is needed to map model files into memory, not {path}")
    os.makedirs(url.path, exist_ok=True)
    return url.path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage and outlives executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of text, one row at least: bounds what a task holds at once."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, done + size, "right")))
            yield batch.slice(start, end - start)
            start = end


def word_codes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\x20\x09-\x0D]+`` of the texts (null: none): their numbers, where each text's begin (and the end), and the distinct words."""
    texts = pc.fill_null(texts, "")
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = cut.flatten().dictionary_encode()
    codes, at = coded.indices.to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype=np.int64)])
    none = pc.index(coded.dictionary, "").as_py()
    if none < 0:
        return codes, at, coded.dictionary
    # Whitespace at either end of a text leaves an empty piece there.
    keep = codes != none
    codes, at = codes[keep], np.concatenate([[0], np.cumsum(keep)])[at]
    return codes - (codes > none), at, pa.concat_arrays([coded.dictionary[:none], coded.dictionary[none + 1 :]])
