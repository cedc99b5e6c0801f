"""URL filters: explicit rules, and for the rest a logistic regression on hashed character n-grams.

The labelled table is small: addresses that a rule judges carry the rule's verdict,
and of them the ``train_rows`` of either verdict that come first by a hash of the
address are taken. Features are n-grams of host and path, hashed to a fixed number
of columns; training and judging are Spark ML and stay in the JVM.

Defined results: an address that is null or has no ``://`` has an empty host and
path, which no rule fits; where labels have only one verdict it is everyone's, and
without labels all are allowed. Repeated rows are judged alike. Other columns stay,
whatever their names, but for those of the result, which take their place.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, lower_ascii


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of an address."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def by_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def ngrams(host: Column, path: Column, sizes: Sequence[int] = (3, 4)) -> Column:
    """Character n-grams of the marked host and path; equal n-grams of the two differ."""

    def of(part: Column, mark: str) -> list[Column]:
        text = F.concat(F.lit("^"), part, F.lit("$"))
        return [
            F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(text) - n + 1, F.lit(1))), lambda i, n=n: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))
            for n in sizes
        ]

    return F.concat(*of(host, "h:"), *of(path, "p:"))


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", train_rows: int = 5_000, columns: int = 1 << 14) -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_probability (null where a rule decides)."""
    host, path = split_url(F.col(url).cast("string"))
    label, grams, features, y, p, block, raw = free_names(pages, "_label", "_grams", "_features", "_y", "_p", "_block", "_raw")
    rows = pages.withColumns({"host": host, "path": path})
    name, verdict = by_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, label: verdict})
    hashed = HashingTF(numFeatures=columns, binary=True, inputCol=grams, outputCol=features)
    labelled = rows.where(F.col(label).isNotNull()).select("host", "path", label).distinct()
    picked = [labelled.where(F.col(label) == v).orderBy(F.xxhash64("host", "path"), "host", "path").limit(train_rows) for v in ("allow", "block")]
    small = hashed.transform(picked[0].unionByName(picked[1]).withColumn(grams, ngrams(F.col("host"), F.col("path"))))
    small = small.select(features, (F.col(label) == "block").cast("double").alias(y)).cache()
    try:
        n = {r[y]: r["count"] for r in small.groupBy(y).count().collect()}
        if len(n) == 2:
            model = LogisticRegression(featuresCol=features, labelCol=y, regParam=0.01, maxIter=30, probabilityCol=p, predictionCol=block, rawPredictionCol=raw).fit(small)
    finally:
        small.unpersist()
    if len(n) < 2:
        only = F.lit("block" if 1.0 in n else "allow")
        return rows.withColumns({"verdict": F.coalesce(label, only), "block_probability": F.lit(None).cast("double")}).drop(label)
    from pyspark.ml.functions import vector_to_array

    out = model.transform(hashed.transform(rows.withColumn(grams, ngrams(F.col("host"), F.col("path")))))
    likely = F.when(F.col(label).isNull(), vector_to_array(p)[1])
    ruled = F.coalesce(label, F.when(F.col(block) == 1.0, F.lit("block")).otherwise(F.lit("allow")))
    return out.withColumns({"verdict": ruled, "block_probability": likely}).drop(label, grams, features, raw, p, block)
