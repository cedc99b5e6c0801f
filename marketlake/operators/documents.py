"""Semi-structured documents: fields, nested arrays as rows, flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fields(df: DataFrame, text: str, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Columns by (path, type) from a JSON text; a path that is missing, or a value of another type, is null."""
    v = F.try_parse_json(text)
    return df.select("*", *(F.try_variant_get(v, p, t).alias(c) for c, (p, t) in wanted.items()))


def etf_profiles(parts: DataFrame) -> DataFrame:
    """One row a fund with arrays of sectors and holdings, from (symbol, sector, holding, description, weight)."""
    sectors = parts.groupBy("symbol", "sector").agg(F.sum("weight").alias("weight"))
    s = sectors.groupBy("symbol").agg(F.collect_list(F.struct("sector", "weight")).alias("sectors"))
    h = parts.groupBy("symbol").agg(F.collect_list(F.struct(F.col("holding").alias("symbol"), "description", "weight")).alias("holdings"))
    return s.join(h, "symbol", "left")


def sectors(profiles: DataFrame) -> DataFrame:
    return profiles.select("symbol", F.explode("sectors").alias("s")).select("symbol", "s.sector", "s.weight")


def holdings(profiles: DataFrame) -> DataFrame:
    return profiles.select("symbol", F.explode("holdings").alias("h")).select("symbol", F.col("h.symbol").alias("holding"), "h.description", "h.weight")


def etf_detail(profiles: DataFrame) -> DataFrame:
    """Sectors and holdings in one table; columns that a kind lacks are null."""
    return sectors(profiles).withColumn("detail_type", F.lit("SECTOR")).unionByName(holdings(profiles).withColumn("detail_type", F.lit("HOLDING")), allowMissingColumns=True)


def transcripts(docs: DataFrame, text: str) -> DataFrame:
    """Segments of transcripts {symbol, quarter, transcript: [{speaker, content}]}; no segments, no rows."""
    v = F.try_parse_json(text)
    struct = "array<struct<speaker:string,turn:int,content:string>>"
    rows = docs.select(F.try_variant_get(v, "$.symbol", "string").alias("symbol"), F.try_variant_get(v, "$.quarter", "string").alias("quarter"), F.explode(F.try_variant_get(v, "$.transcript", struct)).alias("t"))
    return rows.select("symbol", "quarter", "t.speaker", "t.turn", "t.content")


def delisted(df: DataFrame, text: str) -> DataFrame:
    """``delisted``: the document says so by its status or by a flag."""
    v = F.try_parse_json(text)
    flag = (F.lower(F.try_variant_get(v, "$.status", "string")) == "delisted") | F.try_variant_get(v, "$.delisted", "boolean")
    return df.withColumn("delisted", F.coalesce(flag, F.lit(False)))
