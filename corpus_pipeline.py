"""From raw documents to token ids: quality rules, near-dedup, benchmark decontamination, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet and hands the next stage what it reads back. Rows are told apart by two hashes
of 64 bits over their key, text and language, each with its null marks, so repeated and
null ids do no harm; all stages but the last pass the documents' columns through
unchanged, whatever else they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import bottom_k, decontaminate, pieces, quality
from marketlake.llm.common import stored, table
from marketlake.llm.queries import tokenizer


def hashes(columns: list[Column]) -> tuple[Column, Column]:
    """Two hashes of a row."""
    return F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *columns)


def tagged(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of the row's id, text and language, under a name that no column has.

    The number is the first hash; rows that share it but not the second one (a few pairs
    in 10**11 rows) are found by one aggregate over all rows and take the second.
    """
    name = "_row"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    columns = [F.col(c) if c in docs.columns else F.lit(None).cast("string") for c in ("doc_id", "text", "lang")]
    marked = [x for c in columns for x in (c.isNull(), c)]
    first, second = hashes(marked)
    same = docs.select(first.alias(name), second.alias("b")).groupBy(name).agg(F.min("b").alias("lo"), F.max("b").alias("hi"))
    clashes = stored(same.where("lo <> hi").select(name), "clashes")
    rows = docs.withColumn(name, first)
    if clashes.isEmpty():
        return rows, name
    hit = f"{name}hit"
    rows = rows.join(clashes.withColumn(hit, F.lit(True)), name, "left")
    return rows.withColumn(name, F.when(F.col(hit), second).otherwise(F.col(name))).drop(hit), name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's perplexity bands. Null and empty texts fail; no documents, none kept."""
    rows, row = tagged(docs)
    verdict = quality.quality(rows.select(F.col(row).alias("doc_id"), "text", "lang"))
    return rows.join(verdict.where("kept").select(F.col("doc_id").alias(row)), row, "left_semi").select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), the one with the smallest id; repeated rows once.

    A null id comes after all others; documents without words are no copies of each other, but equal rows are.
    """
    rows, row = tagged(docs)
    verdict = bottom_k.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), n=5, percent=80)
    groups = verdict.select(F.col("doc_id").alias(row), F.col("component_id").alias("_c")).distinct()
    heads = rows.select(row, "doc_id").distinct().join(groups, row)
    first = heads.groupBy("_c").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))[row].alias("_first"))
    gone = groups.join(first, "_c").where(F.col(row) != F.col("_first")).select(row)
    return rows.join(gone, row, "left_anti").dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: fewer than one word in twenty inside a window of an item. Null and empty texts stay."""
    rows, row = tagged(docs)
    hits = decontaminate.find_hits(rows.select(row, "text"), table(spark, sf_dir, "benchmark"), key=row)
    return rows.join(hits.where("contaminated").select(row), row, "left_anti").select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document with an end id (null text: that alone), and whether they decode to its text. Other columns than doc_id, lang and source go."""
    out = pieces.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer("piece_bpe_32k.model"), same="round_trip")
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontaminate_stage),
    ("sentencepiece", encode_stage),
]

#: The perplexity model and the tokenizer are beyond SQL; tests hold the last three stages against plain versions, the first against op5.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
