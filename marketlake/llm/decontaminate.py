r"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window is 13 consecutive words of an item (a shorter item is one window). To
occur in a document, all of a window's words must; so the prefix that has to be
joined is one word, and the rarest one in the documents is taken. Words of the
benchmark are counted over all documents first. A document's words are joined with
the windows' rarest words; position and lengths bound the place where the window
would have to lie; the words there are then compared exactly. (Words are joined by
their hashes; the comparison makes that exact.)

The documents are cut into words twice: for the counts, and for the join. Where the
windows' table is small (``BROADCAST_BYTES``, measured, not guessed) it is broadcast and
the words of a place are compared where the join meets them, so no text moves. A larger
table is joined by shuffles of single words, and the texts of documents with candidates
are joined back. Both ways give the same rows.

Defined results: null or empty texts have no words and no windows; a document
without words is not contaminated; repeated rows of either table change nothing
else; an item without an id counts for hits but isn't listed; columns other than
those named don't matter. Items found are kept by document, so their list and
the candidates' are bounded by the document's own length and the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

#: Everything that is not a digit, an ASCII letter or beyond ASCII.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
BROADCAST_BYTES = 32 << 20


def pieces(text: Column) -> Column:
    """A text cut at breaks, letters as they are; the first and last piece may be empty."""
    return F.split(F.coalesce(text, F.lit("")), BREAK)


def lowered(word: Column) -> Column:
    """A-Z in lower case. ``lower`` is the faster way to it for text that is all ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(lower_ascii(word))


def word_hash(word: Column) -> Column:
    return F.xxhash64(lowered(word))


def word_count(cut: Column) -> Column:
    """Number of words of a cut text."""
    return F.greatest(F.size(cut) - (cut[0] == "").cast("int") - (F.element_at(cut, -1) == "").cast("int"), F.lit(0)).cast("long")


def small(df: DataFrame) -> bool:
    """Whether a stored table may be broadcast, by the bytes of its rows."""
    n = df.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    return (n or 0) <= BROADCAST_BYTES


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows: ``window`` (a hash), its words ``_w`` and the ``_items`` that hold it."""
    words = F.filter(F.transform(pieces(F.col(text)), lowered), lambda w: w != "")
    rows = benchmark.select(F.col(item).cast("string").alias("_item"), words.alias("_all")).where(F.size("_all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_all") - size + 1, F.lit(1)))
    rows = rows.select("_item", F.explode(F.transform(starts, lambda i: F.slice("_all", i, size))).alias("_w"))
    grouped = rows.groupBy("_w").agg(F.collect_set("_item").alias("_items"))
    return grouped.select(F.xxhash64("_w").alias("window"), "_w", "_items")


def rarest_words(found: DataFrame, each: DataFrame) -> DataFrame:
    """The windows with ``_h``, the hash of the one of their words that the fewest places of the documents hold, and its ``_offset``.

    Windows with a word that no document holds are left out.
    """
    vocabulary = stored(found.select(F.explode("_w").alias("_word")).select(word_hash(F.col("_word")).alias("_h")).distinct(), "vocabulary")
    vocabulary = F.broadcast(vocabulary) if small(vocabulary) else vocabulary
    # Exploding positions, not words, keeps the cut text in place and costs less than half.
    counts = each.select("_all", F.explode(F.sequence(F.lit(0), F.size("_all") - 1)).alias("_pos")).select(word_hash(F.get("_all", F.col("_pos"))).alias("_h"))
    counts = counts.join(vocabulary, "_h").groupBy("_h").agg(F.count("*").alias("_n"))
    placed = found.select("window", F.posexplode("_w").alias("_offset", "_word")).select("window", "_offset", word_hash(F.col("_word")).alias("_h"))
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_h").alias("h"), F.col("_offset").alias("offset")))
    prefix = placed.join(counts, "_h", "left").groupBy("window").agg(rarest.alias("_p")).where("_p.n > 0")
    return found.join(prefix, "window").select("window", "_w", "_items", F.col("_p.h").alias("_h"), F.col("_p.offset").alias("_offset"))


def occurs(cut: Column) -> Column:
    """Whether the window ``_w`` lies in a cut text so that its word ``_offset`` is at ``_pos``."""
    start = F.col("_pos") - F.col("_offset")
    inside = (start >= 0) & (start + F.size("_w") <= F.size(cut))
    there = lowered(F.array_join(F.slice(cut, start + 1, F.size("_w")), " "))
    return inside & (there == F.array_join("_w", " "))


def find_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row a document: key, n_words, n_hit, items (sorted as strings), contaminated (n_hit > 0 and 20 * n_hit >= n_words)."""
    found = stored(windows(benchmark, size=size), "windows")
    # A document is known by two hashes of its key and text: keys may be null or repeated.
    each = docs.select(F.col(key).alias("_key"), F.xxhash64(key, text).alias("_k1"), F.hash(text, key).alias("_k2"), pieces(F.col(text)).alias("_all"))
    prefix = stored(rarest_words(found, each), "prefix")

    # A row for each place where a window occurs, and one for the document itself, which has no word.
    spread = each.select("_key", "_k1", "_k2", word_count(F.col("_all")).alias("n_words"), "_all", F.explode(F.sequence(F.lit(-1), F.size("_all") - 1)).alias("_pos"))
    word = F.when(F.col("_pos") >= 0, word_hash(F.get("_all", F.col("_pos"))))
    start = (F.col("_pos") - F.col("_offset")).alias("_start")
    if small(prefix):
        same = (word == F.col("_h")) & occurs(F.col("_all"))
        rows = spread.join(F.broadcast(prefix), same, "left").where("_pos < 0 OR window IS NOT NULL")
        rows = stored(rows.select("_key", "_k1", "_k2", "n_words", "_pos", start, F.size("_w").alias("_len"), "_items"), "places")
        base, hits = rows.where("_pos < 0"), rows.where("_pos >= 0")
    else:
        places = spread.where("_pos >= 0").select("_k1", "_k2", "_pos", word.alias("_h"))
        places = places.join(prefix.select("window", "_h", "_offset"), "_h").select("_k1", "_k2", "window", "_pos", "_offset").distinct()
        texts = each.select("_k1", "_k2", "_all").dropDuplicates(["_k1", "_k2"])
        places = places.join(prefix.select("window", "_w", "_items"), "window").join(texts, ["_k1", "_k2"])
        hits = places.where(occurs(F.col("_all"))).select("_k1", "_k2", start, F.size("_w").alias("_len"), "_items")
        base = each.withColumn("n_words", word_count(F.col("_all")))
    places = F.collect_set(F.struct(F.col("_start").alias("start"), F.col("_len").alias("len"))).alias("_at")
    hits = hits.groupBy("_k1", "_k2").agg(places, F.collect_set("_items").alias("_items"))
    hit = F.array_distinct(F.flatten(F.transform("_at", lambda c: F.sequence(c["start"], c["start"] + c["len"] - 1))))
    hits = hits.select("_k1", "_k2", F.size(hit).cast("long").alias("_hit"), F.array_sort(F.array_distinct(F.flatten("_items"))).alias("_found"))
    n_hit = F.coalesce("_hit", F.lit(0).cast("long"))
    return base.select("_key", "_k1", "_k2", "n_words").join(hits, ["_k1", "_k2"], "left").select(
        F.col("_key").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("_found", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
