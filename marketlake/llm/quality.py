r"""Quality rules: base rules over words and lines, then bands of n-gram perplexity.

The model is a modified Kneser-Ney model of character n-grams inside words, one for
each language, keyed by the language itself. Characters are real ones (code points,
case kept), whatever the script. Spark counts the n-grams over all documents that
pass the base rules: tasks count the words of their rows and emit n-grams with counts,
``groupBy`` adds them up. An n-gram of up to four characters is packed into two longs of
21 bits a character, which is exact. Smoothing is joins and aggregates of Spark, order
by order; no step holds a language's model in one task. Probabilities and back-off
weights end as sorted arrays of 64-bit hashes (of language, order and n-gram) with
values, in files of about ``SHARD`` entries that tasks write into the shared folder and
scoring tasks map into memory and search by bisection. Two entries of all share a hash
with a probability of about ``entries ** 2 / 2 ** 65``.

A document's perplexity is its words' probability by letter, digit and word end; marks
add to the exponent but not to the length, so text strewn with them stands out. Bands: of each language's
documents that pass the base rules, the lower quartile of log perplexity less ``width``
times its distance from the median, and the upper quartile likewise; no constant
of all languages sets a limit. A document outside its language's band is rejected. Short texts scatter more, so the
distance from the median allowed grows as ``1 + SHORT / n_symbols``.

Defined results: a null or empty text has no words and fails the base rules; a
null language is one of its own; repeated rows count as often as they occur; where
no document passes the base rules there are no bands and nothing else is rejected.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mounted, shared_dir, slices, stored, word_codes

ORDER = 4
SHORT = 60.0
SYMBOLS = b"#*$%&|<>"
KEPT_WORDS = 300_000
SALT, FEW_LANGUAGES = 1024, 10_000
CHAR, SHARD = 21, 2_000_000
START_CHAR, END_CHAR = "\t", "\n"  # no word holds these


#: Bytes that are neither letters nor digits of ASCII nor part of another character.
MARKS = bytes(b for b in range(128) if not chr(b).isalnum())


def repeated_words(ids: np.ndarray, n: int = 8) -> int:
    """Words inside n-word windows (n: a power of 2) that occur twice or more, the first included; exact."""
    w = len(ids)
    if w <= n:
        return 0
    # A hash of each window first: most texts have no equal pair at all.
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    h = np.zeros(w - n + 1, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x100000001B3) + mixed[i : w - n + 1 + i]
    h.sort()
    if not (h[1:] == h[:-1]).any():
        return 0
    name, span = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while span < n:  # names of windows of twice the length: pairs of names
        pair = name[:-span] * (int(name.max()) + 1) + name[span:]
        name, span = np.unique(pair, return_inverse=True)[1].astype(np.int64), 2 * span
    twice = np.flatnonzero(np.bincount(name)[name] > 1)
    cover = np.zeros(w + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + n, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


class Reader:
    """Base features of texts. Words are kept as numbers, by task."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.chars = np.zeros(0, np.int64)
        self.emptied = 0

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct words."""
        chars, words = pc.utf8_length(words).to_numpy(zero_copy_only=False), words.cast(pa.binary()).to_pylist()
        new = np.fromiter((w not in self.ids for w in words), bool, len(words))
        if len(self.ids) + int(new.sum()) > KEPT_WORDS:
            self.ids, self.words, self.chars, new = {}, [], np.zeros(0, np.int64), np.ones(len(words), bool)
            self.emptied += 1
        more = [words[i] for i in np.flatnonzero(new).tolist()]
        self.ids.update(zip(more, range(len(self.words), len(self.words) + len(more)), strict=True))
        self.words += more
        self.chars = np.concatenate([self.chars, chars[new]])
        return np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))

    def base(self, texts: pa.Array) -> tuple[dict[str, np.ndarray], list[np.ndarray]]:
        codes, at, words = word_codes(texts, lower=False)
        flat = self.numbers(words)[codes]
        ids = np.split(flat, at[1:-1]) if len(texts) else []
        n = np.diff(at)
        texts = pc.fill_null(texts, "")
        lined = np.flatnonzero(pc.match_substring(texts, "\n").to_numpy(zero_copy_only=False))
        again = np.zeros(len(n), np.int64)
        again[lined] = [duplicate_lines(t) for t in texts.take(pa.array(lined)).to_pylist()]
        symbols = sum(pc.count_substring(texts, s).to_numpy(zero_copy_only=False).astype(np.int64) for s in SYMBOLS.decode())
        out = {
            "n_words": n,
            "word_chars": np.diff(np.concatenate([[0], np.cumsum(self.chars[flat])])[at]),
            "n_symbols": symbols,
            "n_dup_lines": again,
            "n_repeat_words": np.array([repeated_words(i) for i in ids], np.int64),
        }
        out["base_failed"] = (n < 20) | (100 * out["n_repeat_words"] > 30 * n)
        return out, ids


def language(lang: str | None) -> str:
    """The language as a key that is never null."""
    return "" if lang is None else "=" + lang


def characters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """4-grams of the words' characters as two ranks in one number, the packed pairs of characters by rank, and the number of 4-grams of each word."""
    if not words:
        return (np.zeros(0, np.int64),) * 3
    pad = (START_CHAR * (ORDER - 1)).encode()
    text = (pad + (END_CHAR.encode() + pad).join(words) + END_CHAR.encode()).decode()
    x = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.diff(np.flatnonzero(x == ord(END_CHAR)), prepend=-1) - (ORDER - 1)
    pairs, rank = np.unique(x[:-1] << CHAR | x[1:], return_inverse=True)
    at = np.flatnonzero(x != ord(START_CHAR))
    return rank[at - 3] << 32 | rank[at - 1], pairs, sizes


def unpacked(grams: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second two characters of 4-grams."""
    return pairs[grams >> 32], pairs[grams & 0xFFFFFFFF]


def add_up(high: np.ndarray, low: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(new)
    return high[at], low[at], np.add.reduceat(n[order], at)


def count_grams(docs: DataFrame) -> DataFrame:
    """(language, high, low, n) over all texts that pass the base rules. docs: text, lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total, held = Reader(), {}, 0
        for batch in slices(batches, "text"):
            base, ids = reader.base(batch.column("text"))
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, failed, own in zip(batch.column("lang").to_pylist(), base["base_failed"], ids, strict=True):
                if not failed:
                    by_lang.setdefault(language(lang), []).append(own)
            for key, parts in by_lang.items():
                counts = np.bincount(np.concatenate(parts), minlength=len(reader.words))
                used = np.flatnonzero(counts)
                grams, pairs, sizes = characters([reader.words[i] for i in used.tolist()])
                grams, where = np.unique(grams, return_inverse=True)
                own = *unpacked(grams, pairs), np.bincount(where, np.repeat(counts[used], sizes), len(grams)).astype(np.int64)
                total.setdefault(key, []).append(own)
                held += len(grams)
            if held > SHARD:
                yield from (rows(key, t) for key, t in total.items())
                total, held = {}, 0
        yield from (rows(key, t) for key, t in total.items())

    def rows(key: str, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        t = add_up(*map(np.concatenate, zip(*parts, strict=True)))
        return pa.RecordBatch.from_pydict({"language": pa.array([key] * len(t[0])), "high": pa.array(t[0]), "low": pa.array(t[1]), "n": pa.array(t[2])})

    parts = docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(run, "language string, high long, low long, n long")
    return parts.groupBy("language", "high", "low").agg(F.sum("n").alias("n"))


def with_language(rows: DataFrame, by: DataFrame, lang: str, key: list[str]) -> DataFrame:
    """``rows`` with the columns of ``by``, a stored table of one row a language (null is one too).

    Up to ``FEW_LANGUAGES`` it is broadcast; beyond, the rows of one language are dealt over ``SALT`` keys by a hash of ``key``.
    """
    if by.count() <= FEW_LANGUAGES:
        by = by.withColumnRenamed(lang, "_lang")
        return rows.join(F.broadcast(by), F.col(lang).eqNullSafe(F.col("_lang")), "left").drop("_lang")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*key), F.lit(SALT)))
    by = by.select(F.col(lang).alias("_lang"), *(c for c in by.columns if c != lang), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))).alias("_dealt"))
    return rows.join(by, F.col(lang).eqNullSafe(F.col("_lang")) & (F.col("_salt") == F.col("_dealt")), "left").drop("_lang", "_salt", "_dealt")


def smoothed(counts: DataFrame) -> DataFrame:
    """Modified Kneser-Ney in joins: (language, order, weight, high, low, value) with natural logs.

    ``weight`` rows are back-off weights of contexts, the others probabilities. Below the
    highest order counts are numbers of distinct characters before an n-gram. Probabilities
    are interpolated; the lowest order is a uniform share of the language's characters and
    one unknown character (order 0).
    """
    mask, keys = (1 << CHAR) - 1, ["language", "high", "low"]
    high, low = F.col("high"), F.col("low")
    by_order = {ORDER: stored(counts, "grams")}
    for order in range(ORDER - 1, 0, -1):
        short = {3: (high.bitwiseAND(mask), low), 2: (F.lit(0).cast("long"), low), 1: (F.lit(0).cast("long"), low.bitwiseAND(mask))}[order]
        longer = by_order[order + 1].select("language", short[0].alias("high"), short[1].alias("low"))
        by_order[order] = stored(longer.groupBy(*keys).agg(F.count("*").alias("n")), "grams")
    sizes = by_order[1].groupBy("language").agg((-F.log(F.count("*") + 1.0)).alias("value"))
    # Discounts of every order from one pass over all of them: three numbers a language and order.
    every = reduce(DataFrame.unionByName, (g.select("language", F.lit(order).alias("order"), "n") for order, g in by_order.items()))
    c = every.groupBy("language", "order").agg(*(F.count_if(F.col("n") == i).cast("double").alias(f"c{i}") for i in range(1, 5)))
    y = F.when(F.col("c1") > 0, F.col("c1") / (F.col("c1") + 2 * F.col("c2"))).otherwise(0.5)
    d = [F.when(F.col(f"c{i}") > 0, F.least(F.greatest(i - (i + 1) * y * F.col(f"c{i + 1}") / F.col(f"c{i}"), F.lit(0.1)), F.lit(i - 0.1))).otherwise(min(0.5 * i, 1.0)) for i in (1, 2, 3)]
    discounts = stored(c.select("language", "order", *(x.alias(f"d{i}") for i, x in enumerate(d, 1))), "discounts")
    lower = stored(sizes.select("language", F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"), "value"), "gram_p")
    out = [lower.select("language", F.lit(0).alias("order"), F.lit(False).alias("weight"), "high", "low", "value")]
    for order in range(1, ORDER + 1):
        grams, n = by_order[order], F.col("n")
        before = {4: (high.bitwiseAND(mask), low), 3: (F.lit(0).cast("long"), low), 2: (F.lit(0).cast("long"), low.bitwiseAND(mask)), 1: (F.lit(0).cast("long"), F.lit(0).cast("long"))}[order]
        grams = with_language(grams, discounts.where(F.col("order") == order).drop("order"), "language", keys).withColumns({
            "taken": F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3")),
            "ch": F.shiftright(high, CHAR), "cl": F.shiftleft(high.bitwiseAND(mask), CHAR).bitwiseOR(F.shiftright(low, CHAR)),
            "sh": before[0], "sl": before[1],
        })
        contexts = stored(grams.groupBy("language", "ch", "cl").agg(F.sum("n").alias("total"), F.sum("taken").alias("held")), "contexts")
        below = lower.select("language", F.col("high").alias("sh"), F.col("low").alias("sl"), F.col("value").alias("below"))
        p = (n - F.col("taken") + F.col("held") * F.exp("below")) / F.col("total")
        lower = stored(grams.join(contexts, ["language", "ch", "cl"]).join(below, ["language", "sh", "sl"]).select(*keys, F.log(p).alias("value")), "gram_p")
        out.append(lower.select("language", F.lit(order).alias("order"), F.lit(False).alias("weight"), *keys[1:], "value"))
        weights = contexts.select("language", F.lit(order).alias("order"), F.lit(True).alias("weight"), F.col("ch").alias("high"), F.col("cl").alias("low"), F.log(F.col("held") / F.col("total")).alias("value"))
        out.append(weights)
    return reduce(DataFrame.unionByName, out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(key: str, order: int, weight: bool, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """64-bit hashes of the entries of one language and order."""
    seed = int.from_bytes(hashlib.blake2b(f"{order}{weight:d}{key}".encode(), digest_size=8).digest(), "little")
    return mixed(mixed(high.astype(np.uint64) + np.uint64(seed)) + low.astype(np.uint64))


class Model:
    """The files of all languages' models, mapped into memory when they are first needed."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards, self.open = folder, shards, {}

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Value of each hash, NaN where there is none."""
        out = np.full(len(keys), np.nan)
        where = (keys % np.uint64(self.shards)).astype(np.int64)
        for shard in np.unique(where).tolist():
            if shard not in self.open:
                path = f"{self.folder}/{shard}"
                self.open[shard] = tuple(np.load(f"{path}-{part}.npy", mmap_mode="r") for part in ("keys", "values")) if os.path.exists(f"{path}-keys.npy") else None
            if self.open[shard] is None:
                continue
            own, values = self.open[shard]
            rows = np.flatnonzero(where == shard)
            at = np.minimum(np.searchsorted(own, keys[rows]), len(own) - 1)
            hit = own[at] == keys[rows]
            out[rows[hit]] = values[at[hit]]
        return out

    def known(self, key: str) -> bool:
        return not np.isnan(self.find(hashes(key, 0, False, *np.zeros((2, 1), np.int64))))[0]

    def score(self, key: str, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Natural log probabilities of a language's 4-grams."""
        mask, out, open_ = (1 << CHAR) - 1, np.zeros(len(high)), np.arange(len(high))
        for order in range(ORDER, -1, -1):
            if order < ORDER:
                high = high & mask if order == 3 else np.zeros_like(high)
                low = low & mask if order == 1 else np.zeros_like(low) if order == 0 else low
            p = self.find(hashes(key, order, False, high, low))
            hit = ~np.isnan(p)
            out[open_[hit]] += p[hit]
            open_, high, low = open_[~hit], high[~hit], low[~hit]
            if not len(open_) or not order:
                break
            w = self.find(hashes(key, order, True, high >> CHAR, (high & mask) << CHAR | low >> CHAR))
            out[open_] += np.where(np.isnan(w), 0.0, w)
        return out


def train(docs: DataFrame) -> Model:
    """The models of all languages, written as shards of sorted hashes; their number grows with the entries."""
    entries = smoothed(count_grams(docs))
    folder = mounted(shared_dir(docs.sparkSession, "ngrams"))
    shards = 1 + entries.count() // SHARD

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            for (key, order, weight), own in pdf.groupby(["language", "order", "weight"]):
                h = hashes(key, order, weight, own["high"].to_numpy(), own["low"].to_numpy())
                yield pa.RecordBatch.from_pydict({"shard": pa.array((h % np.uint64(shards)).astype(np.int32)), "h": pa.array(h.view(np.int64)), "value": pa.array(own["value"].to_numpy().astype(np.float32))})

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        for part, x in (("keys", h[order]), ("values", pdf["value"].to_numpy()[order])):
            path = f"{folder}/{key[0]}-{part}.npy"
            np.save(f"{path}.{os.getpid()}.npy", x)
            os.replace(f"{path}.{os.getpid()}.npy", path)
        return pd.DataFrame({"entries": [len(h)]})

    entries.mapInArrow(hashed, "shard int, h long, value float").groupBy("shard").applyInPandas(write, "entries long").agg(F.sum("entries")).collect()
    return Model(folder, shards)


def features(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, base features, and log_perplexity (natural log; null without words or model)."""
    folder, shards = model.folder, model.shards
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, model = Reader(), Model(folder, shards)
        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        emptied, sizes = 0, np.zeros(0, np.int64)
        for batch in slices(batches, "text"):
            base, ids = reader.base(batch.column("text"))
            if reader.emptied != emptied:
                known, emptied, sizes = {}, reader.emptied, np.zeros(0, np.int64)
            n = len(reader.words)
            langs = [language(x) for x in batch.column("lang").to_pylist()]
            symbols = np.zeros(len(ids), np.int64)
            logs = np.full(len(ids), np.nan)
            new = reader.words[len(sizes) :]
            sizes = np.concatenate([sizes, np.fromiter((len(w.translate(None, MARKS).decode()) + 1 for w in new), np.int64, len(new))])
            for s in filter(model.known, set(langs)):
                own = [i for i, x in enumerate(langs) if x == s and len(ids[i])]
                if not own:
                    continue
                done, value = known.get(s, (np.zeros(0, bool), np.zeros(0)))
                done = np.concatenate([done, np.zeros(n - len(done), bool)])
                value = np.concatenate([value, np.zeros(n - len(value))])
                need = np.zeros(n, bool)
                for i in own:
                    need[ids[i]] = True
                need = np.flatnonzero(need & ~done)
                if len(need):
                    grams, pairs, each = characters([reader.words[i] for i in need.tolist()])
                    grams, where = np.unique(grams, return_inverse=True)
                    logs_of = model.score(s, *unpacked(grams, pairs))[where]
                    value[need] = np.add.reduceat(logs_of, np.concatenate([[0], np.cumsum(each)[:-1]]))
                    done[need] = True
                known[s] = done, value
                for i in own:
                    symbols[i] = sizes[ids[i]].sum()
                    logs[i] = -value[ids[i]].sum() / symbols[i]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "lang": batch.column("lang")}
                | {c: pa.array(base[c]) for c in names}
                | {"base_failed": pa.array(base["base_failed"]), "symbols": pa.array(symbols), "log_perplexity": pa.array(logs, from_pandas=True)}
            )

    kinds = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, symbols long, log_perplexity double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, kinds)


def bands(scored: DataFrame, width: float) -> DataFrame:
    """lang, middle, lower and upper log perplexity, from all documents that pass the base rules."""
    q = scored.where(~F.col("base_failed") & F.col("log_perplexity").isNotNull()).groupBy("lang")
    q = q.agg(F.percentile_approx("log_perplexity", [0.25, 0.5, 0.75], 10000).alias("_q"))
    low, middle, high = (F.col("_q")[i] for i in range(3))
    return q.select("lang", middle.alias("middle"), (low - width * (middle - low)).alias("lower"), (high + width * (high - middle)).alias("upper"))


def quality(docs: DataFrame, width: float = 6.0) -> DataFrame:
    """One row a document: base features, log_perplexity, its language's lower and upper band, and kept. docs: doc_id, text, lang."""
    scored = stored(features(docs, train(docs)), "quality")
    out = with_language(scored, stored(bands(scored, width), "bands"), "lang", ["doc_id"])
    slack = F.lit(1.0) + SHORT / F.greatest(F.col("symbols"), F.lit(1))
    far = F.col("log_perplexity") - F.col("middle")
    outside = F.coalesce((far > (F.col("upper") - F.col("middle")) * slack) | (far < (F.col("lower") - F.col("middle")) * slack), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~outside).drop("middle")
