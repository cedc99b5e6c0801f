r"""Language-model scoring with an Elias-Fano n-gram trie of order 3.

Words (and an end of text) are 64-bit hashes. Spark counts the words of the training
rows; then every token goes, with the two words before it, to the task that holds its
pair of words. That task writes the trie of its part into the shared folder, maps it
into memory, looks its tokens up and returns sums by text, which meet in a last shuffle.
So a part of the model is read by one task, in order, and the work grows as the tokens
do. Tasks pack what they send: a chunk of texts sends one row to each part, with each
distinct trigram once and the numbers of the texts that hold it. A part's share of
trigrams doesn't grow with the corpus, as the number of parts follows from the counted
tokens; one of words doesn't if ``spark.sql.shuffle.partitions`` grows with the corpus.

Level 1 (parts by range of the word's hash): word hashes and running counts, both
monotone, both in Elias-Fano form. A word's number is its place in this level, in order
of hashes; the levels above hold these numbers. Levels 2 and 3 (parts by a mix of a pair,
so a frequent word is spread over all parts): first words of pairs, their second words
as (rank of the first, number of the second), the words before a pair as (place of the
pair, number of that word), and running counts of pairs and trigrams. All are monotone
over all contexts, so a level is decoded in one pass and searched in order. All counts
are exact.

Probabilities, each a proper distribution over the vocabulary and one unknown word:
P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)),
P(w | v) = (c(vw) + mu2 P(w)) / (c(v) + mu2),
P(w | u, v) = (c(uvw) + mu3 P(w | v)) / (c(uv) + mu3).
The logarithm of the last one is a difference: its first part needs counts of the pair
(v, w), its second one those of (u, v), and a text's sum has the second part of a token
beside the first part of the token before it, whose pair it is. So the task of one pair
has all that it adds. Logarithms are summed as whole numbers of 2^-24, in any order.

Defined results: null or empty texts are one end token; a null id counts as an
empty string in the split into training and held-out rows; repeated rows count as
often as they occur; without training rows every probability is 1. A task that runs
again must meet its rows in the same order, as it does from files.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mounted, shared_dir, slices, word_codes
from .elias_fano import U64, Monotone, found, load, save

FINE = 1 << 24  # steps of a summed log10
PART_TOKENS = 3 << 19  # training tokens whose trigrams share a file of upper levels, at most on average
NARROW = 31  # bits up to which two numbers of words are packed into one
KEPT_WORDS, KEPT_GRAMS, SLICE, PACKED_BITS = 1_000_000, 2_000_000, 8 << 20, 63
LONG_WORD = 64  # bytes from which a word is hashed by itself

BLOBS = "part int, chunk long, n long, m long, cut long, blob binary, about binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(key: int | None) -> bool:
    return zlib.crc32(b"" if key is None else str(key).encode()) % 5 == 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: 8 bytes of all words at a time, those of ``LONG_WORD`` bytes and more one by one."""
    from xxhash import xxh3_64_intdigest

    words = words.cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.concatenate([np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) - 7, U64, raw, 0, (1,))
    sizes = np.diff(at)
    out, live = _mixed(sizes.astype(U64)), np.flatnonzero(sizes < LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        live = live[sizes[live] > k]
        if not len(live):
            break
        rest = np.minimum(sizes[live] - k, 8).astype(U64)
        out[live] = _mixed(out[live] ^ (eight[at[live] + k] & (U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - rest * U64(8)))))
    for i in np.flatnonzero(sizes >= LONG_WORD).tolist():
        out[i] = xxh3_64_intdigest(words[i].as_py())
    return out


#: Hashes of the start of a text and its end; no word holds these characters.
MARKS = word_hashes(pa.array(["\t", "\n"]))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The part of level 1 that holds a word: ranges of hashes, in order."""
    return (((hashes >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int64)


def _planes(*columns: np.ndarray) -> list[np.ndarray]:
    """The columns' bytes, those of one rank together."""
    return [np.ascontiguousarray(c.view(np.uint8)[k :: c.itemsize]) for c in columns for k in range(c.itemsize)]


def _packed(pieces: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(1).compress(b"".join(pieces))


def _unpacked(blob: bytes, kinds: list[tuple[type, int]]) -> list[np.ndarray]:
    """Columns of these kinds and lengths from their planes."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind, n in kinds:
        size = np.dtype(kind).itemsize
        bytes_ = np.empty((n, size), np.uint8)
        for k in range(size):
            bytes_[:, k] = np.frombuffer(raw, np.uint8, n, at + k * n)
        out.append(bytes_.view(kind)[:, 0])
        at += n * size
    return out


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _steps(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences to the value before, but the values themselves at ``starts``."""
    out = values.copy()
    out[1:] -= values[:-1]
    out[starts] = values[starts]
    return out


def part_of(first: np.ndarray, second: np.ndarray, parts: int) -> np.ndarray:
    """The part that holds a pair and the words before it."""
    mixed = first.astype(U64)
    mixed <<= U64(32)
    mixed ^= second.astype(U64)
    mixed *= U64(0x9E3779B97F4A7C15)
    mixed >>= U64(33)
    mixed %= U64(parts)
    return mixed.astype(np.uint16 if parts <= 1 << 16 else np.int64)


def _order(u: np.ndarray, v: np.ndarray, w: np.ndarray, part: np.ndarray, bits: int, packed: bool) -> np.ndarray:
    """Puts trigrams of words of so many bits in order of the part, the pair (v, w) and the word before it; ``packed``: three fit into one number."""
    if packed:
        key = v.astype(np.int64)
        for x in (w, u):
            key <<= bits
            key |= x
        order = np.argsort(key)
    else:
        order = np.lexsort((u, w, v))
    return order[np.argsort(part[order], kind="stable")]


def distinct_pairs(u: np.ndarray, v: np.ndarray, narrow: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, and the place of each given pair among them; -1 stands for no word."""
    if narrow:
        pairs, back = np.unique(((u + 1) << 32) | (v + 1), return_inverse=True)
        return (pairs >> 32) - 1, (pairs & 0xFFFFFFFF) - 1, back
    order = np.lexsort((v, u))
    at = _starts(u[order], v[order])
    back = np.empty(len(u), np.int64)
    back[order] = np.repeat(np.arange(len(at)), _sizes(at, len(u)))
    return u[order][at], v[order][at], back


class Trie:
    """The files of a trie, mapped into memory when they are first needed."""

    def __init__(self, folder: str, shards: int, sizes: dict[int, int], total: int, distinct: int, mu3: float, parts: int, narrow: bool):
        self.folder, self.shards, self.open = folder, shards, {}
        self.total, self.distinct, self.mu3, self.parts, self.narrow = total, distinct, mu3, parts, narrow
        self.offsets = np.concatenate([[0], np.cumsum([sizes.get(i, 0) for i in range(shards)])]).astype(np.int64)
        #: Numbers of words end before this one, which stands for "nothing precedes"; the next one stands for unknown words.
        self.nothing = int(self.offsets[-1])
        self.bits = U64((self.nothing + 1).bit_length())
        self.kind = np.uint32 if narrow else U64

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": {}}

    def _file(self, name: str, sequences: tuple[str, ...]) -> dict[str, Monotone] | None:
        path = f"{self.folder}/{name}"
        if not os.path.exists(path):
            return None
        arrays, facts = load(path)
        return {s: Monotone(arrays, s, int(facts[f"{s}.size"]), int(facts[f"{s}.bits"])) for s in sequences}

    def _words(self, shard: int) -> dict[str, Monotone] | None:
        if shard not in self.open:
            self.open[shard] = self._file(f"words-{shard}", ("word", "upto"))
        return self.open[shard]

    def _each(self, where: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(where, kind="stable")
        targets, at = np.unique(where[order], return_index=True)
        for t, start, end in zip(targets.tolist(), at.tolist(), [*at[1:].tolist(), len(order)], strict=len(order) > 0):
            yield t, order[start:end]

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Number of each word hash, -1 for words not met in training."""
        out = np.full(len(words), -1, np.int64)
        for shard, rows in self._each(shard_of(words, self.shards)):
            if level := self._words(shard):
                i = level["word"].find(words[rows])
                out[rows] = np.where(i >= 0, i + self.offsets[shard], -1)
        return out

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Training count of each number, 0 for -1."""
        out = np.zeros(len(numbers), np.int64)
        shards = np.where(numbers >= 0, np.searchsorted(self.offsets, numbers, "right") - 1, -1)
        for shard, rows in self._each(shards):
            if shard >= 0 and (level := self._words(shard)):
                i = numbers[rows] - self.offsets[shard]
                upto = level["upto"].get(np.concatenate([i + 1, i])).astype(np.int64)
                out[rows] = upto[: len(i)] - upto[len(i) :]
        return out

    def p(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.total + 0.5 * (self.distinct + 1))

    def write(self, part: int, first: np.ndarray, second: np.ndarray, place: np.ndarray, before: np.ndarray, counts: np.ndarray) -> None:
        """The upper levels of a part: its distinct pairs in order, and the words before them, by place of the pair, with counts."""
        c_pair = np.bincount(place, counts, len(first)).astype(np.int64)
        kept = c_pair > 0
        place = (np.cumsum(kept) - 1)[place]
        first, second, c_pair = first[kept], second[kept].astype(U64), c_pair[kept]
        at = _starts(first) if len(first) else np.zeros(0, np.int64)
        rank = np.repeat(np.arange(len(at)), _sizes(at, len(first)))
        real = (counts > 0) & (before != self.nothing)
        place, before, counts = place[real], before[real].astype(U64), counts[real]
        levels = {
            "first": (first[at], self.nothing + 1),
            "second": ((rank.astype(U64) << self.bits) | second, len(at) << int(self.bits)), "times2": (np.cumsum(c_pair), int(c_pair.sum()) + 1),
            "before": ((place.astype(U64) << self.bits) | before, len(first) << int(self.bits)), "times3": (np.cumsum(counts), int(counts.sum()) + 1),
        }
        arrays, facts = {}, {}
        for name, (values, universe) in levels.items():
            more, about = Monotone.encode(values, universe, name)
            arrays |= more
            facts |= about
        save(f"{self.folder}/grams-{part}", arrays, **facts)

    def look_up(self, part: int, first: np.ndarray, second: np.ndarray, pair: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of distinct pairs in order, and of the trigrams that the words before them (by number of the pair, in order) make."""
        c_pair, c_gram = np.zeros(len(first), np.int64), np.zeros(len(pair), np.int64)
        if level := self._file(f"grams-{part}", ("first", "second", "times2", "before", "times3")):
            at = _starts(first)
            rank = np.repeat(found(level["first"].all(), first[at].astype(U64)), _sizes(at, len(first)))
            known = np.flatnonzero(rank >= 0)
            place = np.full(len(first), -1)
            place[known] = found(level["second"].all(), (rank[known].astype(U64) << self.bits) | second[known].astype(U64))
            known = np.flatnonzero(place >= 0)
            c_pair[known] = np.diff(level["times2"].all().astype(np.int64), prepend=0)[place[known]]
            known = np.flatnonzero(place[pair] >= 0)
            i = found(level["before"].all(), (place[pair[known]].astype(U64) << self.bits) | before[known].astype(U64))
            c_gram[known[i >= 0]] = np.diff(level["times3"].all().astype(np.int64), prepend=0)[i[i >= 0]]
        return c_pair, c_gram


def _words(docs: DataFrame, mu3: float) -> Callable[[], Trie]:
    """Counts the words of the training rows and writes level 1."""
    spark = docs.sparkSession
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = mounted(shared_dir(spark, "trie"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            hashes, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(hashes)
            at = _starts(hashes[order])
            hashes, counts = hashes[order][at], np.add.reduceat(counts[order], at)
            shard = shard_of(hashes, shards)
            cut = _starts(shard)
            planes, ends = _planes(_steps(hashes, cut), counts), [*cut[1:].tolist(), len(hashes)]
            blobs = [_packed([x[a:b] for x in planes]) for a, b in zip(cut.tolist(), ends, strict=True)]
            return pa.RecordBatch.from_pydict({"part": pa.array(shard[cut], pa.int32()), "n": pa.array(_sizes(cut, len(hashes)), pa.int64()), "blob": pa.array(blobs, pa.binary())})

        for batch in slices(batches, "text", SLICE):
            texts = batch.column("text").filter(pa.array([not held_out(k) for k in batch.column("doc_id").to_pylist()], pa.bool_()))
            if len(texts):
                codes, _, words = word_codes(texts)
                held.append((np.concatenate([MARKS, word_hashes(words)]), np.concatenate([[len(texts)] * 2, np.bincount(codes, minlength=len(words))])))
                size += len(words)
            if size > KEPT_WORDS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def write(group: pa.Table) -> pa.Table:
        part, parts = group["part"][0].as_py(), []
        for n, blob in zip(group["n"].to_pylist(), group["blob"].to_pylist(), strict=True):
            steps, counts = _unpacked(blob, [(U64, n), (np.int64, n)])
            parts.append((np.cumsum(steps, dtype=U64), counts))
        hashes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(hashes)
        at = _starts(hashes[order])
        hashes, counts = hashes[order][at], np.add.reduceat(counts[order], at)
        upto = np.concatenate([[0], np.cumsum(counts)])
        a, x = Monotone.encode(hashes, 1 << 64, "word")
        b, y = Monotone.encode(upto, int(upto[-1]) + 1, "upto")
        save(f"{folder}/words-{part}", a | b, **x, **y)
        real = hashes != MARKS[0]  # the start is a context, not a token
        return pa.table({"part": pa.array([part], pa.int32()), "size": [len(hashes)], "total": [int(counts[real].sum())], "distinct": [int(real.sum())]})

    # One row for each shuffle partition.
    sums = docs.mapInArrow(count, "part int, n long, blob binary").groupBy("part").applyInArrow(write, "part int, size long, total long, distinct long").collect()
    sizes, total, distinct = {r["part"]: r["size"] for r in sums}, sum(r["total"] for r in sums), sum(r["distinct"] for r in sums)
    parts, narrow = max(shards, -(-total // PART_TOKENS)), sum(sizes.values()) + 2 < 1 << NARROW
    held: list[Trie] = []

    def opened() -> Trie:
        if not held:  # once for each task
            held.append(Trie(folder, shards, sizes, total, distinct, mu3, parts, narrow))
        return held[0]

    return opened


def _parted(docs: DataFrame, opened: Callable[[], Trie], every: bool) -> DataFrame:
    """Chunks of the texts (of all, or of training rows) as packed trigrams, one row for each part that has any.

    ``n`` distinct trigrams, ``m`` occurrences, ``cut`` training texts, whose numbers come before others; ``about``: the chunk's texts, with its first row.
    """

    def flush(trie: Trie, held: list[tuple], chunk: int) -> pa.RecordBatch:
        hashes, back = np.unique(np.concatenate([MARKS, *(h[4] for h in held)]), return_inverse=True)
        numbers = trie.numbers(hashes)
        # Within the chunk a word is its rank, which orders as its number does; then "nothing precedes" and unknown words.
        nothing, unknown = len(hashes), len(hashes) + 1
        rank = np.where(numbers < 0, unknown, np.arange(len(hashes)))[back].astype(np.int32)
        counts, numbers = np.append(trie.counts(numbers), [0, 0]), np.append(numbers, [trie.nothing, trie.nothing + 1]).astype(trie.kind)
        keys, train = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held])
        sizes = np.concatenate([np.diff(h[3]) for h in held]) + 2
        starts = np.cumsum(sizes) - sizes
        ids, token = np.empty(int(sizes.sum()), np.int32), np.ones(int(sizes.sum()), bool)
        token[starts] = token[starts + sizes - 1] = False
        base = 2 + np.cumsum([0, *(len(h[4]) for h in held)])
        ids[token] = np.concatenate([rank[b : b + len(h[4])][h[2]] for b, h in zip(base[:-1].tolist(), held, strict=True)])
        ids[starts], ids[starts + sizes - 1] = rank[:2]
        token[starts + sizes - 1] = True
        held.clear()

        texts = np.argsort(~train, kind="stable")
        place = np.empty(len(texts), np.uint32)
        place[texts] = np.arange(len(texts), dtype=np.uint32)
        add = lambda of: np.add.reduceat(np.where(token, of[ids], 0), starts)
        about = pa.RecordBatch.from_pydict({
            "doc_id": keys, "held_out": pa.array(~train), "n_tokens": pa.array(sizes - 1),
            "n_known": pa.array(add((counts > 0).astype(np.int64))), "base_score": pa.array(add(np.log10(trie.p(counts)))),
        }).take(pa.array(texts))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, about.schema) as out:
            out.write_batch(about)

        after = token[1:]
        v, w, text = ids[:-1][after], ids[1:][after], np.repeat(place, sizes)[1:][after]
        u = np.where(token, np.append(np.int32(nothing), ids[:-1]), np.int32(nothing))[:-1][after]
        del ids
        # A pair with an unknown word has no counts, so any part can score it: such pairs are spread by the word before.
        part = part_of(numbers[np.where((v == unknown) | (w == unknown), u, v)], numbers[w], trie.parts)
        bits = unknown.bit_length()
        order = _order(u, v, w, part, bits, 3 * bits <= PACKED_BITS)
        u, v, w, text, part = (x[order] for x in (u, v, w, text, part))
        at = _starts(u, v, w)
        upto = np.append(at, len(u))
        u, v, w, part = numbers[u[at]], numbers[v[at]], numbers[w[at]], part[at]
        cut = _starts(part)
        ends = np.append(cut[1:], len(at))
        planes, texts = _planes(_steps(v, cut), w, u, np.diff(upto).astype(np.uint32)), _planes(text) if every else []
        blobs = [_packed([x[a:b] for x in planes] + [x[c:d] for x in texts]) for a, b, c, d in zip(cut.tolist(), ends.tolist(), upto[cut].tolist(), upto[ends].tolist(), strict=True)]
        n = len(blobs)
        return pa.RecordBatch.from_pydict({
            "part": pa.array(part[cut].astype(np.int32)), "chunk": pa.array(np.full(n, chunk)), "n": pa.array(ends - cut), "m": pa.array(upto[ends] - upto[cut]),
            "cut": pa.array(np.full(n, int(train.sum()))), "blob": pa.array(blobs, pa.binary()), "about": pa.array([sink.getvalue().to_pybytes()] + [None] * (n - 1), pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, size, words, chunk = opened(), [], 0, 0, TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", SLICE):
            train = np.array([not held_out(k) for k in batch.column("doc_id").to_pylist()], bool)
            if not every:
                batch, train = batch.filter(pa.array(train)), train[train]
            if batch.num_rows:
                codes, at, distinct = word_codes(batch.column("text"))
                held.append((batch.column("doc_id"), train, codes, at, word_hashes(distinct)))
                size, words = size + len(codes) + batch.num_rows, words + len(distinct)
            if size > KEPT_GRAMS or words > KEPT_WORDS:
                yield flush(trie, held, chunk)
                size, words, chunk = 0, 0, chunk + 1
        if held:
            yield flush(trie, held, chunk)

    return docs.mapInArrow(run, BLOBS)


def _columns(group: pa.Table, trie: Trie, every: bool) -> Iterator[list[np.ndarray]]:
    for n, m, blob in zip(group["n"].to_pylist(), group["m"].to_pylist(), group["blob"].to_pylist(), strict=True):
        v, *rest = _unpacked(blob, [(trie.kind, n)] * 3 + [(np.uint32, n)] + [(np.uint32, m)] * every)
        yield [np.cumsum(v, dtype=trie.kind), *rest]


def _by_part(opened: Callable[[], Trie], every: bool, learn: bool, mu2: float) -> Callable[[pa.Table], pa.Table]:
    """Of the rows of a part: its file of the trie if it is to ``learn``, then (``every``) the sums of each chunk's texts."""

    def run(group: pa.Table) -> pa.Table:
        trie, part, blobs = opened(), group["part"][0].as_py(), []
        counts = []
        for cut, columns in zip(group["cut"].to_pylist(), _columns(group, trie, every), strict=True):
            often = columns[3].astype(np.int64)
            if learn:
                counts.append(np.add.reduceat((columns[4] < cut).astype(np.int64), np.cumsum(often) - often) if every else often)
            blobs.append(columns[:3])
        sizes = np.cumsum([0, *(len(b[0]) for b in blobs)])
        v, w, u = (np.concatenate(x).astype(np.int64) for x in zip(*blobs, strict=True))
        del blobs
        first, second, pair = distinct_pairs(v, w, trie.narrow)
        del v, w
        if len(first).bit_length() + int(trie.bits) > 63:
            raise ValueError("a part's pairs and a word's number share 63 bits: lower PART_TOKENS")
        grams, back = np.unique((pair << int(trie.bits)) | u, return_inverse=True)
        del u
        pair, before = grams >> int(trie.bits), grams & ((1 << int(trie.bits)) - 1)
        if learn:
            trie.write(part, first, second, pair, before, np.bincount(back, np.concatenate(counts), len(grams)).astype(np.int64))
        if not every:
            return pa.table({"chunk": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "blob": pa.array([], pa.binary()), "about": pa.array([], pa.binary())})
        c_pair, c_gram = trie.look_up(part, first, second, pair, before)
        at = _starts(first)
        c_first = np.repeat(trie.counts(np.where(first[at] < trie.nothing, first[at], -1)), _sizes(at, len(first)))
        own, which = np.unique(second, return_inverse=True)
        p = trie.p(trie.counts(np.where(own < trie.nothing, own, -1)))[which]
        p2 = (c_pair + mu2 * p) / (c_first + mu2)
        # The first token of a text has no pair before it, the last one is none's context.
        value = np.log10(np.where(before == trie.nothing, p2[pair], c_gram + trie.mu3 * p2[pair]))
        value -= np.where(second == trie.numbers(MARKS[1:])[0], 0.0, np.log10(c_pair + trie.mu3))[pair]
        value = np.rint(value * FINE) if trie.total else np.zeros(len(value))
        out = []
        for i, (*_, often, text) in enumerate(_columns(group, trie, True)):
            sums = np.bincount(text, np.repeat(value[back[sizes[i] : sizes[i + 1]]], often))
            hit = np.unique(text)
            out.append((len(hit), _packed(_planes(_steps(hit, [0]), sums[hit].astype(np.int64)))))
        return pa.table({"chunk": group["chunk"], "n": pa.array([n for n, _ in out], pa.int64()), "blob": pa.array([b for _, b in out], pa.binary()), "about": group["about"]})

    return run


def _scores(blobs: DataFrame, opened: Callable[[], Trie], learn: bool, mu2: float) -> DataFrame:
    def total(group: pa.Table) -> pa.Table:
        docs = pa.ipc.open_stream(next(a for a in group["about"].to_pylist() if a is not None)).read_all()
        sums = np.zeros(len(docs), np.int64)
        for n, blob in zip(group["n"].to_pylist(), group["blob"].to_pylist(), strict=True):
            steps, more = _unpacked(blob, [(np.uint32, n), (np.int64, n)])
            sums[np.cumsum(steps)] += more
        docs = docs.add_column(4, "train_tokens", pa.array(np.full(len(docs), opened().total)))
        return docs.append_column("score", pa.array(sums / FINE))

    parts = blobs.groupBy("part").applyInArrow(_by_part(opened, True, learn, mu2), "chunk long, n long, blob binary, about binary")
    return parts.groupBy("chunk").applyInArrow(total, SCORES)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def build(docs: DataFrame, mu2: float = 150.0, mu3: float = 5.0) -> Callable[[], Trie]:
    """Counts the training rows of ``docs`` (doc_id, text) and writes the trie; returns what opens it in a task."""
    docs = _rows(docs)
    opened = _words(docs, mu3)
    blobs = _parted(docs, opened, False).groupBy("part").applyInArrow(_by_part(opened, False, True, mu2), "chunk long, n long, blob binary, about binary")
    blobs.agg(F.count("chunk")).collect()
    return opened


def score(docs: DataFrame, opened: Callable[[], Trie], mu2: float = 150.0, mu3: float = 5.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (words alone) and score (log10 probability of the text).

    ``mu2`` is that of ``build``; ``mu3`` is kept with the trie.
    """
    return _scores(_parted(_rows(docs), opened, True), opened, False, mu2)


def build_and_score(docs: DataFrame, mu2: float = 150.0, mu3: float = 5.0) -> DataFrame:
    """``score`` of all rows under ``build`` of the training rows among them, with one shuffle of trigrams for both."""
    docs = _rows(docs)
    opened = _words(docs, mu3)
    return _scores(_parted(docs, opened, True), opened, True, mu2)
