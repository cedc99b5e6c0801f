r"""Token counts from a compiled tokenizer.

A byte-level BPE tokenizer is compiled to two deterministic transducers. The first
reads characters by class and cuts texts into pre-tokens as the built-in pattern does:
``CUTS`` is its table, a dozen states that give the next state and the places to cut,
at most two characters back. The second reads the bytes of a pre-token; its
transitions are annotated with the number of tokens that they add (which may be
negative: a byte may merge earlier tokens). Its states are made as they are met: a
state is the longest suffix that begins some token, with the last token of each prefix
that ends within that suffix. Of all tokens that end at a position exactly one forms a
stable pair with the last token before it, which makes the next state a function of
state and byte.

A chunk is whitespace and the run after it. Between a character and whitespace the
pattern always cuts, so a chunk's state map is constant: (start state, count), and maps
of chunks compose by a prefix scan of their counts.

A block of a long text has a map from each state of the first transducer to the state
behind the block. A parallel prefix scan over the blocks' maps gives every block the
state it begins in; then each block is counted by itself, as (head, count, tail)
around its first and last cuts, and neighbours compose by counting what lies between
their cuts. Texts beyond ``LONG`` bytes go through that as rows of Spark, a block a
row: only the small maps and the pieces at borders meet. A pre-token is never split, so
a run of one class (a million equal letters) is counted in one piece.

Defined results: a null or empty text has 0 bytes and 0 tokens. Strings of special
tokens inside a text are one token each, as by the library's default.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, slices, stored

#: White space as Unicode has it (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = re.compile(f"[{SPACE}]")
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_MIXED = re.compile(f"[ \n][{SPACE}]|[{SPACE}][ \n]")
#: Endings that the pattern cuts off with their apostrophe (fixed values).
SHORT, LONG_ENDINGS = {"s", "t", "m", "d"}, {"r": "e", "v": "e", "l": "l"}
#: Beyond these the compiled states and the chunks' counts are made anew; results don't depend on it.
KEPT_STATES, KEPT_CHUNKS = 300_000, 400_000
#: Characters of a block, and bytes of a text whose blocks are rows of their own; results don't depend on them.
BLOCK, LONG = 1 << 20, 8 << 20


# Classes of characters: letters (those of the endings by themselves), numbers, others, the apostrophe, the space, other whitespace, and the end of a text.
LETTER, SINGLE, FIRST, ELL, EE, NUMBER, OTHER, APOSTROPHE, BLANK, BREAK, STOP = range(11)
# States: before any character; in a run of letters, numbers or others; behind an apostrophe that may begin an ending, or with r, v or l after it; behind an ending; in whitespace, one or several characters, that ends in a space or not.
START, LETTERS, NUMBERS, OTHERS, QUOTE, QUOTE_RV, QUOTE_L, ENDING, ONE_BLANK, BLANKS, ONE_BREAK, BREAKS = range(12)


class _Classes(dict):
    def __missing__(self, c: str) -> int:
        kind = unicodedata.category(c)[0]
        if _SPACE.match(c):
            found = BLANK if c == " " else BREAK
        elif c == "'":
            found = APOSTROPHE
        elif c in SHORT:
            found = SINGLE
        elif c in LONG_ENDINGS:
            found = ELL if c == "l" else FIRST
        elif c == "e":
            found = EE
        else:
            found = {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
        self[c] = found
        return found


CLASS = _Classes()


def _table() -> list[list[tuple[int, tuple[int, ...]]]]:
    """Of each state and class: the next state, and where the text is cut, in characters before the one that is read."""
    letters = (LETTER, SINGLE, FIRST, ELL, EE)
    fresh = {k: LETTERS for k in letters} | {NUMBER: NUMBERS, OTHER: OTHERS, APOSTROPHE: QUOTE, BLANK: ONE_BLANK, BREAK: ONE_BREAK, STOP: START}
    spaced = fresh | {APOSTROPHE: OTHERS}  # a space before an apostrophe joins it: no ending then
    out = []
    for state in range(12):
        row = {k: (fresh[k], (0,)) for k in range(11)}  # cut before the character, which begins a pre-token
        if state == START:
            row = {k: (fresh[k], ()) for k in row}
        elif state == LETTERS:
            row |= {k: (LETTERS, ()) for k in letters}
        elif state == NUMBERS:
            row[NUMBER] = (NUMBERS, ())
        elif state in (OTHERS, QUOTE):
            row |= {k: (OTHERS, ()) for k in (OTHER, APOSTROPHE)}
            if state == QUOTE:
                row |= {SINGLE: (ENDING, ()), FIRST: (QUOTE_RV, ()), ELL: (QUOTE_L, ())}
        elif state in (QUOTE_RV, QUOTE_L):
            # No ending after all: the apostrophe stands alone and the letter begins a run.
            row = {k: (LETTERS, (1,)) if k in letters else (fresh[k], (1, 0)) for k in row}
            row[EE if state == QUOTE_RV else ELL] = (ENDING, ())
        elif state in (ONE_BLANK, BLANKS, ONE_BREAK, BREAKS):
            # The last space of a run goes with what follows, another last character stands alone.
            before = (1,) if state in (BLANKS, BREAKS) else ()
            row = {k: (spaced[k], before) if state in (ONE_BLANK, BLANKS) else (fresh[k], (*before, 0)) for k in row}
            row |= {BLANK: (BLANKS, ()), BREAK: (BREAKS, ())}
        row[STOP] = (START, (1,) if state in (QUOTE_RV, QUOTE_L) else ())
        out.append([row[k] for k in range(11)])
    return out


CUTS = _table()
NEXT = [[to for to, _ in row] for row in CUTS]


def cut_places(text: str, state: int = START, ahead: str | None = None) -> list[int]:
    """Where a text is cut (rising, 0 left out unless it is a cut), read from a state on. ahead: the next two characters; None: the text ends."""
    out, read = [], CLASS
    for i, c in enumerate(text):
        state, back = CUTS[state][read[c]]
        for b in back:
            out.append(i - b)
    more = [read[c] for c in ahead] if ahead is not None else []
    for i, k in enumerate([*more, STOP] if len(more) < 2 else more, len(text)):
        state, back = CUTS[state][k]
        out.extend(i - b for b in back)
    return [p for p in out if 0 <= p < len(text)]


def cuts(text: str) -> list[str]:
    """The pre-tokens of a text."""
    at = [0, *cut_places(text), len(text)]
    return [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True) if a < b]


def state_map(text: str) -> list[int]:
    """The state behind a text for each state before it."""
    states, read = list(range(12)), CLASS
    for i, c in enumerate(text):
        k = read[c]
        states = [NEXT[s][k] for s in states]
        if len(set(states)) == 1:
            state = states[0]
            for c in text[i + 1 :]:
                state = NEXT[state][read[c]]
            return [state] * 12
    return states


def begin_states(maps: np.ndarray) -> np.ndarray:
    """The state that each of a row of blocks begins in, by a parallel prefix scan over their maps (one a row)."""
    upto, step = maps.copy(), 1
    while step < len(upto):  # after each round a map spans twice as many blocks
        upto[step:] = np.take_along_axis(upto[step:], upto[:-step].copy(), axis=1)
        step *= 2
    return np.concatenate([[START], upto[:-1, START]])


class Transducer:
    """Counts tokens of byte strings. ``ranks``: (left, right) to the merge's rank, all as bytes."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int]):
        self.ranks = ranks
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in ranks}
        self.tokens = {t for t in self.tokens if len(self.merge(t)) == 1}
        self.starts = {t[:i] for t in self.tokens for i in range(1, len(t) + 1)}
        self.stable: dict[tuple[bytes, bytes], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states: list[tuple[bytes, tuple]] = []
        self.ids: dict[tuple[bytes, tuple], int] = {}
        self.moves: list[dict[int, tuple[int, int]]] = []
        self.start = self.state((b"", ((None, 0),)))

    def merge(self, raw: bytes) -> list[bytes]:
        """Merges by rank, for compilation only."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def pair(self, a: bytes, b: bytes) -> bool:
        """Whether the tokens a, b stay apart: no merge joins across their border."""
        if (found := self.stable.get((a, b))) is None:
            if len(self.stable) > 1_000_000:
                self.stable.clear()
            found = self.stable[a, b] = self.merge(a + b) == [a, b]
        return found

    def state(self, key: tuple[bytes, tuple]) -> int:
        if (found := self.ids.get(key)) is None:
            found = self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return found

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and tokens added, compiled when first needed."""
        suffix, tail = self.states[state]
        suffix += bytes([byte])
        for n in range(len(suffix), 0, -1):
            last, (before, count) = suffix[-n:], tail[len(suffix) - n]
            if last in self.tokens and (before is None or self.pair(before, last)):
                break
        else:
            raise AssertionError("no token ends here")
        keep = next((n for n in range(len(suffix), 0, -1) if suffix[-n:] in self.starts), 0)
        added = count + 1
        tail = (*((t, c - added) for t, c in tail), (last, 0))[-keep - 1 :]
        move = self.moves[state][byte] = self.state((suffix[len(suffix) - keep :], tail)), added
        return move

    def count(self, raw: bytes) -> int:
        state, total, moves = self.start, 0, self.moves
        for byte in raw:
            move = moves[state].get(byte)
            if move is None:
                if len(self.states) > KEPT_STATES:
                    key = self.states[state]
                    self.clear()
                    state, moves = self.state(key), self.moves
                move = self.step(state, byte)
            state, added = move
            total += added
        return total


def byte_names() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """Counts tokens of texts, with the counts of the chunks it has met."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"] or {}, spec["model"]
        if (pre.get("type"), model.get("type")) != ("ByteLevel", "BPE") or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE with the built-in pattern can be compiled")
        names = byte_names()
        raw = lambda s: bytes(names[c] for c in s)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.bpe = Transducer({(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)})
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def plain(self, text: str) -> int:
        return sum(self.bpe.count(p.encode()) for p in cuts(text))

    def keys(self, text: str) -> list[str]:
        """Chunks of a text without special tokens: ``word`` for ' word', '\\nword' as it is, others after a space."""
        if not text:
            return []
        if _MIXED.search(text) or text[0] == " ":
            return [c[1:] if c[0] == " " and c[1:] and not _SPACE.match(c[1]) else " " + c for c in _CHUNK.findall(text)]
        out = text.replace("\n", " \n").split(" ")
        out[0] = " " + out[0]
        return out[1:] if out[0] == " " else out

    def learn(self, keys: set[str]) -> None:
        new = [k for k in keys if k not in self.known]
        if len(self.known) + len(new) > KEPT_CHUNKS:
            self.known, new = {}, list(keys)
        for k in new:
            self.known[k] = self.plain(k[1:] if k[:1] == " " else k if k[:1] == "\n" else " " + k)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text: differences of the scan over all chunks' counts."""
        keys, sizes, extra = [], [], []
        for text in texts:
            text = text or ""
            parts = self.special.split(text) if self.special and self.special.search(text) else [text]
            more, own = len(parts) - 1, []
            for p in parts:
                if len(p) > BLOCK:
                    more += self.blocks(p)
                else:
                    own += self.keys(p)
            keys += own
            sizes.append(len(own))
            extra.append(more)
        self.learn(set(keys))
        scan = np.concatenate([[0], np.cumsum(np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys)))])
        ends = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        return scan[ends[1:]] - scan[ends[:-1]] + np.array(extra, np.int64)

    def block(self, text: str, state: int = START, ahead: str | None = None) -> tuple[str, int, str] | str:
        """A block that begins in a state, as (head, count, tail) around its first and last cuts, or the block where it has none."""
        places = cut_places(text, state, ahead)
        if not places:
            return text
        inner = text[places[0] : places[-1]]
        keys = [inner[a - places[0] : b - places[0]] for a, b in zip(places[:-1], places[1:], strict=True)]
        return text[: places[0]], sum(self.bpe.count(k.encode()) for k in keys), text[places[-1] :]

    def compose(self, x: tuple[str, int, str] | str, y: tuple[str, int, str] | str) -> tuple[str, int, str] | str:
        """Two neighbouring blocks as one: what lies between their cuts is a pre-token. Associative."""
        if isinstance(x, str) and isinstance(y, str):
            return x + y
        if isinstance(x, str):
            return x + y[0], y[1], y[2]
        if isinstance(y, str):
            return x[0], x[1], x[2] + y
        return x[0], x[1] + self.bpe.count((x[2] + y[0]).encode()) + y[1], y[2]

    def total(self, parts: list[tuple[str, int, str] | str]) -> int:
        """Tokens of a text from its blocks in order. Blocks without a cut are put together first, each once."""
        runs: list[tuple[str, int, str] | list[str]] = []
        for p in parts:
            if isinstance(p, str) and runs and isinstance(runs[-1], list):
                runs[-1].append(p)
            else:
                runs.append([p] if isinstance(p, str) else p)
        whole: tuple[str, int, str] | str = ""
        for r in runs:
            whole = self.compose(whole, "".join(r) if isinstance(r, list) else r)
        count = lambda t: self.bpe.count(t.encode()) if t else 0
        return count(whole) if isinstance(whole, str) else count(whole[0]) + whole[1] + count(whole[2])

    def blocks(self, text: str, size: int = BLOCK) -> int:
        """Tokens of a text by its blocks: maps, a scan over them, then every block from the state it begins in."""
        own = [text[i : i + size] for i in range(0, len(text), size)]
        if not own:
            return 0
        begin = begin_states(np.array([state_map(t) for t in own]))
        return self.total([self.block(t, int(begin[i]), ahead_of(text, (i + 1) * size)) for i, t in enumerate(own)])


def ahead_of(text: str, at: int) -> str | None:
    """What a block that ends at a place has to see of the next ones; None at the end of the text."""
    return text[at : at + 2] or None


@lru_cache(1)
def compiled(path: str) -> Counter:
    """A worker process keeps what it has compiled for its next tasks."""
    return Counter(path)


def count_tokens(df: DataFrame, tokenizer: str, text: str = "text", limit: int | None = None) -> DataFrame:
    """The columns of ``df`` but the text, with n_bytes, n_tokens and, given a limit, over_limit."""
    kept = [f for f in df.schema.fields if f.name not in (text, "n_bytes", "n_tokens", "over_limit")]
    more = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    more += [T.StructField("over_limit", T.BooleanType())] if limit is not None else []
    df = df.select(*(f"`{f.name}`" for f in kept), f"`{text}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(tokenizer)
        for batch in slices(batches, text):
            texts = batch.column(text)
            n = counter.count(texts.to_pylist())
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            own = [sizes, pa.array(n, pa.int64())] + ([pa.array(n > limit)] if limit is not None else [])
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *own], names=[f.name for f in (*kept, *more)])

    size = F.coalesce(F.octet_length(text), F.lit(0))
    long = df.where(size > LONG)
    if long.isEmpty():
        return df.mapInArrow(run, T.StructType([*kept, *more]))
    (number,) = free_names(df, "_number")
    long = stored(long.withColumn(number, F.monotonically_increasing_id()), "long_texts")
    counts = long_counts(long.select(F.col(number).alias("id"), F.col(text).alias("text")), tokenizer).withColumnRenamed("id", number)
    rows = long.join(counts, number).select(*(f"`{f.name}`" for f in kept), size.cast("long").alias("n_bytes"), "n_tokens")
    if limit is not None:
        rows = rows.withColumn("over_limit", F.col("n_tokens") > limit)
    return df.where(size <= LONG).mapInArrow(run, T.StructType([*kept, *more])).unionByName(rows)


def long_counts(texts: DataFrame, tokenizer: str, size: int | None = None) -> DataFrame:
    """(id, n_tokens) of texts (id, text) by their blocks, each a row: maps, the scan over a text's maps, counts, and the sum over a text's borders."""
    size = size or BLOCK

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(tokenizer)
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                parts = counter.special.split(text) if counter.special else [text]
                alone = [counter.plain(p) for p in parts if len(p) <= size]
                yield pa.RecordBatch.from_pylist([{"id": i, "part": -1, "k": 0, "block": None, "ahead": None, "n": len(parts) - 1 + sum(alone)}], schema=blocks_schema)
                for part, p in enumerate(parts):
                    for k, at in enumerate(range(0, len(p), size) if len(p) > size else ()):
                        yield pa.RecordBatch.from_pylist([{"id": i, "part": part, "k": k, "block": p[at : at + size], "ahead": ahead_of(p, at + size), "n": 0}], schema=blocks_schema)

    blocks_schema = pa.schema([("id", pa.int64()), ("part", pa.int32()), ("k", pa.int32()), ("block", pa.string()), ("ahead", pa.string()), ("n", pa.int64())])
    blocks = stored(texts.mapInArrow(cut, "id long, part int, k int, block string, ahead string, n long").repartition("id", "part", "k"), "blocks")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [state_map(t) for t in batch.column("block").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "part", "k")), pa.array(maps, pa.list_(pa.int32()))], names=["id", "part", "k", "map"])

    def scan(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("k")
        return table.assign(begin=begin_states(np.stack(table["map"].to_numpy())).astype(np.int32))[["id", "part", "k", "begin"]]

    maps = blocks.where("part >= 0").select("id", "part", "k", "block").mapInArrow(mapped, "id long, part int, k int, map array<int>")
    begins = maps.groupBy("id", "part").applyInPandas(scan, "id long, part int, k int, begin int")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(tokenizer)
        for batch in batches:
            found = [counter.block(t, b, a) for t, b, a in zip(*(batch.column(c).to_pylist() for c in ("block", "begin", "ahead")), strict=True)]
            head, n, tail = zip(*((f, 0, None) if isinstance(f, str) else f for f in found), strict=True) if found else ((), (), ())
            own = [pa.array(head, pa.string()), pa.array(n, pa.int64()), pa.array(tail, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "part", "k")), *own], names=["id", "part", "k", "head", "n", "tail"])

    def summed(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("k")
        parts = [h if t is None else (h, int(n), t) for h, n, t in zip(table["head"], table["n"], table["tail"], strict=True)]
        return pd.DataFrame({"id": table["id"].iloc[:1], "n": [compiled(tokenizer).total(parts)]})

    parts = blocks.where("part >= 0").join(begins, ["id", "part", "k"]).mapInArrow(counted, "id long, part int, k int, head string, n long, tail string")
    sums = parts.groupBy("id", "part").applyInPandas(summed, "id long, n long")
    return sums.unionByName(blocks.where("part < 0").select("id", "n")).groupBy("id").agg(F.sum("n").alias("n_tokens"))
