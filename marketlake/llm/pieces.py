"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of such a model holds a whitespace marker after another character, so a
segmentation never crosses from one marked word (``▁▁word``: markers, then the
rest) to the next. Each task keeps a table of the distinct marked words it has met;
the library segments every one of them once and decodes its ids once, and both are
joined back by position. Ids alone are decoded the same way, over runs of ids that
begin with a marked piece.

The table is per task and is emptied beyond ``TABLE_WORDS`` entries; results don't
depend on that. It replaces a shuffle of every word's position, which would move
several times the input. Words are cut, told apart and put together in Arrow; only
distinct words become Python objects.

Defined results: a null or empty text has the end id alone; ids that are null give
an empty text. Models that don't meet the condition above raise ValueError.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices

MARK = "▁"
TABLE_WORDS = 200_000
_CHUNK = re.compile(" +[^ ]*")


def chunks(texts: pa.Array) -> pa.Array:
    """Marked words of each text, each without its first marker; markers as spaces."""
    texts = pc.replace_substring(pc.fill_null(texts, "").cast(pa.string()), MARK, " ")
    odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.equal(texts, ""))
    some = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    cut = pc.split_pattern(texts, " ")
    if not len(some):
        return cut
    # Runs of markers belong to the word behind them.
    runs = [[c[1:] for c in _CHUNK.findall(" " + t)] if t else [] for t in texts.take(pa.array(some)).to_pylist()]
    order = np.arange(len(texts))
    order[some] = len(texts) + np.arange(len(some))
    return pa.concat_arrays([cut, pa.array(runs, cut.type)]).take(pa.array(order))


class WordTable:
    """Distinct marked words and their ids, flat."""

    def __init__(self, model: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) or self.sp.encode("a", out_type=str)[0][:1] != MARK:
            raise ValueError("pieces of this model cross whitespace markers, or it adds no marker before a text")
        if self.sp.encode("a  b ", out_type=str) != self.sp.encode(f"a{MARK}{MARK}b{MARK}", out_type=str) or self.sp.decode(self.sp.encode("a  b ")) != "a  b ":
            raise ValueError("this model changes whitespace")
        self.alone = self.sp.piece_to_id(MARK)
        self.end = self.sp.eos_id()
        self.marked = np.array([p.startswith(MARK) for p in pieces])
        self.control = np.array([self.sp.is_control(i) for i in range(len(pieces))])
        self.clear()

    def clear(self) -> None:
        # Row 0 is the end of a text.
        self.row: dict[str, int] = {}
        self.ids = pa.array([[self.end]], pa.list_(pa.int32()))
        self.texts = pa.array([""], pa.string())
        self.surface: dict[bytes, str] = {}

    def rows(self, words: list[str]) -> np.ndarray:
        """Rows of distinct words in the table; new ones are segmented."""
        new = [w for w in words if w not in self.row]
        if len(self.row) + len(new) > TABLE_WORDS:
            self.clear()
            new = words
        if new:
            ids = [x if w else [self.alone] for w, x in zip(new, self.sp.encode(new, num_threads=1), strict=True)]
            self.row.update(zip(new, range(len(self.ids), len(self.ids) + len(new)), strict=True))
            self.ids = pa.concat_arrays([self.ids, pa.array(ids, self.ids.type)])
            self.texts = pa.concat_arrays([self.texts, pa.array(self.sp.decode(ids), pa.string())])
        return np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array, decoded: bool = False) -> tuple[pa.ListArray, pa.Array | None]:
        """Ids of each text, an end id after the others, and the texts decoded from them."""
        cut = chunks(texts)
        coded = cut.flatten().dictionary_encode()
        rows = self.rows(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype=np.int64)
        spread = self.ids.take(pa.array(np.insert(rows, ends, 0)))
        upto = np.concatenate([[0], np.cumsum(pc.list_value_length(spread).to_numpy(zero_copy_only=False), dtype=np.int64)])
        at = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
        out = pa.ListArray.from_arrays(pa.array(upto[at], pa.int32()), spread.flatten())
        if not decoded:
            return out, None
        words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), self.texts.take(pa.array(rows)))
        return out, pc.binary_join(words, " ")

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        """Texts of the runs of ids between the offsets."""
        if len(self.surface) > TABLE_WORDS:
            self.surface = {}
        lead = self.marked[ids]
        # A run's first piece that is not a control piece takes the text's own marker: no cut before it.
        plain = np.flatnonzero(~self.control[ids])
        first = np.searchsorted(plain, offsets[:-1])
        first = plain[first[first < len(plain)]]
        lead[first] = False
        lead[offsets[:-1][offsets[:-1] < len(ids)]] = True
        cuts = np.append(np.flatnonzero(lead), len(ids))
        raw = np.ascontiguousarray(ids, np.int32).tobytes()
        keys = [raw[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        new = [k for k in set(keys) if k not in self.surface]
        for k, s in zip(new, self.sp.decode([np.frombuffer(k, np.int32).tolist() for k in new]) if new else [], strict=True):
            self.surface[k] = s
        words = list(map(self.surface.__getitem__, keys))
        where = np.searchsorted(cuts, offsets).tolist()
        return [" ".join(words[a:b]) for a, b in zip(where[:-1], where[1:], strict=True)]


@lru_cache(1)
def word_table(model: str) -> WordTable:
    """A worker process keeps its table for its next tasks."""
    return WordTable(model)


def _pass_on(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != name), T.StructField(name, kind)])


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None, same: str | None = None) -> DataFrame:
    """``df`` without its text, with ``ids``: the text's ids and an end id.

    decoded: a column for the text decoded from them. same: a column for whether that is the text (null: the empty text).
    """
    schema = _pass_on(df.drop(text), ids, T.ArrayType(T.IntegerType()))
    more = [T.StructField(name, kind()) for name, kind in ((decoded, T.StringType), (same, T.BooleanType)) if name]
    kept = [f.name for f in schema.fields[:-1] if f.name not in (decoded, same)]
    schema = T.StructType([*(schema[c] for c in kept), schema[ids], *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(model)
        for batch in slices(batches, text):
            found, back = words.encode(batch.column(text), bool(more))
            own = [found, *([back] if decoded else []), *([pc.equal(back, pc.fill_null(batch.column(text), ""))] if same else [])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *own], names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the column ``text``: what the library decodes from ``ids``."""
    schema = _pass_on(df, text, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(model)
        for batch in batches:
            runs = batch.column(ids)
            flat = runs.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
            sizes = runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            kept = [f.name for f in schema.fields[:-1]]
            own = pa.array(words.decode(offsets, flat), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), own], names=[*kept, text])

    return df.mapInArrow(run, schema)
