"""Periodic runs of words by a dictionary of basic factors.

A basic factor is a stretch of 2^k words of a text. Level by level, every factor
gets a number (equal factors of a text, and only they, share one) from the numbers
of its two halves, and its successor: the next place where the same factor begins.
Two occurrences of a factor of length L within 2L words of each other are at most L
apart, and such occurrences form arithmetic progressions: where neighbouring places
have their successors the same q words away, the words there repeat with period q.

A run whose smallest period is q, L/2 < q <= L, and whose length is at least 4q
holds more than q factors of length L, and each has its successor exactly q words on
(a nearer one would give the run a smaller period). So one level finds each run, as
one stretch of neighbouring places with the same successor distance. The stretch
ends where words q apart differ: it is as long as the run can be extended, and no
run is proposed by two levels. Factors that occur once in a text are left out of
further levels, since longer ones from the same place occur once too; in plain prose
few places outlive three levels.

Texts are handled in slices of whole rows; results don't depend on the slices.
Work in a text of n words is O(n log n) times a sort, memory O(n).

Defined results: a null or blank text has no runs and an empty collapsed text.
Repeated rows and null keys pass through; columns other than the text are kept,
unless they bear the name of a new one, which takes their place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices, word_codes

#: A run has at least this many words, and this many times its period.
LEAST_WORDS, LEAST_EXPONENT = 6, 4
_RUN = ("start", "length", "period")
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in _RUN]), False)


def successors(key: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the places ``where`` (rising) with the keys: those whose key occurs again, the distances to it, all places whose key isn't alone, and numbers of their keys."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    again = ordered[1:] == ordered[:-1]
    places = where[order]
    some = np.zeros(len(key), bool)
    some[:-1] |= again
    some[1:] |= again
    number = np.cumsum(np.concatenate([[False], ~again]))[some] if len(key) else np.zeros(0, np.int64)
    return places[:-1][again], places[1:][again] - places[:-1][again], places[some], number


def stretches(place: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of neighbouring places with one distance: first and last place, and the distance."""
    order = np.argsort(place, kind="stable")
    place, distance = place[order], distance[order]
    cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(distance) != 0))
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(place) - 1]])
    return place[first], place[last], distance[first]


def find_runs(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs in texts whose words are ``codes[at[i]:at[i + 1]]``: place of the first word among all, length, period; by place, then period."""
    total = len(codes)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    name = np.full(total, -1, np.int64)
    where, key = np.arange(total), text * (int(codes.max(initial=0)) + 1) + codes
    found, size, named = [], 1, where[:0]
    while len(where):
        place, distance, alive, number = successors(key, where)
        near = (distance <= size) & (2 * distance > size)
        if near.any():
            first, last, period = stretches(place[near], distance[near])
            length = last - first + size + period
            long = (length >= LEAST_WORDS) & (length >= LEAST_EXPONENT * period)
            found.append((first[long], length[long], period[long]))
        # The next level's factors: two living ones in a row, in one text.
        name[named] = -1
        name[alive] = number
        named = np.sort(alive)
        inside = named[named + size < total]
        where = inside[(name[inside + size] >= 0) & (text[inside + size] == text[inside])]
        key = name[where] * (int(number.max(initial=0)) + 1) + name[where + size]
        size *= 2
    start, length, period = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ((), (), ())))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def runs_and_rest(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each text's runs, and its words without those that repeat what a run's first period says, joined by spaces."""
    codes, at, words = word_codes(texts, lower=False)
    codes = codes.astype(np.int64)
    start, length, period = find_runs(codes, at)
    upto = np.searchsorted(start, at)
    local = start - np.repeat(at[:-1], np.diff(upto))
    rows = pa.StructArray.from_arrays([pa.array(x) for x in (local, length, period)], fields=[pa.field(n, pa.int64(), False) for n in _RUN])
    # Words that lie in more runs ends than begins before them are dropped.
    depth = np.zeros(len(codes) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    keep = np.cumsum(depth[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(keep)])[at]
    lists = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.take(pa.array(codes[keep])))
    return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), rows), pc.binary_join(lists, " ")


def periodic_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``df`` without its text, with ``runs`` (first word counted from 0, length, period; by first word, then period) and the ``collapsed`` text."""
    kept = [f for f in df.schema.fields if f.name not in (text, runs, collapsed)]
    schema = T.StructType([*kept, T.StructField(runs, RUNS), T.StructField(collapsed, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *runs_and_rest(batch.column(text).cast(pa.string()))], names=schema.names)

    return df.select(*(f.name for f in kept), text).mapInArrow(run, schema)
