"""Monotone sequences in Elias-Fano form, and files of arrays that are mapped into memory."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np

U64 = np.uint64
BLOCK, MANY = 1 << 16, 16  # numbers whose bits are taken apart at once; a search for more than one in so many decodes the sequence


def save(path: str, arrays: dict[str, np.ndarray], **facts: int | float) -> None:
    """Arrays and numbers in one file, put in place at once: a task that runs twice leaves the same file."""
    spec, at = {}, 0
    for name, a in arrays.items():
        spec[name] = (a.dtype.str, at, len(a))
        at += -(-a.nbytes // 64) * 64
    head = json.dumps({"arrays": spec, "facts": facts}).encode()
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(len(head).to_bytes(8, "little") + head)
        f.write(bytes(-f.tell() % 64))
        for a in arrays.values():
            f.write(a.tobytes())
            f.write(bytes(-a.nbytes % 64))
    os.replace(part, path)


def load(path: str) -> tuple[dict[str, np.ndarray], dict[str, int | float]]:
    raw = np.memmap(path, np.uint8, "r").view(np.ndarray)
    n = int.from_bytes(raw[:8].tobytes(), "little")
    head, base = json.loads(raw[8 : 8 + n].tobytes()), -(-(8 + n) // 64) * 64
    at = lambda kind, start, size: raw[base + start : base + start + size * np.dtype(kind).itemsize].view(kind)
    return {k: at(*x) for k, x in head["arrays"].items()}, head["facts"]


def found(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted number among the increasing values, -1 where it is missing."""
    if not len(values):
        return np.full(len(wanted), -1)
    i = np.searchsorted(values, wanted)
    return np.where(values[np.minimum(i, len(values) - 1)] == wanted, i, -1)


#: Position of the k-th (from 0) one of each byte; 0 where there is none.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], U64)


def _select(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th (from 0) one of each word: three halvings, then a table of bytes."""
    at, k = np.zeros(len(word), U64), k.astype(U64)
    for half in (32, 16, 8):
        ones = np.bitwise_count(word & U64((1 << half) - 1)).astype(U64)
        right = k >= ones
        k = k - ones * right
        step = right * U64(half)
        at, word = at + step, word >> step
    return at + _IN_BYTE[word & U64(255), k]


class Monotone:
    """A non-decreasing sequence: low bits packed, high bits in unary with counts of ones by word."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str, size: int, low: int):
        self.low_words, self.high, self.ones = arrays[f"{name}.low"], arrays[f"{name}.high"], arrays[f"{name}.ones"]
        self.zeros = np.arange(len(self.high), dtype=np.int64) * 64 - self.ones
        self.size, self.low = size, low
        self.buckets = len(self.high) * 64 - size

    @staticmethod
    def encode(values: np.ndarray, universe: int, name: str) -> tuple[dict[str, np.ndarray], dict[str, int]]:
        v, n = values.astype(U64), len(values)
        low = max(0, (universe // max(n, 1)).bit_length() - 1)
        low = min(low, 63)
        bits = lambda x: np.unpackbits(x.view(np.uint8).reshape(len(x), 8), axis=1, bitorder="little")[:, :low].reshape(-1)
        # By blocks, each of whole bytes: a number has 64 bytes while its bits are apart.
        packed = np.concatenate([np.packbits(bits(v[i : i + BLOCK]), bitorder="little") for i in range(0, n, BLOCK)] or [np.zeros(0, np.uint8)])
        low_words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 16, np.uint8)]).view(U64)
        top = (v >> U64(low)).astype(np.int64)
        unary = np.zeros(-(-(n + (universe >> low) + 2) // 64) * 64, np.uint8)
        unary[top + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little").view(U64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))[:-1]])
        return {f"{name}.low": low_words, f"{name}.high": high, f"{name}.ones": ones}, {f"{name}.size": n, f"{name}.bits": low}

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), U64)
        off = i.astype(U64) * U64(self.low)
        word, shift = (off >> U64(6)).astype(np.int64), off & U64(63)
        after = np.where(shift > 0, self.low_words[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
        return ((self.low_words[word] >> shift) | after) & U64((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, "right") - 1
        at = word * 64 + _select(self.high[word], i - self.ones[word]).astype(np.int64)
        return ((at - i).astype(U64) << U64(self.low)) | self.lows(i)

    def all(self) -> np.ndarray:
        """The whole sequence, decoded in one pass."""
        at = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        i = np.arange(self.size)
        return ((at - i).astype(U64) << U64(self.low)) | self.lows(i)

    def _after_zeros(self, k: np.ndarray) -> np.ndarray:
        """Number of elements before the k-th (from 1) zero; none for 0."""
        j = np.maximum(k - 1, 0)
        word = np.searchsorted(self.zeros, j, "right") - 1
        at = word * 64 + _select(~self.high[word], j - self.zeros[word]).astype(np.int64)
        return np.where(k > 0, at - j, 0)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, -1 where it is missing: successor search in the bucket of its high bits, or in the whole sequence if the values are many."""
        v = values.astype(U64)
        if len(v) * MANY >= self.size:
            return found(self.all(), v)
        top = (v >> U64(self.low)).astype(np.int64)
        inside = (top >= 0) & (top < self.buckets)
        top = np.where(inside, top, 0)
        start, end = self._after_zeros(top), self._after_zeros(top + 1)
        want = v & U64((1 << self.low) - 1)
        end = np.where(inside, end, start)
        lo, hi = start.copy(), end.copy()
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self.lows(mid) < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        hit = lo < end
        hit[hit] = self.lows(lo[hit]) == want[hit]
        return np.where(hit, lo, -1)
