"""Hashes of words and word shingles over whole Arrow batches, in numpy.

Works on the UTF-8 bytes: the separators are ASCII, so no text is decoded.
A word's 64-bit hash comes from prefix sums of byte * P^i (mod 2^64), a
shingle's from its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_BASE = _U(0x100000001B3)
_INVERSE = _U(pow(0x100000001B3, -1, 1 << 64))

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, SLICE_BYTES + 1)
            self.up = np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(m - 1, _BASE)]))
            self.down = np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(m - 1, _INVERSE)]))
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """Words of a run of texts: hashes, byte ranges, and each text's range of words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.offsets)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is the empty text."""
    a = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(a) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    body = a.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``size`` bytes of text."""
    _, off = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def words(data: np.ndarray, off: np.ndarray, lower: bool = False) -> Words:
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, _U), z, z, np.zeros(len(off), np.int64))
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    inside = ~_IS_SPACE[data]
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    up, down = _POWERS.get(n + 1)
    values = (_LOWER[data] if lower else data).astype(_U) + _U(1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(values * up[:n], dtype=_U)])
    h = (sums[ends] - sums[starts]) * down[starts]
    return Words(mix64(h + (ends - starts).astype(_U) * _MULT), starts, ends, np.searchsorted(starts, off).astype(np.int64))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, by the position of its first word.

    Runs that would leave the array are absent; the caller keeps to its texts.
    """
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    g = np.full(n, k, _U)
    for j in range(k):
        g = (g ^ hashes[j : j + n]) * _MULT + _U(j + 1)
        g ^= g >> _U(29)
    return mix64(g)


def shingle_sets(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct k-word shingles, ascending: (hashes, offsets).

    A text with 1 to k-1 words has its whole sequence as one shingle; a text
    without words has none.
    """
    per = w.count()
    all_grams = grams(w.hashes, k)
    parts, sizes = [], np.zeros(len(per), np.int64)
    for i, n in enumerate(per):
        at = w.offsets[i]
        if n >= k:
            s = np.unique(all_grams[at : at + n - k + 1])
        elif n:
            s = grams(w.hashes[at : at + n], int(n))
        else:
            continue
        sizes[i] = len(s)
        parts.append(s)
    joined = np.concatenate(parts) if parts else np.zeros(0, _U)
    return joined, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum (mod 2^64) of each offsets range; 0 for an empty one."""
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    return sums[offsets[1:]] - sums[offsets[:-1]]
