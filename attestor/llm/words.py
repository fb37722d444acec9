"""Words of Arrow text batches, as arrays: where they lie and what they hash to.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lower-cased: ASCII letters and
digits and every byte of a non-ASCII character.  So the bytes of UTF-8 need no decoding, and a whole
batch is cut and hashed by a handful of numpy passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_FOLD = np.zeros(256, np.uint8)
for _b in range(256):
    if 48 <= _b < 58 or 97 <= _b < 123 or _b >= 128:
        _FOLD[_b] = _b
    elif 65 <= _b < 91:
        _FOLD[_b] = _b + 32

#: Most bytes handled at once; bounds the arrays that a worker holds.
SLICE_BYTES = 1 << 22
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0xD1B54A32D192ED03 * (seed + 1)) & ((1 << 64) - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                up, down = np.full(n, MULTIPLIER), np.full(n, _INVERSE)
                up[0] = down[0] = 1
                self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def run_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each run values[start:end]; equal runs hash alike wherever they lie."""
    up, down = _powers.get(len(values) + 1)
    with np.errstate(over="ignore"):
        sums = np.empty(len(values) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64), seed)


@dataclass
class Words:
    """The words of some texts: byte spans within ``data``, hashes, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # len(texts) + 1

    def text_of(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of texts that lie back to back in ``data`` (folded bytes), cut at ``offsets``."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 0
    edge = np.diff(inside)
    begin, end = edge[:-1] == 1, edge[1:] == -1  # by byte: a word begins at it, or ends with it
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    both = cut[(data[cut] != 0) & (data[cut - 1] != 0)]  # words that meet where two texts do
    begin[both] = True
    end[both - 1] = True
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(data, starts, ends, run_hash(data, starts, ends), np.searchsorted(starts, offsets))


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z, 0 for bytes outside words."""
    return _FOLD[data]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together; a longer text comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first text, last text + 1, words) for bounded slices of a column."""
    data, offsets = text_arrays(column)
    for i, j in slices(offsets, most):
        part = folded(data[offsets[i] : offsets[j]])
        yield i, j, words(part, offsets[i : j + 1] - offsets[i])


def windows(data: np.ndarray, most: int, overlap: int) -> Iterator[tuple[Words, int]]:
    """(words of a window, how many of them the window before had too) over one folded text.

    A window begins ``overlap`` words before the end of the last and ends where no word does go on; it has
    about ``most`` bytes besides, or more where one word has.
    """
    lo = at = again = 0
    while at < len(data) or not at:
        hi = min(len(data), at + most)
        while 0 < hi < len(data) and data[hi - 1] and data[hi]:  # not within a word
            gap = np.flatnonzero(data[hi : hi + most] == 0)
            hi = hi + int(gap[0]) if len(gap) else min(len(data), hi + most)
        part = data[lo:hi]
        w = words(part, np.array([0, len(part)]))
        yield w, again
        again = min(overlap, len(w.starts))
        at, lo = hi, lo + int(w.starts[-again]) if again else hi
        if hi == len(data):
            return


def shingle_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of k words, and each text's first run.

    A text of fewer than k words, but not none, has one run of all its words.
    """
    n = np.diff(w.first)
    runs = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    first = np.concatenate([[0], np.cumsum(runs)])
    starts = np.repeat(w.first[:-1] - first[:-1], runs) + np.arange(first[-1])
    ends = np.minimum(starts + k, np.repeat(w.first[1:], runs))
    return run_hash(w.hashes, starts, ends, 1), first
