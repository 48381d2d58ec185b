"""Whole texts as flat numpy arrays: words, lines and n-gram hashes of many documents at once.

An Arrow batch of texts becomes one byte array with a newline after every text, so no word or
line ever spans two documents. Work goes through the batch in groups of whole documents of about
``GROUP_BYTES``; memory is bounded by that or by the largest single text, never by a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 1 << 20
SPAN_BYTES = 1 << 20
_U = np.uint64

# Word separators of all the rules: space, tab, newline, vertical tab, form feed, return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
CONTINUATION = np.zeros(256, bool)
CONTINUATION[0x80:0xC0] = True

_BASE = 0x9E3779B97F4A7C15
_NGRAM_BASE = 0xD1342543DE82EF95
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, extended on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.r_[_U(1), np.full(size - 1, b, _U)])
                                  for b in (_U(self.base), _U(self.inverse)))
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _NGRAM_POWERS = _Powers(_BASE), _Powers(_NGRAM_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit affects every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, a newline after each, and the n + 1 places where they begin.
    Null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    joined = pc.binary_join_element_wise(column, pa.scalar("", pa.large_string()),
                                         pa.scalar("\n", pa.large_string()))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    _, offsets, data = joined.buffers()
    off = np.frombuffer(offsets, np.int64)[joined.offset:joined.offset + len(joined) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def groups(off: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive [first, last) documents of at most ``size`` bytes, one document at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(int(np.searchsorted(off, off[i] + size, "right")) - 1, i + 1)
        yield i, min(j, n)
        i = min(j, n)


def texts(column: pa.Array, size: int = GROUP_BYTES):
    """Per group of documents: (first, last, bytes, offsets from 0)."""
    buf, off = flat(column)
    for i, j in groups(off, size):
        yield i, j, buf[off[i]:off[j]], off[i:j + 1] - off[i]


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    return edge[::2], edge[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each span (sorted, not overlapping), from prefix sums: the sum up
    to the end minus the sum up to the start, shifted back by the inverse power."""
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + SPAN_BYTES, "right")), i + 1)
        first, last = int(starts[i]), int(ends[j - 1])
        up, down = _BYTE_POWERS.get(last - first + 1)
        sums = np.zeros(last - first + 1, _U)
        np.cumsum(_BYTE_VALUES[buf[first:last]] * up[:-1], out=sums[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(_U) * _U(_NGRAM_BASE))
        i = j
    return out


def word_spans(buf: np.ndarray, off: np.ndarray):
    """Starts and ends of all words, and for each document where its words begin (n + 1)."""
    starts, ends = spans(~SPACE[buf])
    return starts, ends, np.searchsorted(starts, off)


def line_spans(buf: np.ndarray):
    """Starts and ends of all newline-split lines (the newline after each text ends its last)."""
    ends = np.flatnonzero(buf == 0x0A)
    return np.r_[0, ends[:-1] + 1] if len(ends) else ends, ends


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of every n consecutive entries, as one pass over prefix sums."""
    if len(words) < n:
        return np.zeros(0, _U)
    up, down = _NGRAM_POWERS.get(len(words) + 1)
    sums = np.zeros(len(words) + 1, _U)
    np.cumsum(words * up[:-1], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[:len(words) - n + 1] + _U(n))


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs at least twice."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]]
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def per_document(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive places of ``ptr``."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[ptr[1:]] - sums[ptr[:-1]]
