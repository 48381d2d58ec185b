"""Sets of word n-grams as sorted 64-bit hashes, for whole batches of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import text as T

WIDTH = 5
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = 2 * np.random.default_rng(11).integers(0, 2**63, 2, dtype=np.uint64) + np.uint64(1)


def _window_sets(words: np.ndarray, owner: np.ndarray, owners: int, width: int):
    """Distinct shingles of each owner (its words are consecutive), sorted, and where they begin."""
    n = np.bincount(owner, minlength=owners)
    if len(words) >= width:
        whole = np.flatnonzero(owner[width - 1:] == owner[:len(owner) - width + 1])
        hashes, own = T.window_hashes(words, width)[whole], owner[whole]
    else:
        hashes, own = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        first = np.searchsorted(owner, short)
        tails = np.array([T.window_hashes(words[i:i + n[o]], int(n[o]))[0]
                          for i, o in zip(first, short, strict=True)], np.uint64)
        hashes, own = np.r_[hashes, tails], np.r_[own, short]
    order = np.lexsort((hashes, own))
    hashes, own = hashes[order], own[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1])][:len(hashes)]
    hashes, own = hashes[new], own[new]
    return hashes, np.searchsorted(own, np.arange(owners + 1))


def shingle_sets(column: pa.Array, width: int = WIDTH):
    """Per group of documents of the column: (first, last, hashes, begins): the distinct shingles
    of document i are ``hashes[begins[i]:begins[i + 1]]``, sorted. Words are separated by white
    space, A-Z count as a-z; fewer than ``width`` words are one shingle, no words none."""
    for first, last, buf, off in T.texts(column):
        buf = LOWER[buf]
        starts, ends, ptr = T.word_spans(buf, off)
        owner = np.repeat(np.arange(last - first), np.diff(ptr))
        yield first, last, *_window_sets(T.span_hashes(buf, starts, ends), owner, last - first,
                                         width)


def paragraph_sets(column: pa.Array, least: int, width: int = WIDTH):
    """As ``shingle_sets`` for the lines of at least ``least`` words: per group of documents
    (first, last, paragraphs, hashes, begins), where ``paragraphs`` has for each such line its
    document, its number in the text, its first code point, its code points and its words."""
    for first, last, buf, off in T.texts(column):
        lead = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(~T.CONTINUATION[buf], out=lead[1:])
        line_start, line_end = T.line_spans(buf)
        doc = np.searchsorted(off, line_start, "right") - 1
        number = np.arange(len(doc)) - np.searchsorted(line_start, off[:-1])[doc]
        buf = LOWER[buf]
        starts, ends, _ = T.word_spans(buf, off)
        line = np.searchsorted(line_start, starts, "right") - 1
        counts = np.bincount(line, minlength=len(line_start))
        long = counts >= least
        inside = long[line]
        renumbered = np.cumsum(long) - 1
        hashes, begins = _window_sets(T.span_hashes(buf, starts[inside], ends[inside]),
                                      renumbered[line[inside]], int(long.sum()), width)
        at = lead[line_start]
        paragraphs = {"doc": doc[long], "paragraph": number[long],
                      "start": (at - lead[off[:-1]][doc])[long],
                      "length": (lead[line_end] - at)[long], "words": counts[long]}
        yield first, last, paragraphs, hashes, begins


def set_identities(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each set of shingles."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(T.mix(hashes * _ODD[0]), out=sums[1:])
    n = np.diff(begins).astype(np.uint64)
    return T.mix(sums[begins[1:]] - sums[begins[:-1]] + n * _ODD[1])
