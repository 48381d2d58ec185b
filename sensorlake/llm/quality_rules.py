"""Quality rules: repetition coverage from rolling hashes of several n-gram lengths.

Each word becomes a 64-bit hash, each n-gram a rolling hash over the words' prefix sums, and the
characters (code points) of words inside an n-gram that the same text held before are measured
against all characters of words, as are those of lines equal to an earlier line. A map without shuffle: rows never meet.

Defined cases: a null text has no words and fails the base rule; an empty text likewise; any other
column may be null and passes through; repeated rows are judged one by one, alike; an empty table
gives an empty result; extra columns pass through ``filter_quality`` unread, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text as T

# Largest share of characters inside n-grams seen before, by n, and inside lines equal to an
# earlier one.
LIMITS = {5: 0.20, 7: 0.20, 10: 0.20}
LINE_LIMIT = 0.30
MIN_WORDS = 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True

_BASE = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
         ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
         ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("line_coverage", pa.float64()),
         ("ngram_coverage", pa.list_(pa.float64()))]
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, line_coverage double, ngram_coverage array<double>")


def _covered(hashes: np.ndarray, doc: np.ndarray, salt: np.ndarray, n: int,
             first: bool) -> np.ndarray:
    """True for every word inside an n-gram that its text holds at least twice; without ``first``
    its first occurrence does not count."""
    out = np.zeros(len(hashes), bool)
    if len(hashes) < n:
        return out
    whole = np.flatnonzero(doc[n - 1:] == doc[:len(doc) - n + 1])
    keys = T.mix(T.window_hashes(hashes, n)[whole] ^ salt[doc[whole]])
    twice = np.flatnonzero(T.repeated(keys))
    if not first:
        twice = np.delete(twice, np.unique(keys[twice], return_index=True)[1])
    hit = whole[twice]
    if len(hit):
        edges = np.zeros(len(hashes) + 1, np.int64)
        edges[hit] += 1
        np.add.at(edges, hit + n, -1)
        out = np.cumsum(edges[:-1]) > 0
    return out


def measure(column: pa.Array, limits: dict[int, float] = LIMITS,
            line_limit: float = LINE_LIMIT) -> dict[str, pa.Array]:
    """All measures and the verdict for each text of an Arrow column."""
    parts: list[list[np.ndarray]] = []
    for i, j, buf, off in T.texts(column):
        n_docs = j - i
        salt = T.mix(np.arange(1, n_docs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        starts, ends, ptr = T.word_spans(buf, off)
        doc = np.repeat(np.arange(n_docs), np.diff(ptr))
        hashes = T.span_hashes(buf, starts, ends)
        lead = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(~T.CONTINUATION[buf], out=lead[1:])
        chars = lead[ends] - lead[starts]
        n_words, word_chars = np.diff(ptr), T.per_document(chars, ptr)
        symbols = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(_SYMBOL[buf], out=symbols[1:])
        n_symbols = symbols[off[1:]] - symbols[off[:-1]]

        line_start, line_end = T.line_spans(buf)
        first_word = np.searchsorted(starts, line_start)
        words_in = np.searchsorted(starts, line_end) - first_word
        word_sums = np.r_[0, np.cumsum(chars)]
        line_chars = word_sums[first_word + words_in] - word_sums[first_word]
        line_doc = np.searchsorted(off, line_start, "right") - 1
        full = np.flatnonzero(words_in > 0)
        keys = T.mix(T.span_hashes(buf, line_start, line_end)[full] ^ salt[line_doc[full]])
        again = np.ones(len(full), bool)
        again[np.unique(keys, return_index=True)[1]] = False
        later = full[again]
        n_dup = np.bincount(line_doc[later], minlength=n_docs)
        dup_chars = np.bincount(line_doc[later], line_chars[later], n_docs)

        n_repeat = T.per_document(_covered(hashes, doc, salt, 3, True), ptr)
        at_least = np.maximum(word_chars, 1)
        line_cover = dup_chars / at_least
        cover = np.stack([T.per_document(chars * _covered(hashes, doc, salt, n, False), ptr)
                          / at_least for n in limits], 1)
        failed = (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)
        kept = ~failed & (line_cover <= line_limit) & (
            cover <= np.array(list(limits.values()))).all(1)
        parts.append([n_words, word_chars, n_symbols, n_dup, n_repeat, failed, kept, line_cover,
                      cover])
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else \
        [np.zeros(0)] * (len(_BASE) - 1) + [np.zeros((0, len(limits)))]
    cover = columns.pop()
    out = {name: pa.array(c).cast(kind) for (name, kind), c in zip(_BASE, columns, strict=False)}
    out["ngram_coverage"] = pa.ListArray.from_arrays(
        np.arange(0, cover.size + 1, cover.shape[1], dtype=np.int32), pa.array(cover.ravel()))
    return out


def quality_measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, the measures, ``base_failed`` and ``kept``."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            out = measure(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *out.values()], names=[key, *out])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {SCHEMA}")


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            yield b.filter(measure(b.column(at))["kept"])

    return docs.mapInArrow(run, docs.schema)
