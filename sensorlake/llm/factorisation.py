"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

Every feature has a weight and a low-rank vector; a text's log-odds are the intercept, the
weighted sum and all pairwise interactions, sum over i < j of <v_i, v_j> x_i x_j, computed in
linear time as half the square of the sum minus the sum of squares. Words are hashed, each distinct
one counting 1 / sqrt(number of distinct words); structure statistics (symbols, capitals, repeated
words and lines, word and line lengths and so on) are scaled by the sample's mean and deviation;
metadata columns are bucketed by magnitude and hashed like words.

Scale: the fit uses a bounded labelled sample (``ROWS`` rows, chosen by hash, joined as a
broadcast of that many keys); the model (``SLOTS`` x (``RANK`` + 1) floats) is broadcast, and
scoring is a map without shuffle.

Defined cases: null and empty texts have no words and zero statistics and get a score; null
metadata is a bucket of its own; without both labels in the sample all scores are the share of
label 1, 0 if there is none; null keys are scored and count as the empty text for the fold; repeated
rows get equal scores; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .labelled import (
    SAMPLE_ROWS,
    distinct_features,
    feature_lists,
    fold,
    labelled_texts,
    row_sums,
    sigmoid,
)

SLOTS = 1 << 17
RANK = 8
FOLDS, HELD = 5, 0
THRESHOLD = 0.3
#: Gradient steps at least (whole passes over the sample), rows of each, rate, weight decay.
STEPS, BATCH, RATE, DECAY = 400, 128, 0.1, 1e-5
ROWS = min(8_000, SAMPLE_ROWS)
SEED = 5
STATS = ("log_words", "log_chars", "chars_per_word", "distinct_words", "most_common", "symbols",
         "capitals", "digits", "punctuation", "log_lines", "words_per_line", "repeated_lines",
         "repeated_triples", "other_bytes")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _class(chars) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_CLASSES = (_class(b"#*$%&|<>@^~_=+\\/{}[]"), _class(range(65, 91)), _class(range(48, 58)),
            _class(b".,;:!?()'\"-"), _class(range(128, 256)))


def features(texts: pa.Array, metadata: list[pa.Array]):
    """Per group of documents: (first, last, slots, begins, statistics)."""
    for i, j, buf, off in T.texts(texts):
        n = j - i
        starts, ends, ptr = T.word_spans(buf, off)
        hashes = T.span_hashes(_LOWER[buf], starts, ends)
        words = np.diff(ptr)
        owner = np.repeat(np.arange(n), words)
        slots, begins = distinct_features(T.mix(hashes) & np.uint64(SLOTS - 1), owner, n)
        some = np.maximum(words, 1)
        size = np.maximum(np.diff(off) - 1, 1)
        shares = []
        for kind in _CLASSES:
            sums = np.zeros(len(buf) + 1, np.int64)
            np.cumsum(kind[buf], out=sums[1:])
            shares.append((sums[off[1:]] - sums[off[:-1]]) / size)
        salt = T.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        keys, counts = np.unique(hashes ^ salt[owner], return_counts=True)
        most = np.zeros(n)
        at = np.searchsorted(keys, hashes ^ salt[owner])
        np.maximum.at(most, owner, counts[at])
        line_start, line_end = T.line_spans(buf)
        line_doc = np.searchsorted(off, line_start, "right") - 1
        full = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
        line_doc, line_hash = line_doc[full], T.span_hashes(buf, line_start, line_end)[full]
        lines = np.bincount(line_doc, minlength=n)
        again = T.repeated(T.mix(line_hash ^ salt[line_doc]))
        triples = np.zeros(n)
        if len(hashes) >= 3:
            whole = np.flatnonzero(owner[2:] == owner[:-2])
            twice = T.repeated(T.mix(T.window_hashes(hashes, 3)[whole] ^ salt[owner[whole]]))
            triples = np.bincount(owner[whole], twice, n)
        stats = np.stack([
            np.log1p(words), np.log1p(np.diff(off) - 1), T.per_document(ends - starts, ptr) / some,
            np.diff(begins) / some, most / some, *shares[:4], np.log1p(lines),
            words / np.maximum(lines, 1), np.bincount(line_doc, again, n) / np.maximum(lines, 1),
            triples / some, shares[4]], 1)
        meta = [_magnitude(c.slice(i, n), k) for k, c in enumerate(metadata)]
        if meta:
            slots, begins = _append(slots, begins, np.stack(meta, 1))
        yield i, j, slots, begins, stats


def _magnitude(column: pa.Array, k: int) -> np.ndarray:
    values = np.array([-1.0 if v is None else float(v) for v in column.to_pylist()])
    bucket = np.where(np.isfinite(values) & (values >= 0), np.log2(np.maximum(values, 0) + 1), -1)
    hashes = T.mix(np.floor(bucket + 2).astype(np.uint64) + np.uint64(1000 * (k + 1)))
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int32)


def _append(slots, begins, more):
    """The rows of ``more`` at the ends of the rows of ``slots``."""
    return (np.insert(slots, np.repeat(begins[1:], more.shape[1]), more.ravel()),
            begins + more.shape[1] * np.arange(len(begins)))


@dataclass
class Model:
    bias: float
    weight: np.ndarray   # SLOTS hashed features, then the statistics
    factor: np.ndarray   # one row of RANK for each
    mean: np.ndarray
    deviation: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.deviation, -4, 4) / 4

    def logits(self, slots, begins, stats) -> np.ndarray:
        return _forward(self, slots, begins, self.dense(stats))[0]


def _forward(m: Model, slots, begins, dense):
    """Log-odds and the sums of v_i x_i, in time linear in the number of features."""
    x = 1 / np.sqrt(np.maximum(np.diff(begins), 1))
    xs = np.repeat(x, np.diff(begins))
    v, u = m.factor[slots], m.factor[SLOTS:]
    sums = row_sums(v, begins) * x[:, None] + dense @ u
    squares = row_sums((v * v).sum(1), begins) * x * x + dense**2 @ (u * u).sum(1)
    linear = row_sums(m.weight[slots], begins) * x + dense @ m.weight[SLOTS:]
    return m.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums, xs


def train(slots: np.ndarray, begins: np.ndarray, stats: np.ndarray, labels: np.ndarray,
          steps: int = STEPS) -> Model:
    """Adaptive stochastic gradient steps over the sample, in a fixed order."""
    rng = np.random.default_rng(SEED)
    n, size = len(labels), SLOTS + len(STATS)
    one = n == 0 or labels.min() == labels.max()
    share = float(labels.mean()) if n else 0.0
    m = Model(float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), np.zeros(size),
              np.zeros((size, RANK)), stats.mean(0) if n else np.zeros(len(STATS)),
              np.maximum(stats.std(0), 1e-6) if n else np.ones(len(STATS)))
    if one:
        return m
    m.factor = rng.normal(0, 0.05, (size, RANK))
    dense = m.dense(stats)
    seen_w, seen_v, seen_b = np.full(size, 1e-3), np.full((size, RANK), 1e-3), 1e-3
    for _ in range(-(-steps // -(-n // BATCH))):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = np.sort(order[at:at + BATCH])
            spans = [slots[begins[r]:begins[r + 1]] for r in rows]
            s, b = np.concatenate(spans), np.r_[0, np.cumsum([len(p) for p in spans])]
            d = dense[rows]
            logit, sums, xs = _forward(m, s, b, d)
            error = (sigmoid(logit) - labels[rows]) / len(rows)
            owner = np.repeat(np.arange(len(rows)), np.diff(b))
            e = error[owner] * xs
            used, place = np.unique(s, return_inverse=True)
            grad_w = np.bincount(place, e, len(used)) + DECAY * m.weight[used]
            grad_v = np.stack([np.bincount(place, e * sums[owner, k], len(used))
                               for k in range(RANK)], 1)
            grad_v -= np.bincount(place, e * xs, len(used))[:, None] * m.factor[used]
            grad_v += DECAY * m.factor[used]
            own = np.arange(SLOTS, size)
            grad_dw = error @ d
            grad_dv = d.T @ (error[:, None] * sums) - (error @ d**2)[:, None] * m.factor[own]
            for index, gw, gv in ((used, grad_w, grad_v), (own, grad_dw, grad_dv)):
                seen_w[index] += gw * gw
                seen_v[index] += gv * gv
                m.weight[index] -= RATE * gw / np.sqrt(seen_w[index])
                m.factor[index] -= RATE * gv / np.sqrt(seen_v[index])
            g = float(error.sum())
            seen_b += g * g
            m.bias -= RATE * g / np.sqrt(seen_b)
    m.weight, m.factor = m.weight.astype(np.float32), m.factor.astype(np.float32)
    return m


def quality_model(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  label: str = "quality", metadata: tuple[str, ...] = (),
                  rows: int = ROWS) -> Model:
    """Fit on the labelled rows of the folds that are not held out."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i, j, slots, begins, stats in features(b.column(0), b.columns[1:-1]):
                yield pa.RecordBatch.from_arrays(
                    [feature_lists(slots, begins),
                     pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), len(STATS))
                     .cast(pa.list_(pa.float64())), b.columns[-1].slice(i, j - i)],
                    names=["slots", "stats", "label"])

    sample = labelled_texts(docs, labels, label, key, [text, *metadata],
                            lambda k: fold(k, FOLDS) == HELD, rows)
    columns = [f"_{i}" for i in range(1 + len(metadata))]
    got = sample.select(*columns, "_label").mapInArrow(
        run, "slots array<int>, stats array<double>, label int").toArrow()
    lists, stats = (got.column(c).combine_chunks() for c in ("slots", "stats"))
    begins = lists.offsets.to_numpy() if len(lists) else np.zeros(1, np.int64)
    return train(lists.flatten().to_numpy(), begins - begins[0],
                 stats.flatten().to_numpy().reshape(-1, len(STATS)),
                 got.column("label").to_numpy().astype(float))


def score_quality(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
                  metadata: tuple[str, ...] = ()) -> DataFrame:
    """``key, held_out, score, predicted`` of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            scores = [sigmoid(held.value.logits(slots, begins, stats))
                      for _, _, slots, begins, stats in features(b.column(1), b.columns[2:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.concatenate(scores) if scores else np.zeros(0))],
                names=[key, "score"])

    plain = docs.select(F.col(key).alias("k"), F.col(text).alias("t"),
                        *(F.col(c).alias(f"m{i}") for i, c in enumerate(metadata)))
    return plain.mapInArrow(run, f"`{key}` {kind}, score double").select(
        key, (fold(key, FOLDS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
