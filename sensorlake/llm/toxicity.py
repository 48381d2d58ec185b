"""Toxicity by a counterfactual-regularised linear classifier.

A text's features are its words (A-Z as a-z) and their first bytes, hashed, each counted once, so
one insult weighs the same in a long text and inflected forms share weight. Logistic regression
with a sparsity penalty is fitted on a bounded labelled sample, over the features whose presence
there is evidence of a label. The counterfactual part: in every
labelled text each identity term is swapped for the others of its group, and the squared change of
the score's log-odds is penalised; terms that the sample lacks are tied to their group the same
way once. What is left of a group mention's weight then cannot depend on which group it is, and
texts that name a group neutrally do not turn toxic for it.

Scale: the sample (``SAMPLE_ROWS`` rows, chosen by hash, joined as a broadcast of that many keys)
and the weights are the only things on the driver; scoring is a map without shuffle.

Defined cases: null and empty texts have no features and get the score of the intercept; without
both labels in the sample all scores are the share of toxic labels, 0 if there is none; null keys
are scored and never held out by accident (they count as the empty text); repeated rows get equal
scores; an empty table gives an empty result; extra columns are not read.
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
    prefixes,
    row_sums,
    sigmoid,
)

SLOTS = 1 << 18
PREFIXES = (4, 5, 6)
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
SPARSITY = 1e-4
FAIRNESS = 1.0
STEPS = 400
EVIDENCE = 15.0
#: Identity terms by group; a term is swapped for the others of its group.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "females", "males"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("disabled", "deaf", "blind", "elderly", "young"),
)
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (T.mix(hashes + np.uint64(kind)) & np.uint64(SLOTS - 1)).astype(np.int64)


def _word_features(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(slot, index of the word) of every feature of every word."""
    found = [(_slots(T.span_hashes(buf, starts, ends), 0), np.arange(len(starts)))]
    for n in PREFIXES:
        hashes, at = prefixes(buf, starts, ends, n)
        found.append((_slots(hashes, n), at))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def features(column: pa.Array):
    """Per group of documents: (first, last, slots, begins)."""
    for i, j, buf, off in T.texts(column):
        buf = _LOWER[buf]
        starts, ends = T.spans(_INSIDE[buf])
        slots, word = _word_features(buf, starts, ends)
        owner = np.searchsorted(off, starts, "right") - 1
        yield i, j, *distinct_features(slots, owner[word], j - i)


def term_slots(term: str) -> np.ndarray:
    data = np.frombuffer(term.lower().encode() + b" ", np.uint8)
    slots, _ = _word_features(data, np.array([0]), np.array([len(data) - 1]))
    return np.unique(slots)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, slots: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return row_sums(self.weights[slots].astype(float), begins) + self.bias


def swaps(slots: np.ndarray, begins: np.ndarray, groups=IDENTITY_TERMS):
    """The counterfactual pairs as rows of sparse differences (slots, signs, begins, weight):
    one for each two terms of a group, weighted by the texts that hold the first."""
    texts = np.bincount(slots, minlength=SLOTS)
    at, sign, starts, weight = [], [], [0], []
    for group in groups:
        own = [term_slots(t) for t in group]
        for a in range(len(group)):
            # The whole word's slot is the one that tells how many texts hold the term.
            whole = _slots(T.span_hashes(np.frombuffer(group[a].encode(), np.uint8),
                                         np.array([0]), np.array([len(group[a].encode())])), 0)
            for b in range(len(group)):
                if a != b:
                    gone, come = np.setdiff1d(own[a], own[b]), np.setdiff1d(own[b], own[a])
                    at += [gone, come]
                    sign += [-np.ones(len(gone)), np.ones(len(come))]
                    starts.append(starts[-1] + len(gone) + len(come))
                    weight.append((1 + texts[whole[0]]) / (len(begins) - 1))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0), np.array([0]), np.zeros(0)
    return np.concatenate(at), np.concatenate(sign), np.array(starts), np.array(weight)


def telling(slots: np.ndarray, begins: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Slots whose presence says something about the label: likelihood ratio of their counts
    against independence at least EVIDENCE."""
    n, prior = len(labels), labels.mean()
    owner = np.repeat(np.arange(n), np.diff(begins))
    seen = np.bincount(slots, minlength=SLOTS)
    hit = np.bincount(slots, labels[owner], SLOTS)
    miss = seen - hit
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(hit > 0, hit * np.log(hit / (seen * prior)), 0)
                     + np.where(miss > 0, miss * np.log(miss / (seen * (1 - prior))), 0))
    return ratio >= EVIDENCE


def train(slots: np.ndarray, begins: np.ndarray, labels: np.ndarray, groups=IDENTITY_TERMS,
          fairness: float = FAIRNESS, sparsity: float = SPARSITY, steps: int = STEPS) -> Model:
    """Accelerated proximal gradient on mean log loss + fairness * swaps + sparsity * |w|."""
    n = len(labels)
    weights = np.zeros(SLOTS)
    if n == 0 or labels.min() == labels.max():
        share = labels.mean() if n else 0.0
        return Model(weights, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    at, sign, starts, pair = swaps(slots, begins, groups)
    chosen = telling(slots, begins, labels)
    owner = np.repeat(np.arange(n), np.diff(begins))[chosen[slots]]
    slots = slots[chosen[slots]]
    begins = np.searchsorted(owner, np.arange(n + 1))
    prior = labels.mean()
    bias = float(np.log(prior / (1 - prior)))

    def push(w):  # gradient of the swap penalty
        change = row_sums(w[at] * sign, starts)
        return np.bincount(at, np.repeat(2 * fairness * pair * change, np.diff(starts)) * sign,
                           SLOTS)

    # The largest curvature, by power iteration, gives the step.
    x, curve = np.random.default_rng(0).random(SLOTS) * chosen + (
        np.bincount(at, minlength=SLOTS) > 0), 1.0
    for _ in range(12):
        x /= max(np.linalg.norm(x), 1e-12)
        y = np.bincount(slots, row_sums(x[slots], begins)[owner], SLOTS) / (4 * n) + push(x)
        curve, x = float(np.linalg.norm(y)), y
    step = 1 / (1.1 * max(curve, 0.25))
    ahead, before, moment = weights.copy(), weights.copy(), 1.0
    bias_ahead = bias_before = bias
    for _ in range(steps):
        error = sigmoid(row_sums(ahead[slots], begins) + bias_ahead) - labels
        grad = np.bincount(slots, error[owner], SLOTS) / n + push(ahead)
        moved = ahead - step * grad
        weights = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity, 0)
        bias = bias_ahead - step * float(error.mean())
        nxt = (1 + np.sqrt(1 + 4 * moment**2)) / 2
        pull = (moment - 1) / nxt
        ahead, before = weights + pull * (weights - before), weights
        bias_ahead, bias_before = bias + pull * (bias - bias_before), bias
        moment = nxt
    return Model(weights.astype(np.float32), bias)


def toxicity_model(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "toxic", rows: int = SAMPLE_ROWS, groups=IDENTITY_TERMS,
                   fairness: float = FAIRNESS) -> Model:
    """Fit on the labelled rows of the folds that are not held out."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i, j, slots, begins in features(b.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [feature_lists(slots, begins), b.column(1).slice(i, j - i)],
                    names=["slots", "label"])

    sample = labelled_texts(docs, labels, label, key, [text], lambda k: fold(k, FOLDS) == HELD,
                            rows)
    got = sample.select("_0", "_label").mapInArrow(run, "slots array<int>, label int").toArrow()
    lists = got.column("slots").combine_chunks()
    begins = lists.offsets.to_numpy() if len(lists) else np.zeros(1, np.int64)
    return train(lists.flatten().to_numpy(), begins - begins[0],
                 got.column("label").to_numpy().astype(float), groups, fairness)


def score_toxicity(docs: DataFrame, model: Model, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` of every document."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS floats
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            scores = [sigmoid(held.value.logits(slots, begins))
                      for _, _, slots, begins in features(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.concatenate(scores) if scores else np.zeros(0))],
                names=[key, "score"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double").select(
        key, (fold(key, FOLDS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
