"""Labelled samples and hashed sparse features shared by the text classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

#: Labelled rows that a fit may use; the rows with the least hashes of their key are taken.
SAMPLE_ROWS = 16_000


def fold(key, folds: int):
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, key: str, columns: list[str],
                   held_out, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``columns`` and ``_label`` of at most ``rows`` labelled documents that are not held out.
    Labels other than 0 and 1 and null keys are left out; a key labelled twice counts as its
    largest label. The broadcast side is the sample of keys, at most ``rows`` rows."""
    chosen = (labels.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
              .where(F.col("_key").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_key"))
              .groupBy("_key").agg(F.max("_label").cast("int").alias("_label"))
              .orderBy(F.xxhash64("_key"), "_key").limit(rows))
    return (docs.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{i}")
                                                    for i, c in enumerate(columns)))
            .join(F.broadcast(chosen), "_key").drop("_key"))


def distinct_features(slots: np.ndarray, owner: np.ndarray, docs: int):
    """Distinct (document, slot) pairs: slots sorted by document, and where each one's begin."""
    keys = np.unique(owner.astype(np.int64) << 32 | slots.astype(np.int64))
    return (keys & 0xFFFFFFFF).astype(np.int32), np.searchsorted(keys >> 32, np.arange(docs + 1))


def feature_lists(slots: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(begins.astype(np.int32), pa.array(slots, pa.int32()))


def row_sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (1 or 2 dimensions) of each row; an empty row gives 0."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[begins[1:]] - sums[begins[:-1]]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def prefixes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int):
    """Hashes of the first n bytes of the spans longer than that, and which spans those are."""
    at = np.flatnonzero(ends - starts > n)
    return T.span_hashes(buf, starts[at], starts[at] + n), at
