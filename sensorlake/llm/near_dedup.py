"""Near-duplicate groups by DartMinHash signatures, banding and exact verification.

DartMinHash throws darts, pseudorandom points of a Poisson process over (weight, rank), into every
element's region: the same darts for the same element in every document. A dart below the
element's weight counts; it belongs to one of ``SIZE`` coordinates, and each coordinate keeps its
earliest (lowest rank) dart. Ranks are searched in bands that double, only until all coordinates of
a document are taken, so a signature takes about SIZE * log(SIZE) darts and one look at every
element instead of SIZE hashes of each. Two coordinates agree with the probability of the weighted
Jaccard similarity.

Documents with the same set of word shingles are one node. ``BANDS`` bands of ``ROWS`` coordinates
give buckets; at similarity 0.8 a pair misses all of them with probability 4e-6. In the first round
every node of a bucket is compared with the bucket's hub, the node that shares most buckets with
others. Buckets whose nodes still belong to several components go on: in each round a larger slice
of their nodes, chosen by hash, meets all nodes of other components, until every slice has been
used or the bucket is one component. So each pair that shares a bucket is either compared or
already joined, without emitting all pairs of a group of copies. A pair counts if the exact Jaccard
similarity of its shingle sets is at least ``SIMILARITY``; lengths and the signatures' agreement
(over five standard deviations below the threshold) only spare hopeless comparisons.
Components of those links are the groups (linking.py).

Scale: the signature pass is a map; what is shuffled is one row of 64-bit keys per band of each
distinct shingle set, and shingle sets only of nodes in shared buckets, found in a second pass by a
bitmap of fixed size.

Defined cases: null and empty texts have no shingles and stay alone; texts of fewer than five words
are one shingle; equal keys and repeated rows are separate documents with the same group; the row
that stays is the least by (key, hash of the row), nulls first, and one of rows that repeat it; an
empty table gives an empty result; extra columns are not read, or pass through ``drop_near_copies``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import stored
from .linking import linked, marked_sets, row_lists
from .shingles import set_identities, shingle_sets

BANDS, ROWS = 32, 5
SIZE = BANDS * ROWS
SIMILARITY = 0.8
#: Agreeing coordinates of SIZE below which a pair is not compared.
AGREE = 100
FIRST_RANK = 1 / 64
_U = np.uint64
_ODD = np.random.default_rng(7).integers(0, 2**63, 16, dtype=np.uint64) * _U(2) + _U(1)


@lru_cache(maxsize=256)
def _poisson(mean: float) -> np.ndarray:
    """Cumulative distribution: the number of darts is how many entries a uniform exceeds."""
    n = np.arange(1, int(mean + 12 * mean ** 0.5 + 16))
    logs = -mean + np.r_[0.0, np.cumsum(np.log(mean / n))]
    return np.cumsum(np.exp(logs))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> _U(11)).astype(np.float64) * 2.0**-53


def signatures(hashes: np.ndarray, begins: np.ndarray,
               weights: np.ndarray | None = None) -> np.ndarray:
    """Signatures of documents whose elements are ``hashes[begins[i]:begins[i + 1]]`` (weight 1,
    or ``weights`` > 0): n x SIZE identities of darts; zeros for a document without elements."""
    docs = len(begins) - 1
    out = np.zeros(docs * SIZE, _U)
    owner = np.repeat(np.arange(docs), np.diff(begins))
    weights = np.ones(len(hashes)) if weights is None else weights
    elements = np.arange(len(hashes))
    heavy = int(np.ceil(np.log2(weights.max() + 1))) - 1 if len(hashes) else 0
    empty = np.repeat(np.diff(begins) > 0, SIZE)
    width, band = FIRST_RANK, 0  # bands [0, w), [w, 2w), [2w, 4w), ...
    while len(elements):
        ids, places, ranks = [], [], []
        for region in range(heavy + 1):
            own = elements[weights[elements] > 2.0**region - 1] if region else elements
            salt = _U((region * int(_ODD[1]) + band * int(_ODD[2])) % 2**64)
            cell = T.mix(hashes[own] * _ODD[0] + salt)
            count = np.searchsorted(_poisson(2.0**region * width), _unit(cell))
            thrown = np.repeat(np.arange(len(own)), count)
            nth = np.arange(len(thrown)) - np.repeat(np.cumsum(count) - count, count)
            dart = T.mix(cell[thrown] + nth.astype(_U) * _ODD[3])
            if heavy:
                at = 2.0**region - 1 + 2.0**region * _unit(T.mix(dart * _ODD[4]))
                hit = at < weights[own[thrown]]
                dart, thrown = dart[hit], thrown[hit]
            place = owner[own[thrown]] * SIZE + (T.mix(dart * _ODD[5]) % _U(SIZE)).astype(np.int64)
            hit = empty[place]
            ids.append(dart[hit])
            places.append(place[hit])
            ranks.append(T.mix(dart[hit] * _ODD[6]))
        ids, places, ranks = map(np.concatenate, (ids, places, ranks))
        least = np.full(len(out), np.iinfo(np.uint64).max, _U)
        np.minimum.at(least, places, ranks)
        first = ranks == least[places]
        out[places[first]] = ids[first] | _U(1)
        empty[places] = False
        waiting = empty.reshape(docs, SIZE).any(1)
        elements = elements[waiting[owner[elements]]]
        width, band = width * (2 if band else 1), band + 1
    return out.reshape(docs, SIZE)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """n x BANDS keys, each of ROWS coordinates and the band's number."""
    parts = signature.reshape(len(signature), BANDS, ROWS) * _ODD[:ROWS]
    return T.mix(parts.sum(2, dtype=_U) + np.arange(1, BANDS + 1).astype(_U) * _ODD[9])


def identity(key: str, text: str) -> Column:
    """128 bits that name a document by key and text."""
    return F.struct(F.xxhash64(key, text).alias("a"), F.xxhash64(F.lit("b"), text, key).alias("b"))


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, row`` (identity), ``n`` (shingles), ``node, bands, sketch`` (a byte of each
    coordinate)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i, j, hashes, begins in shingle_sets(b.column(2)):
                sig, n = signatures(hashes, begins), j - i
                sketch = (sig >> _U(1)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), b.column(1).slice(i, n),
                     pa.array(np.diff(begins)), pa.array(set_identities(hashes, begins).view(np.int64)),
                     row_lists(band_keys(sig)), row_lists(sketch)],
                    names=["key", "row", "n", "node", "bands", "sketch"])

    rows = docs.select(key, identity(key, text), text)
    return rows.mapInArrow(run, f"key {kind}, row struct<a:long,b:long>, n long, node long, "
                                "bands array<long>, sketch array<tinyint>")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
                similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: ``key, row`` (identity), ``group`` (key of the document that stays),
    ``group_row``, ``group_size``, ``kept``. How many others a document is like is not told: pairs
    whose nodes are joined already are not compared."""
    # Numbered as stored, so that one of several equal rows can stay.
    rows = stored(sketches(docs, key, text).withColumn("at", F.monotonically_increasing_id()),
                  "near-sketches")
    nodes = stored(rows.where("n > 0").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "row", "at")).alias("best"),
        F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")), "near-nodes")
    _, roots = linked(nodes, lambda marks: marked_sets(docs, text, marks, shingle_sets), SIZE, AGREE, similarity)
    rooted = nodes.select("node", "copies", "best").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    whole = stored(rooted.groupBy("root").agg(F.min("best").alias("best"),
                                              F.sum("copies").alias("group_size")), "near-whole")
    of_node = stored(
        rooted.select("node", "root").join(whole, "root").select("node", "best", "group_size"),
        "near-of-node")
    found = rows.where("n > 0").select("key", "row", "at", "node").join(of_node, "node").select(
        "key", "row", F.col("best.key").alias("group"), F.col("best.row").alias("group_row"),
        "group_size", (F.col("at") == F.col("best.at")).alias("kept"))
    alone = rows.where("n = 0").select(
        "key", "row", F.col("key").alias("group"), F.col("row").alias("group_row"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return found.unionByName(alone)


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with all its columns, of each group only the document that stays. Texts without
    shingles all stay."""
    names = docs.columns
    k, t = (f"c{names.index(c)}" for c in (key, text))
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    groups = near_groups(docs, key, text, similarity)
    empty = F.col(t).isNull() | ~F.col(t).rlike(r"[^\x20\x09-\x0D]")
    kept = groups.where("kept").select(F.col("row").alias("_row"))
    rows = plain.withColumn("_row", identity(k, t))
    return (rows.where(~empty).join(kept, "_row").dropDuplicates(["_row"])
            .unionByName(rows.where(empty)).drop("_row").toDF(*names))
