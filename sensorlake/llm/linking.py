"""Links between similar sets of shingles: candidates from shared buckets, exact verification,
components. Shared by the near-duplicate operators; near_dedup.py describes the rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import bitmap, stored
from .components import components, joined
from .shingles import set_identities

BITMAP_BITS = 1 << 23
#: Bits of a set's parities.
PARITY_BITS = 1 << 10
_U = np.uint64
_ODD = 2 * np.random.default_rng(23).integers(0, 2**63, dtype=np.uint64) + _U(1)


def row_lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix of unsigned numbers as lists of signed ones of the same width."""
    n, each = values.shape
    signed = np.ascontiguousarray(values).ravel().view(f"i{values.itemsize}")
    return pa.ListArray.from_arrays(np.arange(0, n * each + 1, each, dtype=np.int32),
                                    pa.array(signed))


def marked_sets(docs: DataFrame, text: str, marks: bytes, sets_of: Callable) -> DataFrame:
    """``node, shingles`` (sorted 64-bit hashes) of the sets that the bitmap may hold;
    ``sets_of(column)`` gives (..., hashes, begins) per group of texts."""
    held = docs.sparkSession.sparkContext.broadcast(marks)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]):
        marks = np.frombuffer(held.value, np.uint8)
        bits = 8 * len(marks)
        for b in batches:
            for *_, hashes, begins in sets_of(b.column(0)):
                nodes = set_identities(hashes, begins).view(np.int64)
                slot = nodes % bits
                own = np.flatnonzero((marks[slot >> 3] >> (slot & 7) & 1)
                                     & (np.diff(begins) > 0))
                if len(own):
                    nodes, at = np.unique(nodes[own], return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes),
                         pa.array([hashes[begins[i]:begins[i + 1]].tobytes() for i in own[at]],
                                  pa.binary())], names=["node", "shingles"])

    rows = docs.select(text).mapInArrow(run, "node long, shingles binary")
    return rows.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _ends(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` (a, b) with ``columns`` of both ends."""
    for end in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(end),
                                        *(F.col(c).alias(f"{c}_{end}") for c in columns)), end)
    return pairs


def _agreeing(size: int, agree: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            x, y = (b.column(c).flatten().to_numpy().reshape(-1, size)
                    for c in ("sketch_a", "sketch_b"))
            yield b.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= agree))
    return run


def _exploded(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        parts = [np.frombuffer(v.as_py(), np.int64) for v in b.column("shingles")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(b.column("node").to_numpy(), [len(p) for p in parts])),
             pa.array(np.concatenate(parts))], names=["node", "shingle"])


def _parities(batches: Iterator[pa.RecordBatch]):
    """The shingles of a set dealt to PARITY_BITS cells: a bit tells whether a cell has an odd number.
    Where two sets' bits differ, a shingle is in one of them alone, and each such shingle changes
    one bit: sets differ in at least as many shingles as in bits."""
    for b in batches:
        bits = np.zeros((len(b), PARITY_BITS), np.uint8)
        for i, v in enumerate(b.column("shingles")):
            cells = T.mix(np.frombuffer(v.as_py(), _U) * _ODD) % _U(PARITY_BITS)
            bits[i] = np.bincount(cells.astype(np.int64), minlength=PARITY_BITS) & 1
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), row_lists(np.packbits(bits, axis=1).view(_U))],
            names=["node", "parity"])


def _differing(x: str, y: str) -> Column:
    """Bits in which two parities differ."""
    return reduce(Column.__add__, (F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i]))
                                   for i in range(PARITY_BITS // 64)))


def _low_bits(size: int):
    """The two lowest bits of each of ``size`` coordinates, in longs: coordinates that agree have them
    in common, so those that differ in them are no more than those that differ."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            sketch = b.column("sketch").flatten().to_numpy().view(np.uint8)
            low = sketch.reshape(-1, size, 1) >> np.array([1, 0], np.uint8) & np.uint8(1)
            bits = np.zeros((len(b), -(-size // 32) * 64), np.uint8)
            bits[:, :2 * size] = low.reshape(len(b), -1)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), row_lists(np.packbits(bits, axis=1).view(_U))],
                names=["node", "low"])
    return run


def _coordinates_differing(x: str, y: str, size: int) -> Column:
    """Coordinates whose low bits differ."""
    pairs = F.lit(0x5555555555555555)
    def differing(i: int) -> Column:
        d = F.col(x)[i].bitwiseXOR(F.col(y)[i])
        return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(pairs))
    return reduce(Column.__add__, map(differing, range(-(-size // 32))))


def _similar(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            keep = []
            for x, y in zip(b.column("shingles_a"), b.column("shingles_b"), strict=True):
                x, y = (np.frombuffer(v.as_py(), _U) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _links(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, size: int, agree: int,
           similarity: float) -> DataFrame:
    """Those of ``pairs`` whose similarity is reached, compared exactly."""
    sized = _ends(pairs, nodes, ["n", "sketch"]).where(
        F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b"))
    near = stored(sized.select("a", "b", "sketch_a", "sketch_b")
                  .mapInArrow(_agreeing(size, agree), "a long, b long"), "near-candidates")
    return _verified(near, sets, similarity)


def _verified(near: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    return _ends(near, sets, ["shingles"]).select("a", "b", "shingles_a", "shingles_b") \
        .mapInArrow(_similar(similarity), "a long, b long")


def linked(nodes: DataFrame, sets_of: Callable[[bytes], DataFrame], size: int, agree: int,
           similarity: float) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (node, n, bands, sketch of ``size`` small numbers) -> links (a, b) and roots (node, root).
    ``sets_of(bitmap)`` gives the shingle sets of the nodes in the bitmap."""
    exploded = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = stored(exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
                    .where("members > 1"), "near-shared")
    members = stored(exploded.join(shared, "bucket"), "near-members")
    sets = stored(sets_of(bitmap(members.select("node"), "node", BITMAP_BITS)), "near-sets")
    # Shingles that no other node here has bound what a node can share: with s of n shared, its
    # similarity to a node of m shingles is at most s / (n + m - s). Pairs, and nodes, that cannot
    # reach the threshold are left out, exactly.
    alone = (sets.mapInArrow(_exploded, "node long, shingle long").groupBy("shingle")
             .agg(F.count(F.lit(1)).alias("nodes"), F.min("node").alias("node"))
             .where("nodes = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own")))
    company = members.groupBy("node").agg(F.sum("members").alias("company"))
    info = (company.join(nodes.select("node", "n"), "node").join(alone, "node", "left")
            .withColumn("s", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")
            .where(F.col("s") >= similarity * F.col("n")))
    members = stored(members.join(stored(info, "near-info"), "node"), "near-able")
    # The hub of a bucket is its node with the most company over all bands: of a text and its
    # variants that is the text itself, as each variant leaves some of the common buckets.
    hubs = stored(members.groupBy("bucket").agg(
        F.max(F.struct("company", "node", "n", "s")).alias("h"))
        .selectExpr("bucket", "h.node AS other", "h.n AS other_n", "h.s AS other_s"), "near-hubs")
    pair = [F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")]
    most = F.least("s", "other_s")
    able = most >= similarity * (F.col("n") + F.col("other_n") - most)
    tried = stored(members.join(hubs, "bucket").where((F.col("node") != F.col("other")) & able)
                   .select(*pair).distinct(), "near-pairs")
    links = stored(_links(tried, nodes, sets, size, agree, similarity), "near-links")
    roots = stored(components(links), "near-roots")

    # Two nodes have met as hub and other; larger buckets go on while they hold several components.
    done, upto, open_ = 0, 8, members.where("members > 2")
    # Sets of similarity t differ in at most (1 - t) / (1 + t) of their sizes' sum, so their parities
    # in no more bits: what is like the others of a large bucket but not similar enough meets them
    # in the join without a row for each pair.
    # Rows of the join are kept narrow: these parities and the low bits of the sketches.
    held = None
    near = _differing("parity", "other_parity") <= (1 - similarity) / (1 + similarity) * (
        F.col("n") + F.col("other_n")) + 1e-6
    at = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / float(1 << 20) * F.col("members")
    while True:
        placed = open_.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = placed.groupBy("bucket").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
        open_ = stored(placed.join(stored(several.select("bucket"), "near-several"), "bucket")
                       .where(F.col("members") > done), "near-open")
        if open_.isEmpty():
            return links, roots
        if held is None:  # later rounds have no other nodes
            late = open_.select("node").distinct()
            parities = sets.join(late, "node", "left_semi").mapInArrow(
                _parities, "node long, parity array<long>")
            low = nodes.select("node", "sketch").join(late, "node", "left_semi").mapInArrow(
                _low_bits(size), "node long, low array<long>")
            held = stored(parities.join(low, "node"), "near-parities")
        # A pair is compared once, in the round of the one that comes first; those of slices done
        # have met all others.
        keyed = open_.select("bucket", "node", "root", "n", "s", at.alias("at")).where(
            F.col("at") >= done).join(held, "node")
        reps = keyed.where(F.col("at") < upto).select(
            "bucket", *(F.col(c).alias(f"other_{c}") for c in ("root", "n", "s", "at", "parity",
                                                               "low")),
            F.col("node").alias("other"))
        after = (F.col("at") > F.col("other_at")) | (
            (F.col("at") == F.col("other_at")) & (F.col("node") > F.col("other")))
        pairs = stored(keyed.join(reps, "bucket")
                       .where((F.col("root") != F.col("other_root")) & after & able
                              & (_coordinates_differing("low", "other_low", size) <= size - agree)
                              & near).select(*pair)
                       .distinct().join(tried, ["a", "b"], "left_anti"), "near-pairs")
        fresh = stored(_verified(pairs, sets, similarity), "near-links")
        if not fresh.isEmpty():
            links = links.unionByName(fresh)
            roots = stored(joined(roots, fresh), "near-roots")
        tried = tried.unionByName(pairs)
        open_, done, upto = open_.drop("root"), upto, upto * 8
