"""Passages of at least ``WIDTH`` words that two or more documents hold, wherever they stand.

Each window of ``WIDTH`` words has a seed, the least hash of the ``SEED``-word runs inside it. It
depends on the window's words alone, so equal windows have equal seeds however the documents wrap or
surround them, and consecutive windows mostly share one. Seeds that one document alone holds are
left out; of the others every window is looked at, so no repeated window is missed. Windows count
as equal if their seeds and their hashes (64 bits each) are. Consecutive windows of a seed form a
block; equal blocks are counted once, and only distinct ones are taken apart into windows.

Of each repeated window the place of least (key, row, word) stays. What other places cover is to be
removed, but for words that a staying window covers too: each repeated window stays whole once.

Scale: two maps over the texts; the first sends about one seed for 13 words, the second the windows
of seeds that may be shared, by a bitmap of fixed size (where it fills up, more is sent and the
result is the same). Copies collapse map-side to one block. No task holds more than the windows of
one document.

Defined cases: words are separated by ASCII white space, A-Z count as a-z; null, empty and shorter
texts have no passages; repeats inside one document alone do not count; repeated rows of equal key
and text are documents of their own and share their rows of the result; an empty table gives an
empty result; extra columns are not read, or pass through ``drop_passages``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import bitmap, stored
from .shingles import LOWER

WIDTH, SEED = 50, 25
#: Seeds to choose from in a window, and windows of a block at most.
REACH = WIDTH - SEED + 1
BITMAP_BITS = 1 << 25
#: Distinct blocks of a seed beyond which its windows are dealt one by one.
MANY = 1_000
_U = np.uint64
_ODD = 2 * np.random.default_rng(17).integers(0, 2**63, 3, dtype=np.uint64) + _U(1)


def _windows(column: pa.Array):
    """Per group of documents: document of the column, number of the first word, seed, hash, first
    code point and the one after the last, of each window."""
    for first, _, buf, off in T.texts(column):
        lead = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(~T.CONTINUATION[buf], out=lead[1:])
        buf = LOWER[buf]
        starts, ends, ptr = T.word_spans(buf, off)
        owner = np.repeat(np.arange(len(off) - 1), np.diff(ptr))
        whole = np.flatnonzero(owner[WIDTH - 1:] == owner[:max(len(owner) - WIDTH + 1, 0)])
        if not len(whole):
            continue
        words = T.span_hashes(buf, starts, ends)
        seed, span = T.window_hashes(words, SEED), 1
        while 2 * span <= REACH:
            seed, span = np.minimum(seed[:-span], seed[span:]), 2 * span
        seed = np.minimum(seed[:len(seed) - (REACH - span)], seed[REACH - span:])
        own = owner[whole]
        zero = lead[off[own]]
        yield (own + first, whole - ptr[own], seed[whole], T.window_hashes(words, WIDTH)[whole],
               lead[starts[whole]] - zero, lead[ends[whole + WIDTH - 1]] - zero)


def _first(doc: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """True for the first of equal entries of a document."""
    order = np.lexsort((*values, doc))
    new = np.zeros(len(doc), bool)
    for x in (doc, *values):
        new[1:] |= x[order][1:] != x[order][:-1]
    new[:1] = True
    out = np.zeros(len(doc), bool)
    out[order[new]] = True
    return out


def _seeds(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        for doc, _, seed, *_ in _windows(b.column(0)):
            run = np.r_[True, (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])]
            doc, seed = doc[run], seed[run]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed[_first(doc, seed)].view(np.int64))], names=["seed"])


def _blocks(marks):
    def run(batches: Iterator[pa.RecordBatch]):
        bits = np.frombuffer(marks.value, np.uint8)
        for b in batches:
            for found in _windows(b.column(2)):
                slot = found[2].view(np.int64) % (8 * len(bits))
                held = np.flatnonzero(bits[slot >> 3] >> (slot & 7) & 1)
                if not len(held):
                    continue
                doc, place, seed, hashes, start, stop = (x[held] for x in found)
                new = np.r_[True, (doc[1:] != doc[:-1]) | (seed[1:] != seed[:-1])
                            | (place[1:] != place[:-1] + 1)]
                at = np.arange(len(doc))
                new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % REACH == 0
                begins = np.flatnonzero(new)
                pos = at - np.repeat(begins, np.diff(np.r_[begins, len(at)]))
                first = np.add.reduceat(_first(doc, seed, hashes).astype(np.int64) << pos, begins)
                block = T.mix(np.add.reduceat(T.mix(hashes + pos.astype(_U) * _ODD[0]), begins)
                              + first.astype(_U) * _ODD[1])
                doc = pa.array(doc[begins])
                cuts = pa.array(np.r_[begins, len(at)].astype(np.int32))
                lists = (pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (
                    hashes.view(np.int64), start.astype(np.int32), stop.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(doc), b.column(1).take(doc), pa.array(place[begins]),
                     pa.array(seed[begins].view(np.int64)), pa.array(block.view(np.int64)),
                     pa.array(first), *lists],
                    names=["key", "row", "place", "seed", "block", "first", "hashes", "starts",
                           "stops"])
    return run


def _runs(doc, place, start, stop):
    """Unions of sorted windows: of each its document, first word, the word after, code points."""
    new = np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + WIDTH)][:len(doc)]
    last = np.r_[new[1:], True][:len(doc)]
    return doc[new], place[new], place[last] + WIDTH, start[new], stop[last]


def _spans(batches: Iterator[pa.RecordBatch]):
    """Windows of documents (key, row, parts) -> spans that stay and spans to be removed."""
    for b in batches:
        parts = b.column(2)
        part = parts.flatten()
        owner = np.repeat(np.arange(len(b)), parts.value_lengths().to_numpy())
        place, held, stays = (part.field(i).to_numpy() for i in range(3))
        sizes = part.field(3).value_lengths().to_numpy()
        start, stop = (part.field(i).flatten().to_numpy() for i in (3, 4))
        of = np.repeat(np.arange(len(part)), sizes)
        pos = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        use = np.flatnonzero(held[of] >> pos & 1)
        of, pos, start, stop = of[use], pos[use], start[use], stop[use]
        doc, place, stays = owner[of], place[of] + pos, (stays[of] >> pos & 1).astype(bool)
        order = np.lexsort((place, doc))
        doc, place, start, stop, stays = (x[order] for x in (doc, place, start, stop, stays))
        whole = _runs(doc, place, start, stop)
        kept = _runs(*(x[stays] for x in (doc, place, start, stop)))
        # What is not kept opens where a run begins or a kept one ends (the white space after it
        # stays), and closes where a kept one begins or the run ends.
        opens = [np.r_[whole[i], k] for i, k in ((0, kept[0]), (1, kept[2]), (3, kept[4] + 1))]
        closes = [np.r_[whole[i], k] for i, k in ((0, kept[0]), (2, kept[1]), (4, kept[3]))]
        opens, closes = ([x[np.lexsort((side[1], side[0]))] for x in side]
                         for side in (opens, closes))
        real = opens[1] < closes[1]
        cut = (opens[0][real], opens[1][real], closes[1][real], opens[2][real], closes[2][real])
        doc, place, end, start, stop = (np.r_[k, c] for k, c in zip(kept, cut, strict=True))
        doc = pa.array(doc)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(doc), b.column(1).take(doc), pa.array(start.astype(np.int64)),
             pa.array((stop - start).astype(np.int64)), pa.array((end - place).astype(np.int64)),
             pa.array(np.arange(len(end)) >= len(kept[0]))],
            names=["key", "row", "start", "length", "words", "removed"])


def _held(distinct: DataFrame) -> DataFrame:
    """Distinct blocks -> ``seed, block, best, held, stays``: bits of their windows that two
    documents hold, and of those whose least place is the block's best. Equal windows have equal
    seeds, so blocks are dealt by seed and windows meet without a shuffle of their own; those of the
    few seeds of many blocks are dealt one by one."""
    many = stored(distinct.groupBy("seed").agg(F.count(F.lit(1)).alias("blocks"))
                  .where(F.col("blocks") > MANY).select("seed"), "pass-many")
    bit = F.expr("shiftleft(1L, pos)")
    place = F.struct("best.key", "best.row", (F.col("best.place") + F.col("pos")).alias("place"))
    documents = F.sum(F.when(F.col("first").bitwiseAND(bit) != 0, F.col("copies")))

    def windows(blocks: DataFrame) -> DataFrame:
        return blocks.select("seed", "block", "copies", "best", "first",
                             F.posexplode("hashes").alias("pos", "hash"))

    def marked(found: DataFrame) -> DataFrame:
        return found.groupBy("seed", "block").agg(
            F.bit_or(bit).alias("held"), F.first("best").alias("best"),
            F.bit_or(F.when(place.eqNullSafe(F.col("least")), bit).otherwise(F.lit(0)))
            .alias("stays"))

    equal = Window.partitionBy("seed", "hash")
    few = windows(distinct.join(many, "seed", "left_anti").repartition("seed")).select(
        "seed", "block", "best", "pos", documents.over(equal).alias("documents"),
        F.min(place).over(equal).alias("least")).where("documents > 1")
    hot = windows(distinct.join(many, "seed", "left_semi"))
    repeated = stored(hot.groupBy("seed", "hash").agg(
        documents.alias("documents"), F.min(place).alias("least"))
        .where("documents > 1").drop("documents"), "pass-repeated")
    return marked(few).unionByName(marked(hot.join(repeated, ["seed", "hash"])))


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per span of a document that repeated windows cover: ``key, row`` (hash of key and
    text), ``start, length`` (code points), ``words, removed``."""
    kind = docs.schema[key].dataType.simpleString()
    seeds = (docs.select(text).mapInArrow(_seeds, "seed long").groupBy("seed")
             .agg(F.count(F.lit(1)).alias("documents")).where("documents > 1"))
    marks = docs.sparkSession.sparkContext.broadcast(  # of fixed size
        bitmap(stored(seeds.select("seed"), "pass-seeds"), "seed", BITMAP_BITS))
    blocks = stored(docs.select(key, F.xxhash64(key, text), text).mapInArrow(
        _blocks(marks), f"key {kind}, row long, place long, seed long, block long, first long, "
                        "hashes array<long>, starts array<int>, stops array<int>"), "pass-blocks")
    distinct = stored(blocks.groupBy("seed", "block").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "row", "place")).alias("best"),
        F.first("first").alias("first"), F.first("hashes").alias("hashes")), "pass-distinct")
    held = stored(_held(distinct), "pass-held")
    mine = F.struct("key", "row", "place").eqNullSafe(F.col("best"))
    parts = (blocks.select("key", "row", "place", "seed", "block", "starts", "stops")
             .join(held, ["seed", "block"]).groupBy("key", "row", "place")
             .agg(*(F.first(c).alias(c) for c in ("held", "starts", "stops")),
                  F.first(F.when(mine, F.col("stays")).otherwise(F.lit(0))).alias("stays"))
             .groupBy("key", "row")
             .agg(F.collect_list(F.struct("place", "held", "stays", "starts", "stops"))))
    return parts.mapInArrow(_spans, f"key {kind}, row long, start long, length long, words long, "
                                    "removed boolean")


def drop_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns, the removed spans cut out of the texts."""
    names = docs.columns
    k, t = (f"c{names.index(c)}" for c in (key, text))
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    cuts = (repeated_passages(docs, key, text).where("removed").groupBy(F.col("row").alias("_row"))
            .agg(F.array_sort(F.collect_set(F.struct(
                "start", (F.col("start") + F.col("length")).alias("stop")))).alias("_cut")))
    rows = plain.withColumn("_row", F.xxhash64(k, t)).join(cuts, "_row", "left")
    left = F.zip_with(
        F.concat(F.array(F.lit(0).cast("long")), F.col("_cut.stop")),
        F.concat(F.col("_cut.start"), F.array(F.char_length(t).cast("long"))),
        lambda a, b: F.substr(F.col(t), (a + 1).cast("int"), (b - a).cast("int")))
    return rows.withColumn(t, F.when(F.col("_cut").isNull(), F.col(t))
                           .otherwise(F.array_join(left, ""))).select(*plain.columns).toDF(*names)
