"""Substring dedup by paragraph MinHash banding.

A paragraph is a line of at least ``LEAST`` words. Each becomes a set of five-word shingles with a
MinHash signature; ``tuned`` picks bands and rows so that a pair at the similarity threshold shares
a bucket with probability ``RECALL`` at least. Paragraphs that collide are joined and verified by
the exact Jaccard similarity of their shingle sets; components of verified links, together with
identical paragraphs, are classes. Of each class the paragraph of least (key, row, number) stays
and the others are to be removed from their texts.

Scale: signatures are a map; identical paragraphs become one node by map-side combine before
anything is joined, so a line that a third of all documents share is one row per task; candidates
come from shared buckets in rounds (linking.py), never as all pairs of a group.

Passages that repeat inside longer lines or across short ones are no paragraphs: passages.py
finds them, ``repeated_spans`` tells both, and ``drop_repeats`` cuts both.

Defined cases: null and empty texts and texts of short lines have no paragraphs and no rows;
repeats inside one document count like those across documents; equal keys and repeated rows are
separate documents, told apart by the hash of their text where that differs; an empty table gives
an empty result; extra columns are not read, or pass through ``drop_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.session import scratch_path
from sensorlake.tables import delete_path

from . import text as T
from .common import stored, stored_at
from .linking import linked, marked_sets, row_lists
from .passages import drop_passages, repeated_passages
from .shingles import paragraph_sets, set_identities

LEAST = 25
SIMILARITY = 0.8
SIZE = 80
RECALL = 0.9999
_U = np.uint64


def tuned(size: int = SIZE, similarity: float = SIMILARITY,
          recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): most rows a band, so fewest idle candidates, with the wanted recall."""
    for rows in range(size, 0, -1):
        if 1 - (1 - similarity**rows) ** (size // rows) >= recall:
            return size // rows, rows
    return size, 1


BANDS, ROWS = tuned()
#: Six standard deviations below what a pair at the threshold agrees in.
AGREE = int(SIZE * SIMILARITY - 6 * (SIZE * SIMILARITY * (1 - SIMILARITY)) ** 0.5)
_KEYS = 2 * np.random.default_rng(3).integers(0, 2**63, SIZE + 1, dtype=np.uint64) + _U(1)


def signatures(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """n x SIZE minima of SIZE multiplicative hashes of each (non-empty) set."""
    out = np.empty((len(begins) - 1, SIZE), _U)
    for i in range(SIZE):
        out[:, i] = np.minimum.reduceat(hashes * _KEYS[i], begins[:-1])
    return out


def paragraphs(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """``key, row`` (hash of key and text), ``paragraph`` (number of the line), ``start, length``
    (code points), ``words, n`` (shingles), ``node, bands, sketch``."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i, _, found, hashes, begins in paragraph_sets(b.column(2), least):
                if not len(found["doc"]):
                    continue
                sig = signatures(hashes, begins)
                bands = sig[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS) * _KEYS[:ROWS]
                keys = T.mix(bands.sum(2, dtype=_U) + np.arange(BANDS).astype(_U) * _KEYS[SIZE])
                sketch = T.mix(sig).astype(np.uint8)
                doc = pa.array(found.pop("doc") + i)
                columns = {"key": b.column(0).take(doc), "row": b.column(1).take(doc)}
                columns |= {k: pa.array(v.astype(np.int64)) for k, v in found.items()}
                columns |= {
                    "n": pa.array(np.diff(begins)),
                    "node": pa.array(set_identities(hashes, begins).view(np.int64)),
                    "bands": row_lists(keys),
                    "sketch": row_lists(sketch)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select(key, F.xxhash64(key, text), text).mapInArrow(
        run, f"key {kind}, row long, paragraph long, start long, length long, words long, n long, "
             "node long, bands array<long>, sketch array<tinyint>")


def repeated_paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text",
                        least: int = LEAST, similarity: float = SIMILARITY) -> DataFrame:
    """One row per paragraph that has a like: ``key, row, paragraph, start, length, words``,
    ``class_key, class_row, class_paragraph`` (the one that stays), ``class_size``, ``removed``."""
    spark = docs.sparkSession
    # Signatures are most of the disk: each folder of them goes when what rests on it is stored.
    wide_at, nodes_at = (scratch_path(spark, n) for n in ("sub-paragraphs", "sub-nodes"))
    wide = stored_at(paragraphs(docs, key, text, least), wide_at)
    nodes = stored_at(wide.groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "row", "paragraph")).alias("best"),
        F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")), nodes_at)
    found = stored(wide.select("key", "row", "paragraph", "start", "length", "words", "node"),
                   "sub-found")
    delete_path(spark, wide_at)

    def sets_of(column):
        return paragraph_sets(column, least)

    _, roots = linked(nodes, lambda marks: marked_sets(docs, text, marks, sets_of), SIZE, AGREE,
                      similarity)
    rooted = nodes.select("node", "copies", "best").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    classes = stored(rooted.groupBy("root").agg(
        F.min("best").alias("best"), F.sum("copies").alias("class_size"))
        .where("class_size > 1"), "sub-classes")
    of_node = stored(rooted.select("node", "root").join(classes, "root")
                     .select("node", "best", "class_size"), "sub-of-node")
    delete_path(spark, nodes_at)
    out = found.join(of_node, "node")
    same = [F.col(c).eqNullSafe(F.col(f"best.{c}")) for c in ("key", "row", "paragraph")]
    return out.select("key", "row", "paragraph", "start", "length", "words",
                      F.col("best.key").alias("class_key"), F.col("best.row").alias("class_row"),
                      F.col("best.paragraph").alias("class_paragraph"), "class_size",
                      (~(same[0] & same[1] & same[2])).alias("removed"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST,
                   similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``repeated_paragraphs``, and one per span of passages that repeat wherever they
    stand (``repeated_passages``): it has no ``paragraph`` and no class. Both are found in whole
    texts, so they may overlap, and ``removed`` goes by the row's own kind: what one kind keeps the
    other may remove. ``drop_repeats`` cuts lines first and looks for passages in what is left."""
    lines = repeated_paragraphs(docs, key, text, least, similarity)
    spans = repeated_passages(docs, key, text)
    return lines.unionByName(spans, allowMissingColumns=True)


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST,
                 similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with all columns, the removed paragraphs cut out of the texts, then what is left
    of passages that documents share inside lines or across them (passages.py)."""
    names = docs.columns
    lines = stored(drop_lines(docs, key, text, least, similarity).toDF(
        *(f"c{i}" for i in range(len(names)))), "sub-lines")
    k, t = (f"c{names.index(c)}" for c in (key, text))
    return drop_passages(lines, k, t).toDF(*names)


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST,
               similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with all columns, the removed paragraphs cut out of the texts."""
    names = docs.columns
    k, t = (f"c{names.index(c)}" for c in (key, text))
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    cuts = (repeated_paragraphs(docs, key, text, least, similarity).where("removed")
            .groupBy(F.col("row").alias("_row"))
            .agg(F.collect_set("paragraph").alias("_cut")))
    rows = plain.withColumn("_row", F.xxhash64(k, t)).join(cuts, "_row", "left")
    left = F.filter(F.split(t, "\n"), lambda line, i: ~F.array_contains("_cut", i.cast("long")))
    return rows.withColumn(t, F.when(F.col("_cut").isNull(), F.col(t))
                           .otherwise(F.array_join(left, "\n"))).select(*plain.columns).toDF(*names)
