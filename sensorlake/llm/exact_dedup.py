"""Exact dedup by composable polynomial fingerprints.

A text, normalised to UTF-8 bytes with A-Z lower-cased, is cut into chunks. Each chunk is hashed
on its own modulo two primes below 2^31; chunk hashes combine into the text's fingerprint by
length-shifted arithmetic, H(ab) = H(a) * base^len(b) + H(b). Fingerprint (both residues) and length
name a candidate group. A group of several rows then undergoes a chunkwise comparison: every
member's chunks stream against those of the group's row with the largest key, and members that
differ anywhere are regrouped among themselves until none is left, so no result rests on a hash.

Scale: texts are read twice and shuffled only where their fingerprint repeats. A bitmap of fixed
size (``BITMAP_BITS``) over the repeated fingerprints lets the second read skip almost all other
texts; a false hit only costs a shuffled text, so the result is the same at every size. Groups are
counted with map-side combine and compared by a join whose hot keys adaptive execution splits.

Defined cases: null text counts as empty and equals empty; of equal texts the largest key stays
and a null key is the smallest; rows repeated with the same key all get the same answer and
``drop_copies`` keeps one of them; an empty table gives an empty result; extra columns are not read
(or pass through ``drop_copies``), whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import text as T
from .common import bitmap, stored

PRIMES = (2147483629, 2147483587)
BASES = (1103515245, 1402024253)
#: 31-bit powers times 8-bit bytes over so many places stay below 2^53: exact in a float64 product.
CHUNK = 8192
#: Chunks of the comparison; a member's texts meet the kept text this many bytes at a time.
COMPARE = 1 << 16
BITMAP_BITS = 1 << 23
_ID = ["_fp", "_len"]


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out, x = np.empty(n), 1
    for i in range(n):
        out[i], x = x, x * base % prime
    return out


#: The last n rows are the weights of the bytes of a chunk of n bytes.
_WEIGHTS = np.ascontiguousarray(
    np.stack([_powers(b, p, CHUNK) for b, p in zip(BASES, PRIMES, strict=True)], 1)[::-1])


def combine(a: tuple[int, ...], b: tuple[int, ...], b_len: int) -> tuple[int, ...]:
    """Residues of the joined bytes, from those of the two parts."""
    return tuple((x * pow(base, b_len, p) + y) % p
                 for x, y, base, p in zip(a, b, BASES, PRIMES, strict=True))


def chunk_residues(data: np.ndarray) -> tuple[int, ...]:
    """Residues of one chunk of at most CHUNK bytes."""
    sums = data.astype(np.float64) @ _WEIGHTS[CHUNK - len(data):]
    return tuple(int(s) % p for s, p in zip(sums, PRIMES, strict=True))


def fingerprint(data: bytes) -> int:
    """62-bit fingerprint: both residues of the whole text, combined from its chunks'."""
    view = np.frombuffer(data, np.uint8)
    total = (0, 0)
    for at in range(0, len(view), CHUNK):
        part = view[at:at + CHUNK]
        total = combine(total, chunk_residues(part), len(part)) if at else chunk_residues(part)
    return total[0] << 31 | total[1]


def _normal(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield (value.as_py() or "").encode().lower()  # bytes.lower() changes A-Z only


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 of: Callable[[bytes], int] = fingerprint) -> DataFrame:
    """``_key, _fp, _len, _sha`` of every row: fingerprint, length in bytes, SHA-256."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            fp, n, sha = [], [], []
            for data in _normal(b.column(1)):
                fp.append(of(data))
                n.append(len(data))
                sha.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fp, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(sha, pa.string())], names=["_key", "_fp", "_len", "_sha"])

    return docs.select(key, text).mapInArrow(
        run, f"_key {kind}, _fp long, _len long, _sha string")


def _chunks(docs: DataFrame, key: str, text: str, bitmap: bytes, of: Callable[[bytes], int],
            compare: int) -> DataFrame:
    """``_key, _fp, _len, _sha, _no, _chunk``: the rows whose fingerprint may be repeated, by
    chunk."""
    kind = docs.schema[key].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(bitmap)  # of fixed size
    names = ["_key", "_fp", "_len", "_sha", "_no", "_chunk"]

    def run(batches: Iterator[pa.RecordBatch]):
        marks = np.frombuffer(held.value, np.uint8)
        for b in batches:
            at, rows, size = [], [], 0
            for i, data in enumerate(_normal(b.column(1))):
                slot = (fp := of(data)) % (8 * len(marks))
                if marks[slot >> 3] >> (slot & 7) & 1:
                    sha = hashlib.sha256(data).hexdigest()
                    for no in range(max(1, -(-len(data) // compare))):
                        part = data[no * compare:(no + 1) * compare]
                        at.append(i)
                        rows.append((fp, len(data), sha, no, part))
                        size += len(part)
                if rows and size >= 8 << 20:
                    yield _chunk_batch(b, at, rows, names)
                    at, rows, size = [], [], 0
            if rows:
                yield _chunk_batch(b, at, rows, names)

    return docs.select(key, text).mapInArrow(
        run, f"_key {kind}, _fp long, _len long, _sha string, _no int, _chunk binary")


def _chunk_batch(b: pa.RecordBatch, at: list[int], rows: list[tuple], names: list[str]):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [b.column(0).take(pa.array(at)),
         *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))],
        names=names)


def copy_groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
                of: Callable[[bytes], int] = fingerprint, bits: int = BITMAP_BITS,
                compare: int = COMPARE) -> DataFrame:
    """One row per input row: ``_key``, ``_keep`` (key of the row that stays), ``_size`` of its
    group, ``_sha`` of its normalised text."""
    groups = stored(
        fingerprints(docs, key, text, of).groupBy(*_ID).agg(
            F.count(F.lit(1)).alias("_size"), F.max("_key").alias("_keep"),
            F.max("_sha").alias("_sha")), "dedup-groups")
    out = groups.where("_size = 1").select(F.col("_keep").alias("_key"), "_keep", "_size", "_sha")
    groups = groups.where("_size > 1").drop("_sha")
    rest = stored(_chunks(docs, key, text, bitmap(groups, "_fp", bits), of, compare), "dedup-chunks")
    while True:
        heads = rest.where("_no = 0").drop("_no", "_chunk")
        kept = stored(rest.groupBy(*_ID, "_no").agg(
            F.max(F.struct("_key", "_sha", "_chunk")).alias("_best"))
            .select(*_ID, "_no", F.col("_best._chunk").alias("_kept")), "dedup-kept")
        differ = stored(rest.join(kept, [*_ID, "_no"]).where("_chunk <> _kept")
                        .select("_key", *_ID, "_sha").distinct(), "dedup-differ")
        if differ.isEmpty():
            return out.unionByName(heads.join(groups, _ID)
                                   .select("_key", "_keep", "_size", "_sha"))
        # Different texts under one fingerprint: those equal to the kept one are done, the others
        # go round again.
        same = [F.col("a._key").eqNullSafe(F.col("b._key")),
                *(F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*_ID, "_sha"))]
        equal = stored(heads.alias("a").join(differ.alias("b"), same, "left_anti"), "dedup-equal")
        sums = stored(equal.groupBy(*_ID).agg(F.count(F.lit(1)).alias("_size"),
                                              F.max("_key").alias("_keep")), "dedup-sums")
        true = sums.join(groups.select(*_ID), _ID, "left_semi")  # others are alone, in `out` already
        out = out.unionByName(equal.join(true, _ID).select("_key", "_keep", "_size", "_sha"))
        rest = stored(rest.alias("a").join(differ.alias("b"), same, "left_semi"), "dedup-rest")
        groups = stored(rest.where("_no = 0").groupBy(*_ID).agg(
            F.count(F.lit(1)).alias("_size"), F.max("_key").alias("_keep")), "dedup-groups")


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, of equal texts only the row that stays."""
    names, at = docs.columns, docs.columns.index(text)
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    k = f"c{names.index(key)}"
    kept = (copy_groups(docs, key, text).where(F.col("_key").eqNullSafe(F.col("_keep")))
            .select(_row_id("_key")).distinct())

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            sha = [hashlib.sha256(data).hexdigest() for data in _normal(b.column(at))]
            yield b.append_column("_sha", pa.array(sha, pa.string()))

    kinds = StructType([*plain.schema.fields, StructField("_sha", StringType())])
    rows = plain.mapInArrow(run, kinds).withColumn("_id", _row_id(k)).drop("_sha")
    return rows.join(kept, "_id").dropDuplicates(["_id"]).drop("_id").toDF(*names)


def _row_id(key: str):
    return F.concat_ws("|", "_sha", F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("_id")
