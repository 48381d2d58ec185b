"""Sharding by jump consistent hashing.

A row's key names its shard with no ring and no table: the first 64 bits of the key's MD5 seed a
linear congruential generator, whose numbers say at which shard counts the key would jump to the
newest shard; the last jump below the count is the shard (Lamping and Veach, 2014). The key and the
number of shards alone decide, so a row finds its shard on its own, and appending a shard moves
1 / (n + 1) of the keys, all of them into the new one.

Slots number the rows of a shard from 0 without gaps, in the order of (key hash, key, size,
checksum). Equal rows are counted map-side first; ranges of the hash are buckets, whose counts give
each bucket its first slot, so no shard is ever numbered by one task, and a row that repeats without
end is one counted group until it is dealt out in runs of ``RUN`` slots.

Defined cases: a null key counts as an empty one and stays null; a null text has no bytes and the
checksum of an empty text; rows with equal keys share a shard and follow each other; repeated rows
get a slot each; an empty table gives an empty result; extra columns are not read (or pass through
``with_shards``, whatever their names, but for one called like the new column, which it replaces).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS = 24
#: Bytes that a row takes beside its text.
ROW_BYTES = 8
#: Rows that a bucket of hashes holds on average, and slots that one row of a run stands for.
BUCKET_ROWS, RUN = 2_000, 10_000
_STEP = np.uint64(2862933555777941757)
_ROW = ["_shard", "_grown", "_hash", "_key", "_size", "_crc"]


def jump(keys: np.ndarray, counts: tuple[int, ...]) -> list[np.ndarray]:
    """The shard of each unsigned 64-bit key for every number of shards in ``counts``."""
    out = [np.zeros(len(keys), np.int32) for _ in counts]
    open_, state, at = np.arange(len(keys)), keys.astype(np.uint64), np.zeros(len(keys), np.int64)
    while len(open_):
        for shard, n in zip(out, counts, strict=True):
            inside = at < n
            shard[open_[inside]] = at[inside]
        state = state * _STEP + np.uint64(1)
        spread = float(1 << 31) / ((state >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        at = ((at + 1) * spread).astype(np.int64)
        going = at < max(counts)
        open_, state, at = open_[going], state[going], at[going]
    return out


def key_hash(key: Column) -> Column:
    """The first 64 bits of the MD5 of a key's text, as a signed number."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 16), 16, -10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key (int) among ``shards``."""
    return _jumps(shards, shards)(key_hash(key))["shard"]


def _jumps(shards: int, grown: int):
    if shards < 1:
        raise ValueError("shards must be 1 or more")

    @F.pandas_udf("shard int, grown int")
    def run(hashes: pd.Series) -> pd.DataFrame:
        found = jump(hashes.to_numpy(np.int64).view(np.uint64), (shards, grown))
        return pd.DataFrame(dict(zip(("shard", "grown"), found, strict=True)))

    return run


def with_shards(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS,
                column: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row; no shuffle."""
    return docs.withColumn(column, shard_of(docs[key], shards))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS,
                 files: int = 1) -> None:
    """Write ``docs`` as Parquet, a folder ``_shard=<n>`` each. Rows of a shard are spread over
    ``files`` tasks at random, so a shard whose key is hot is not one task's to write."""
    salt = F.floor(F.rand(seed=7) * files)
    (with_shards(docs, key, shards, "_shard").repartition(shards * files, "_shard", salt)
     .write.partitionBy("_shard").parquet(path))


def placed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text",
                shards: int = SHARDS) -> DataFrame:
    """``key, size, text_crc32, shard, slot, grown_shard`` of every row: bytes of its text and
    ``ROW_BYTES``, checksum, shard, place there, and the shard with one shard more."""
    data = F.coalesce(F.col("_text"), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).select(
        "_key", key_hash(F.col("_key")).alias("_hash"),
        (F.octet_length(data) + ROW_BYTES).cast("long").alias("_size"),
        F.crc32(data).alias("_crc"))
    at = _jumps(shards, shards + 1)(F.col("_hash"))
    groups = stored(
        rows.withColumn("_at", at)
        .groupBy(F.col("_at.shard").alias("_shard"), F.col("_at.grown").alias("_grown"),
                 "_hash", "_key", "_size", "_crc").agg(F.count(F.lit(1)).alias("_n")),
        "shard-rows")
    bits = max(0, (groups.count() // (BUCKET_ROWS * shards)).bit_length())
    bucket = F.shiftright("_hash", 64 - bits) if bits else F.lit(0).cast("long")
    groups = groups.withColumn("_bucket", bucket)
    sums = groups.groupBy("_shard", "_bucket").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy("_shard").orderBy("_bucket")
    first = sums.select("_shard", "_bucket",
                        (F.sum("_rows").over(before) - F.col("_rows")).alias("_first"))
    order = Window.partitionBy("_shard", "_bucket").orderBy("_hash", "_key", "_size", "_crc") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = (groups.withColumn("_upto", F.sum("_n").over(order))
            .join(first, ["_shard", "_bucket"])
            .select(*_ROW, "_n", (F.col("_first") + F.col("_upto") - F.col("_n")).alias("_slot")))
    many = (runs.where(F.col("_n") > RUN)
            .withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"),
                                                     F.floor((F.col("_n") - 1) / RUN))))
            .select(*_ROW, F.least(F.lit(RUN), F.col("_n") - F.col("_run") * RUN).alias("_n"),
                    (F.col("_slot") + F.col("_run") * RUN).alias("_slot"))
            .repartition("_shard", "_slot"))
    few = runs.where(F.col("_n") <= RUN)
    return (few.unionByName(many)
            .withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
            .select(F.col("_key").alias("key"), F.col("_size").alias("size"),
                    F.col("_crc").alias("text_crc32"), F.col("_shard").alias("shard"),
                    (F.col("_slot") + F.col("_i")).alias("slot"),
                    F.col("_grown").alias("grown_shard")))
