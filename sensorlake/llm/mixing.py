"""Mixing sources to target weights, in fixed-length blocks. DataFrame functions only.

The documents of a source, in pseudorandom order, form one stream of words cut into blocks of
``block`` words. A source with N blocks and target t fills round(t * N / size) slots of the mix,
numbered from 0: slot j reads block perm(j mod N) of the source, with another pseudorandom index
permutation for each pass j div N, so no block is read a third time before all were read twice.
Where the slots go in the output is one more permutation, of all slots: the number of slots that a
source gets in each output shard is thereby a multinomial draw conditioned on the sources' totals.
Unconditioned draws would miss a source's target by the square root of its slots and could pass the
limit of two readings. Slots and blocks meet in a join by (source, block index).

A permutation of 0..n-1 is a swap-or-not shuffle: in each round an index x and its partner
(key - x) mod n change places if a hash of the larger says so, which works for any n.

Scale: positions in a source's stream are sums over hash buckets of the source plus running sums
inside a bucket, so a hot source spreads over as many tasks as any other rows; only the table of
sources (one row each) is ordered in one task. Nothing is collected but the number of rows.

Defined cases: null text has no words; a null source is a source, last in order; a document without
words is never taken; documents with equal keys or equal rows are separate rows; an empty table
gives an empty result; reruns give the same mix; extra columns are not read by ``mixture`` and pass
through ``mixed_documents`` whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2
BLOCK = 128
SHARD = 8192
ROUNDS = 24
BUCKET_ROWS = 20_000
_ROW = ["_no", "_bucket", "_rn"]


def permuted(x, n, seed):
    """Where a pseudorandom permutation of 0..n-1 keyed by ``seed`` puts x."""
    def turn(at, r):
        partner = F.pmod(F.pmod(F.xxhash64(seed, r), n) - at, n)
        swap = F.xxhash64(r, seed, F.greatest(at, partner)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(at)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), turn)


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE,
            cap: float = CAP) -> DataFrame:
    """Adds ``_no`` (order of the sources), ``weight`` and ``target``: ``share`` of all sizes dealt
    by weight, at most ``cap`` times a source's size, the excess dealt again by weight. In order of
    size / weight a source is capped if its share of what is left reaches its cap."""
    everything = Window.partitionBy()
    ranked = sources.withColumn("_no", F.row_number().over(
        Window.orderBy(F.asc_nulls_last("source"))) - 1)
    ranked = ranked.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), F.pmod("_no", F.lit(len(weights))) + 1))
    ranked = ranked.withColumn("_cap", cap * F.col("source_size"))
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), "_no")
    so_far = rising.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranked
              .withColumn("_all", share * F.sum("source_size").over(everything))
              .withColumn("_left", F.col("_all") - F.coalesce(F.sum("_cap").over(so_far),
                                                              F.lit(0.0)))
              .withColumn("_w", F.sum("weight").over(
                  rising.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("_capped", F.col("_cap") * F.col("_w")
                          <= F.col("weight") * F.col("_left")))
    rest = F.col("_all") - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0.0)).over(
        everything)
    free = F.sum(F.when(F.col("_capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    return ranked.withColumn("target", F.when(F.col("_capped"), F.col("_cap").cast("double"))
                             .otherwise(F.col("weight") * rest / free)).drop(
        "_all", "_left", "_w", "_capped", "_cap")


@dataclass
class Mixture:
    """``sources``: order, size, target and slots of each source. ``placements``: a row for each
    time that part of a document is read (``shard``, ``slot``, ``pass``; words ``start`` to
    ``start + words`` of the document), and one with null shard for a part that is not.
    ``rows``: a function that gives a DataFrame's rows the ids of ``placements``."""
    sources: DataFrame
    placements: DataFrame
    rows: object


def _hashed(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """Adds the words of each row and a hash of it."""
    return docs.withColumns({
        "_size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "_h": F.xxhash64(F.lit(seed), F.col(key), F.col(text), F.col(source))})


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
            block: int = BLOCK, shard: int = SHARD, weights=WEIGHTS, share: float = SHARE,
            cap: float = CAP, seed: int = 1) -> Mixture:
    narrow = stored(
        _hashed(docs.select(key, text, source), key, text, source, seed)
        .select(F.col(key).alias("key"), F.col(source).alias("source"), "_size", "_h"),
        "mix-sizes")
    sources = targets(
        narrow.groupBy("source").agg(F.sum("_size").alias("source_size"),
                                     F.count(F.lit(1)).alias("source_rows")),
        weights, share, cap)
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    slots = F.when(F.col("source_size") > 0,
                   F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0)
    sources = stored(
        sources.withColumn("blocks", blocks).withColumn("slots", slots.cast("long"))
        .withColumn("first_slot", F.sum("slots").over(
            Window.orderBy("_no").rowsBetween(Window.unboundedPreceding, 0)) - F.col("slots"))
        .withColumn("all_slots", F.sum("slots").over(Window.partitionBy())), "mix-sources")
    total = sources.agg(F.sum("source_rows")).first()[0] or 0
    buckets = max(64, -(-total // BUCKET_ROWS))
    info = sources.select("_no", F.col("source").alias("_source"), "source_size", "target")

    def rows(df: DataFrame, key: str = "key", source: str = "source") -> DataFrame:
        """Adds ``_no, _bucket, _rn``, the id of each row, and ``_at``, words before it in its
        bucket. ``df`` has ``_size`` and ``_h``."""
        df = df.join(info, df[source].eqNullSafe(F.col("_source"))).drop("_source")
        df = df.withColumn("_bucket", F.pmod("_h", F.lit(buckets)).cast("int"))
        w = Window.partitionBy("_no", "_bucket").orderBy("_h", key, "_size")
        return df.withColumns({
            "_rn": F.row_number().over(w),
            "_at": F.sum("_size").over(w.rowsBetween(Window.unboundedPreceding, 0))
            - F.col("_size")})

    sums = rows(narrow).groupBy("_no", "_bucket").agg(F.sum("_size").alias("_words"))
    w = Window.partitionBy("_no").orderBy("_bucket")
    starts = sums.select("_no", "_bucket", (F.sum("_words").over(w) - F.col("_words")).alias(
        "_first"))
    placed = rows(narrow).join(starts, ["_no", "_bucket"])
    placed = placed.withColumn("_from", F.col("_first") + F.col("_at")).withColumn(
        "_to", F.col("_from") + F.col("_size"))
    last = F.greatest(F.col("_to") - 1, F.col("_from"))
    parts = placed.select(
        *_ROW, "key", F.col("_size").alias("size"), "source_size", "target", "_from", "_to",
        F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor(last / block)))
        .alias("block"))
    begin = F.greatest(F.col("block") * block, F.col("_from"))
    parts = parts.withColumn("start", begin - F.col("_from")).withColumn(
        "words", F.least((F.col("block") + 1) * block, F.col("_to")) - begin).withColumn(
        "block", F.when(F.col("words") > 0, F.col("block"))).drop("_from", "_to")

    step, tasks = 4096, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = (sources.where("slots > 0")
             .select("_no", "blocks", "slots", "first_slot", "all_slots", F.explode(
                 F.expr(f"sequence(0L, (slots - 1) div {step})")).alias("_part"))
             .repartition(tasks, "_no", "_part")
             .select("_no", "blocks", "first_slot", "all_slots", F.explode(F.expr(
                 f"sequence(_part * {step}, least(_part * {step} + {step}, slots) - 1)"))
                 .alias("j")))
    drawn = drawn.withColumn("pass", F.expr("j div blocks"))
    drawn = drawn.select(
        "_no", "pass",
        permuted(F.pmod("j", "blocks"), F.col("blocks"),
                 F.xxhash64(F.lit(seed), "_no", "pass")).alias("block"),
        permuted(F.col("first_slot") + F.col("j"), F.col("all_slots"), F.lit(seed))
        .alias("_place"))
    # Written, so that the join below knows its size: the few rows it grows from say nothing.
    drawn = stored(drawn.select(
        "_no", "block", "pass", F.expr(f"_place div {shard}").alias("shard"),
        F.pmod("_place", F.lit(shard)).alias("slot")), "mix-slots")
    return Mixture(sources, parts.join(drawn, ["_no", "block"], "left"), rows)


def shard_counts(m: Mixture) -> DataFrame:
    """How many slots each source has in each output shard."""
    taken = m.placements.where("shard IS NOT NULL")
    return taken.select("_no", "shard", "slot").distinct().groupBy("shard", "_no").count()


def taken_words(m: Mixture) -> DataFrame:
    """One row per document: ``key``, ``size``, ``source_size``, ``target``, ``taken`` (words,
    repeats counted) and ``first_shard``."""
    return m.placements.groupBy(*_ROW).agg(
        F.first("key").alias("key"), F.first("size").alias("size"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum(F.when(F.col("shard").isNull(), 0).otherwise(F.col("words"))).alias("taken"),
        F.min("shard").alias("first_shard")).drop(*_ROW)


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    source: str = "source", seed: int = 1, **options) -> DataFrame:
    """The mix as documents: a row for each document and pass in which any of it is taken, with all
    its columns; the text is the words taken in that pass, in order (the text itself where all
    are)."""
    m = mixture(docs, key, text, source, seed=seed, **options)
    spans = (m.placements.where("shard IS NOT NULL").groupBy(*_ROW, "pass")
             .agg(F.sort_array(F.collect_list(F.struct("start", "words"))).alias("_spans"),
                  F.sum("words").alias("_taken")))
    names = docs.columns
    k, t, s = (f"c{names.index(c)}" for c in (key, text, source))
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    wide = m.rows(_hashed(plain, k, t, s, seed), k, s).drop("_at", "target", "source_size", "_h")
    tokens = F.regexp_extract_all(t, F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    cut = F.array_join(F.flatten(F.transform("_spans", lambda x: F.slice(
        F.col("_tokens"), x["start"] + 1, x["words"]))), "")
    out = wide.join(spans, _ROW).withColumn(
        "_tokens", F.when(F.col("_taken") < F.col("_size"), tokens))
    out = out.withColumn(t, F.when(F.col("_taken") < F.col("_size"), cut).otherwise(F.col(t)))
    return out.select(*plain.columns).toDF(*names)
