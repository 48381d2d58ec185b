"""Spelling variants of words by Bloom-guided neighbourhoods.

Words that occur often enough are a vocabulary with counts. Two words are near when one edit (a
code point inserted, deleted or replaced) turns one into the other. Every word generates its
deletions and its replacements by a larger code point of the alphabet, as hashes only: an edit
changes a polynomial hash by one term, so numpy makes all edits of a word at once. The hashes probe
blocked Bloom filters, one per word length, broadcast to all tasks: a key's bits lie in one block of
64 bytes. Only edits that the filter of their length holds are spelled out; they meet the vocabulary
in an exact join by word, which removes false positives. An insertion is a deletion seen from the
other word, a replacement by a smaller code point a replacement by a larger one, so each near pair
is found once and counted for both ends.

Scale: counting combines map-side. Filters of one pass take at most ``PASS_BYTES`` together, whatever
the vocabulary: lengths are dealt to passes, and a length whose filter alone is larger is cut into
slices of its hashes, a pass each. A word has at most one neighbour a place and code point of the
alphabet, so no key of the join is hot. Forms are followed by pointer doubling; counts grow tenfold
with every step, so chains are short.

Defined cases: a null or empty text has no words; a null key counts as an empty one; a very long text
is one row; equal counts go to the word smallest in code-point order; rows with equal keys count
each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .text import mix

#: What a run of letters is, and the code points that an edit may bring in.
RUN = "[A-Za-zÀ-ÿ]+"
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
#: One run in so many loses a code point.
DROP = 31
#: Bits of a filter per word, words of 64 bits in a block, bits that a key sets in its block.
BITS, BLOCK, PROBES = 16, 8, 6
PASS_BYTES = 32 << 20
#: Words whose edits one task makes.
TASK_WORDS = 5_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text",
                letters: int = LEAST_LETTERS, least: int = LEAST_COUNT,
                drop: int = DROP) -> DataFrame:
    """``word, n``: the words of at least ``letters`` code points that occur ``least`` times. A
    run whose checksum with its document ``drop`` divides loses one code point."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
                       F.explode(F.regexp_extract_all(text, F.lit(RUN), 0)).alias("_run"))
    runs = runs.where(F.char_length("_run") >= letters).select(
        "_key", F.translate("_run", UPPER, LOWER).alias("_run"))
    crc = F.crc32(F.concat("_key", F.lit(":"), "_run").cast("binary"))
    at = (F.col("_crc") % F.char_length("_run")).cast("int")
    cut = F.concat(F.col("_run").substr(F.lit(1), at),
                   F.col("_run").substr(at + 2, F.char_length("_run")))
    words = runs.withColumn("_crc", crc).select(
        F.when(F.col("_crc") % drop == 0, cut).otherwise(F.col("_run")).alias("word"))
    return (words.where(F.char_length("word") >= letters).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least))


def powers(n: int) -> np.ndarray:
    return np.cumprod(np.r_[_U(1), np.full(max(n, 1) - 1, _BASE, _U)])


def bits_of(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and its bits there as a row of ``BLOCK`` words."""
    block = ((hashes >> _U(32)) * _U(blocks)) >> _U(32)
    more, bits = mix(hashes), np.zeros((len(hashes), BLOCK), _U)
    rows = np.arange(len(hashes))
    for i in range(PROBES):
        bit = (more >> _U(9 * i)) & _U(BLOCK * 64 - 1)
        np.bitwise_or.at(bits, (rows, (bit >> _U(6)).astype(np.int64)), _U(1) << (bit & _U(63)))
    return block.astype(np.int64), bits


class Filter:
    """Blocked Bloom filter of one length (and slice of the hashes)."""

    def __init__(self, words: np.ndarray):
        self.words = words.reshape(-1, BLOCK)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that it may hold; most others fail at their first bit."""
        left = np.arange(len(hashes))
        if not len(left):
            return left
        block = (((hashes >> _U(32)) * _U(len(self.words))) >> _U(32)).astype(np.int64)
        more, flat = mix(hashes), self.words.ravel()
        for i in range(PROBES):
            bit = (more[left] >> _U(9 * i)) & _U(BLOCK * 64 - 1)
            word = flat[block[left] * BLOCK + (bit >> _U(6)).astype(np.int64)]
            left = left[(word >> (bit & _U(63))) & _U(1) == 1]
        return left


def code_points(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def hashes_of(codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(_U) @ powers(codes.shape[1]))


def _by_length(column: pa.Array, most: int = 4096) -> Iterator[list[str]]:
    """The words of a batch in lists of one length, of at most ``most`` words or 16 times as many
    code points."""
    lists: dict[int, list[str]] = {}
    for w in column.to_pylist():
        lists.setdefault(len(w), []).append(w)
    for length, words in lists.items():
        each = max(1, min(most, 16 * most // length))
        for i in range(0, len(words), each):
            yield words[i:i + each]


def filter_sizes(lengths: dict[int, int]) -> list[dict[int, tuple[int, int, int]]]:
    """Passes over the lengths' counts of words: per pass {length: (blocks, slice, slices)}, the
    filters of a pass within ``PASS_BYTES``."""
    passes, room = [], 0
    for length, n in sorted(lengths.items()):
        blocks = -(-n * BITS // (64 * BLOCK)) + 1
        slices = -(-blocks * 8 * BLOCK // PASS_BYTES)
        blocks = -(-blocks // slices)
        for i in range(slices):
            if not passes or blocks * 8 * BLOCK > room or length in passes[-1]:
                passes.append({})
                room = PASS_BYTES
            passes[-1][length] = (blocks, i, slices)
            room -= blocks * 8 * BLOCK
    return passes


def _slice(hashes: np.ndarray, slices: int) -> np.ndarray:
    return (hashes & _U(0xFFFFFFFF)) % _U(slices)


def filters(words: DataFrame, sizes: dict[int, tuple[int, int, int]]) -> dict[int, Filter]:
    """The filters of one pass over the words, merged by Spark block by block."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for same in _by_length(b.column(0)):
                if len(same[0]) not in sizes:
                    continue
                blocks, part, slices = sizes[len(same[0])]
                hashes = hashes_of(code_points(same))
                block, bits = bits_of(hashes[_slice(hashes, slices) == part], blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block), len(same[0]), np.int32)), pa.array(block),
                     *(pa.array(bits[:, i].view(np.int64)) for i in range(BLOCK))],
                    names=["length", "block", *(f"b{i}" for i in range(BLOCK))])

    columns = [f"b{i}" for i in range(BLOCK)]
    merged = (words.select("word").mapInArrow(
        run, "length int, block long, " + ", ".join(f"{c} long" for c in columns))
        .groupBy("length", "block").agg(*(F.bit_or(c).alias(c) for c in columns)))
    out = {length: np.zeros((blocks, BLOCK), np.int64) for length, (blocks, _, _) in sizes.items()}
    for b in merged.toArrow().to_batches():  # at most PASS_BYTES of filters
        length, block = b.column(0).to_numpy(), b.column(1).to_numpy()
        bits = np.stack([b.column(i + 2).to_numpy() for i in range(BLOCK)], 1)
        for n in np.unique(length):
            out[int(n)][block[length == n]] = bits[length == n]
    return {length: Filter(words.view(_U)) for length, words in out.items()}


def _positives(same: list[str], held: dict[int, Filter], sizes: dict):
    """(word's place, edit) for the deletions and larger replacements of words of one length that
    their filter holds."""
    codes = code_points(same)
    n, length = codes.shape
    up = powers(length)
    wide = codes.astype(_U)
    whole = wide @ up

    def found(raw: np.ndarray, to: int) -> np.ndarray:
        blocks, part, slices = sizes[to]
        hashes = mix(raw)
        if slices > 1:
            own = np.flatnonzero(_slice(hashes, slices) == part)
            return own[held[to].holds(hashes[own])]
        return held[to].holds(hashes)

    if length in held:
        letters = np.array(ALPHABET, np.uint32)
        for i in range(length):
            step = letters[None, :].astype(_U) - wide[:, i:i + 1]
            at, letter = np.nonzero(letters[None, :] > codes[:, i:i + 1])
            raw = whole[at] + step[at, letter] * up[i]
            for j in found(raw, length):
                w = same[at[j]]
                yield at[j], w[:i] + chr(letters[letter[j]]) + w[i + 1:]
    if length - 1 in held:
        # Without place i: what stands before it keeps its powers, what follows moves down by one.
        terms = wide * up
        before = np.cumsum(terms, 1) - terms
        lower = wide[:, 1:] * up[:-1]
        after = np.concatenate([np.cumsum(lower[:, ::-1], 1)[:, ::-1], np.zeros((n, 1), _U)], 1)
        raw = (before + after).ravel()
        for j in found(raw, length - 1):
            at, i = divmod(int(j), length)
            if i == 0 or codes[at, i] != codes[at, i - 1]:  # a run of equal letters has one deletion
                yield at, same[at][:i] + same[at][i + 1:]


def near_words(words: DataFrame) -> DataFrame:
    """``a, b``: each pair of near words of ``words`` (a stored table ``word, n``) once."""
    spark = words.sparkSession
    lengths = {r[0]: r[1] for r in words.groupBy(F.char_length("word")).count().collect()}
    dealt = words.repartition(sum(lengths.values()) // TASK_WORDS + 1, "word")
    pairs = None
    for sizes in filter_sizes(lengths):
        found = _probe(spark, dealt, filters(words, sizes), sizes)
        found = found.join(words.select(F.col("word").alias("b")), "b").select("a", "b")
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        return spark.createDataFrame([], "a string, b string")
    return pairs


def _probe(spark: SparkSession, words: DataFrame, made: dict[int, Filter], sizes: dict):
    held = spark.sparkContext.broadcast(made)  # at most PASS_BYTES

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for same in _by_length(b.column(0), 512):
                got = [(same[i], edit) for i, edit in _positives(same, held.value, sizes)]
                if got:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), pa.string()) for c in zip(*got, strict=True)],
                        names=["a", "b"])

    return words.select("word").mapInArrow(run, "a string, b string")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a stored table ``word, n``. The form of a word
    is its most frequent near word, if that is ``ratio`` times as frequent; the root is the last
    word that forms lead to."""
    pairs = stored(near_words(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = (both.join(words.withColumnsRenamed({"word": "b", "n": "n_b"}), "b")
            .groupBy("a").agg(F.count(F.lit(1)).alias("n_near"),
                              F.min(F.struct((-F.col("n_b")).alias("less"),
                                             F.col("b").alias("word"))).alias("best")))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    formed = stored(
        words.join(near.withColumnRenamed("a", "word"), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles how far a word has come
        roots = stored(roots, "spelling-roots")
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("on"))
        if roots.join(on, "root", "left_semi").isEmpty():
            break
        roots = roots.join(on, "root", "left").select("word", F.coalesce("on", "root").alias("root"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of ``docs`` with their forms and roots."""
    return variants(stored(word_counts(docs, key, text), "spelling-words"))
