"""Best-fit packing of token sequences by a configuration linear program.

Documents become token ids closed by an end token; only longer ones than ``size`` are cut, into
pieces of ``size`` tokens of which the first may be shorter. The lengths of all pieces form a
histogram of at most ``size`` entries. A configuration is a multiset of lengths that fits one
sequence; the linear program covers every length's count with as few configurations as it can.
Multiplicative weights solve it: a length's weight falls exponentially as it gets covered, a
knapsack dynamic program finds the configuration of largest weight, which is then used for a fraction
of what its rarest length still needs, as long as full configurations are found. Fractions are rounded
down, of several shares of the solution, and what rounding leaves goes best-fit, longest first, into
the fullest sequence that takes it. Where the best of these is more than ``EXCESS`` of the sequences
above what the tokens fill (few lengths, none that fill a sequence), configurations of any fill go on
until every length is covered, and as many steps of column generation as ``PIVOTS`` says try to
better that; the fewest sequences count.

Scale: only the histogram reaches the driver, and the plan that comes back is a table of rank
ranges whose size depends on ``size`` and not on the number of documents. Pieces get a rank within
their length as a bucket's offset plus a running number inside the bucket, buckets per length in
proportion to its count, so a length that a third of all pieces share spreads over many tasks. Each
piece then finds its sequence and place on its own by binary search.

Defined cases: a null or empty text is the end token alone; documents with equal keys, equal rows
and a null key are packed row by row; very long texts give many pieces; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SIZE = 1024
END = 2
BUCKET_ROWS = 1_000
#: Share of what the rarest length of a configuration needs that one step covers, and how fast
#: weights fall with coverage.
STEP, RATE = 0.25, 4.0
#: Shares of the fractional solution that roundings keep.
KEPT = (1.0, 0.9, 0.75, 0.5)
#: Share of the sequences above the bound from which more is tried, the share that ``generated`` may be
#: off the optimum, and its steps: bounded, so that the driver's time is, whatever the lengths.
EXCESS, NEAR, PIVOTS = 0.005, 1e-4, 300
_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


@lru_cache(maxsize=2)
def encoder(path: str):
    """Encoder of a byte-level BPE file (vocabulary by rank, special tokens in texts included):
    the ids are those that the tokenizers library gives with the same file."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    # The byte-level alphabet: printable bytes stand for themselves, others for 256 and above.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in word): i for word, i in spec["model"]["vocab"].items()
             if word not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=_PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
           tokenizer: str | None = None, end: int = END, with_ids: bool = True) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` and, ``with_ids``, the ``ids`` themselves as
    little-endian unsigned 32-bit numbers."""
    path = tokenizer or default_tokenizer()
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]):
        core = encoder(path)._core_bpe
        special = set(encoder(path).special_tokens_set)

        def batch(b, at, rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())),
                 *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

        for b in batches:
            at, rows, held = [], [], 0
            for i, value in enumerate(b.column(1)):
                ids = memoryview(bytes(core.encode_to_tiktoken_buffer(value.as_py() or "",
                                                                      special)) + last)
                n, piece, start = len(ids) // 4, 0, 0
                while start < n:
                    to = start + ((n - start) % size or size)
                    part = bytes(ids[4 * start:4 * to])
                    at.append(i)
                    rows.append((piece, start, to - start, zlib.crc32(part),
                                 *([part] * with_ids)))
                    piece, start = piece + 1, to
                held += 4 * n
                if held > 16 << 20:
                    yield batch(b, at, rows)
                    at, rows, held = [], [], 0
            if rows:
                yield batch(b, at, rows)

    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select(key, text).mapInArrow(run, schema + ", ids binary" * with_ids)


def _best_configuration(value: np.ndarray) -> np.ndarray:
    """Copies of each length in the configuration of largest total value that fits (index =
    length; value[0] is not used): unbounded knapsack over capacities."""
    size = len(value) - 1
    best, pick = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for c in range(1, size + 1):
        got = best[c - 1::-1] + value[1:c + 1]
        i = int(got.argmax())
        if got[i] > best[c - 1]:
            best[c], pick[c] = got[i], i + 1
        else:
            best[c], pick[c] = best[c - 1], 0
    out, c = np.zeros(size + 1, np.int64), size
    while c > 0:
        if pick[c]:
            out[pick[c]] += 1
        c -= max(1, pick[c])
    return out


def solve(counts: np.ndarray, step: float = STEP, rate: float = RATE,
          full: bool = False) -> list[tuple]:
    """Fractional cover of ``counts`` (index = length) as (configuration, amount); with ``full`` as
    far as full configurations go."""
    size = len(counts) - 1
    lengths = np.arange(size + 1)
    need = counts.astype(float)
    cover = np.where(need > 0, 0.0, 1.0)
    found: dict[bytes, float] = {}
    # Full sequences need no weights: nothing else fits beside such a piece.
    alone = np.zeros(size + 1, np.int64)
    alone[size] = 1
    if need[size]:
        found[alone.tobytes()] = need[size]
        cover[size] = 1.0
    while (open_ := cover < 1 - 1e-9).any():
        behind = rate * (cover - cover[open_].min())
        value = np.where(open_, lengths * np.exp(-behind), -1.0)
        made = _best_configuration(value)
        if full and (made * lengths).sum() < size:
            break
        used = made > 0
        amount = float(np.min(np.minimum(np.maximum(step * need[used], 1.0),
                                         (1 - cover[used]) * need[used]) / made[used]))
        found[made.tobytes()] = found.get(made.tobytes(), 0.0) + amount
        cover[used] += amount * made[used] / need[used]
    return [(np.frombuffer(c, np.int64), x) for c, x in found.items()]


def generated(counts: np.ndarray, near: float = NEAR) -> list[tuple]:
    """The linear program's own solution as (configuration, amount), for any histogram: a simplex
    basis of configurations, full or not; the knapsack over its prices finds the configuration
    that enters, until no solution can be better by ``near`` or by a whole sequence, or for
    ``PIVOTS`` steps; every step's basis is a solution."""
    size = len(counts) - 1
    own = np.flatnonzero(counts)
    basis = np.zeros((len(own), size + 1), np.int64)
    basis[np.arange(len(own)), own] = size // own
    inverse, amount = np.diag(1.0 / (size // own)), counts[own] / (size // own)
    for _ in range(PIVOTS):
        price = np.full(size + 1, -1.0)
        price[own] = inverse.sum(0)
        made = _best_configuration(price)
        used, worth = amount.sum(), float((made[own] * price[own]).sum())
        if used - used / max(worth, 1.0) < max(1.0, near * used):
            break
        move = inverse @ made[own]
        ratio = np.where(move > 1e-9, amount / np.maximum(move, 1e-9), np.inf)
        out = int(ratio.argmin())
        row, by = inverse[out] / move[out], ratio[out]
        inverse -= np.outer(move, row)
        amount = np.maximum(amount - by * move, 0.0)
        inverse[out], amount[out], basis[out] = row, by, made
    return [(made, x) for made, x in zip(basis, amount, strict=True) if x > 0]


def _best_fit(left: np.ndarray) -> list[tuple]:
    """The pieces counted in ``left``, longest first, each into the fullest sequence it fits.
    Sequences that hold the same are kept as one entry with their number."""
    size = len(left) - 1
    free: list[tuple[int, int]] = []  # room of an entry, its place in ``bins``
    bins: list[list] = []

    def add(made: np.ndarray, times: int, room: int) -> None:
        insort(free, (room, len(bins)))
        bins.append([made, times])

    for length in range(size, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(free, (length, -1))
            if at < len(free):
                room, b = free.pop(at)
                made, times = bins[b]
                bins[b] = [made, 0]
            else:
                room, made, times = size, np.zeros(size + 1, np.int64), n
            each = room // length
            for copies, bins_of in ((each, min(n // each, times)), (n % each, 1)):
                if copies and bins_of and times and n >= copies:
                    held = made.copy()
                    held[length] += copies
                    add(held, bins_of, room - copies * length)
                    n, times = n - copies * bins_of, times - bins_of
                if copies == each and times == 0:
                    break
            if times and made.any():
                add(made, times, room)
    return [(made, times) for made, times in bins if times]


def plan(counts: np.ndarray, step: float = STEP, rate: float = RATE) -> list[tuple]:
    """Whole configurations and how often each is used; together they hold exactly ``counts``. Of
    several roundings, which leave more or less of the solution to best fit, the one with the
    fewest sequences. Where those of full configurations need ``EXCESS`` more than the tokens and
    the pieces beyond half a sequence do, roundings of configurations of any fill and then of
    ``generated`` are tried too."""
    def rounded(solution):
        return min((_rounded(counts, solution, share) for share in KEPT), key=sequences)

    def sequences(made):
        return sum(times for _, times in made)

    size = len(counts) - 1
    tokens = int((counts * np.arange(size + 1)).sum())
    least = max(-(-tokens // size), int(counts[size // 2 + 1:].sum()))
    best = rounded(solve(counts, step, rate, full=True))
    for more in (lambda: solve(counts, step, rate), lambda: generated(counts)):
        if sequences(best) <= least + max(1, EXCESS * least):
            break
        best = min(best, rounded(more()), key=sequences)
    return best


def _rounded(counts: np.ndarray, solution: list[tuple], share: float) -> list[tuple]:
    left, out = counts.astype(np.int64).copy(), []
    for made, x in solution:
        if (times := int(share * x + 1e-6)) > 0:
            times = min(times, int(np.min(left[made > 0] // made[made > 0])))
        if times > 0:
            out.append((made, times))
            left -= made * times
    return out + _best_fit(left)


@dataclass
class Ranges:
    """For each length its rank ranges: where they begin, copies of the length in the sequence,
    the first sequence's number and the place of the first copy."""
    begins: list
    copies: list
    first: list
    place: list


def ranges(configurations: list[tuple], size: int) -> Ranges:
    r = Ranges(*([[] for _ in range(size + 1)] for _ in range(4)))
    given, sequence = np.zeros(size + 1, np.int64), 0
    for made, times in configurations:
        at = 0
        for length in np.flatnonzero(made)[::-1]:
            n = int(made[length])
            for column, x in ((r.begins, given[length]), (r.copies, n), (r.first, sequence),
                              (r.place, at)):
                column[length].append(int(x))
            given[length] += n * times
            at += n * int(length)
        sequence += times
    return Ranges(*([np.array(x, np.int64) for x in column]
                    for column in (r.begins, r.copies, r.first, r.place)))


def pack(parts: DataFrame, size: int = SIZE, step: float = STEP, rate: float = RATE) -> DataFrame:
    """``parts`` (a stored table with ``key, piece, length``) with ``sequence_id`` and
    ``offset`` added."""
    spark = parts.sparkSession
    counts = np.zeros(size + 1, np.int64)
    for length, n in parts.groupBy("length").count().collect():  # at most ``size`` rows
        counts[length] = n
    r = ranges(plan(counts, step, rate), size)
    spread = spark.createDataFrame(
        [(int(x), int(-(-counts[x] // BUCKET_ROWS))) for x in np.flatnonzero(counts)],
        "length long, _buckets long")
    bucketed = parts.join(F.broadcast(spread), "length").withColumn(
        "_bucket", F.pmod(F.xxhash64("key", "piece"), "_buckets")).drop("_buckets")
    sums = bucketed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    first = sums.select("length", "_bucket", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).alias("_first"))
    order = Window.partitionBy("length", "_bucket").orderBy("key", "piece")
    ranked = (bucketed.withColumn("_rn", F.row_number().over(order) - 1)
              .join(first, ["length", "_bucket"])
              .withColumn("_rank", F.col("_first") + F.col("_rn"))
              .drop("_bucket", "_first", "_rn"))
    at = [ranked.columns.index(c) for c in ("length", "_rank")]
    held = spark.sparkContext.broadcast(r)  # bounded by ``size``

    def run(batches: Iterator[pa.RecordBatch]):
        r = held.value
        for b in batches:
            length, rank = (b.column(i).to_numpy() for i in at)
            sequence, place = np.empty_like(rank), np.empty_like(rank)
            order = np.argsort(length, kind="stable")
            cut = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cut) if len(order) else []:
                n = int(length[rows[0]])
                i = np.searchsorted(r.begins[n], rank[rows], "right") - 1
                along = rank[rows] - r.begins[n][i]
                sequence[rows] = r.first[n][i] + along // r.copies[n][i]
                place[rows] = r.place[n][i] + along % r.copies[n][i] * n
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(b.columns) if i != at[1]]
                + [pa.array(sequence), pa.array(place)],
                names=[c for c in b.schema.names if c != "_rank"] + ["sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema
                      if f.name != "_rank")
    return ranked.mapInArrow(run, kinds + ", sequence_id long, offset long")


def packed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                     tokenizer: str | None = None, end: int = END,
                     with_ids: bool = True) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(stored(pieces(docs, key, text, size, tokenizer, end, with_ids), "pack-pieces"),
                size)
