"""Prefix trie of conversations as a distributed burst trie.

A conversation is a sequence of turn ids (128-bit MD5 of role and text). Equal sequences are counted
first and go on as one. A container holds the suffixes of all sequences that share a prefix; the
first one, at the root, holds all of them. While a container is oversized (``LIMIT`` turns and
sequences), it bursts: the turns that all its suffixes share become a spine of trie heads, and the
next turn id deals the suffixes to containers of their own. A container that fits, or whose suffix
is alone, is left. Containers are dealt to tasks whole; each task sorts the suffixes of a container
and sweeps them into nodes with a stack of open nodes, a container at a time. Sums over subtrees go
from the containers up the spines, a round of bursts at a time.

A node is named by its depth and its smallest member, and so is the container below it.

Scale: conversations are numbered by a range sort over (conversation, turn, role, text), so one
conversation may span many tasks; only its few spans' sizes are summed over. A container is bounded,
spines and lone long suffixes are rows that never meet in a task: their running sums go by blocks
(``BLOCK`` turns). Rounds of bursts follow the branchings in oversized containers, not the depth. The
digest of the conversations that end in a node is sequential by definition; sorted chunks of ``CHUNK``
consecutive ids stream through it.

Defined cases: null roles and texts are empty; turns go null first, ties by role and text; repeated
rows are turns each; rows without a conversation are left out; a very long conversation or text is as
above; an empty table has no nodes; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Turns and sequences that a container may hold, rows that a task orders, turns of a block, ids of a
#: chunk.
LIMIT, TASK_ROWS, BLOCK, CHUNK = 20_000, 20_000, 4_096, 4_096
#: Rebuilt conversations share up to SHARED - 1 first turns with the first of their GROUP.
GROUP, SHARED = 100, 6
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ended long")


def numbered(turns: DataFrame) -> DataFrame:
    """``conv, pos, id, chars``: all turns, numbered from 0 in each conversation's order."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text")).where("conv IS NOT NULL")
    # The bounds of the ranges are sampled on beginnings of bounded size, which order the same.
    ranges = ["conv", "turn", F.substring("role", 1, 32), F.substring("text", 1, 64)]
    tasks = turns.count() // TASK_ROWS + 1
    ordered = (rows.repartitionByRange(tasks, *ranges)
               .sortWithinPartitions("conv", "turn", "role", "text"))
    named = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    compact = ordered.select("conv", F.spark_partition_id().alias("part"),
                             F.md5(named.cast("binary")).alias("id"),
                             F.char_length("text").cast("long").alias("chars"))
    spans = stored(compact.mapInArrow(_count_up, "conv long, part int, id string, chars long, "
                                                 "pos long"), "trie-turns")
    sizes = spans.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("conv").orderBy("part")
    # Only the first conversation of a range can have begun in an earlier one: a row a task at most.
    begun = sizes.select("conv", "part", (F.sum("n").over(upto) - F.col("n")).alias("before")) \
        .where("before > 0")
    return spans.join(F.broadcast(begun), ["conv", "part"], "left").select(
        "conv", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "id", "chars")


def _count_up(batches: Iterator[pa.RecordBatch]):
    """Adds the row's number in its run of equal first columns."""
    last, seen = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        conv = b.column(0).to_numpy()
        begins = np.r_[True, conv[1:] != conv[:-1]]
        at = np.arange(len(conv))
        pos = at - np.maximum.accumulate(np.where(begins, at, 0))
        if conv[0] == last:
            pos[:np.append(np.flatnonzero(begins), len(conv))[1]] += seen
        last, seen = conv[-1], int(pos[-1]) + 1
        yield b.append_column("pos", pa.array(pos.astype(np.int64)))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conversations`` (conv, len) and their turns (conv, pos, id, chars) after the first turns of
    each, as many as its checksum says, gave way to those of the first of its group."""
    rows = numbered(turns)
    share = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).select(
        "conv", "own", share.alias("share"), (F.col("conv") - F.col("conv") % GROUP).alias("head"))
    sizes = stored(sizes, "trie-sizes")
    heads = sizes.select(F.col("conv").alias("head"), F.col("own").alias("there"))
    info = stored(
        sizes.join(heads, "head", "left")
        .withColumn("taken", F.least("share", F.coalesce("there", F.lit(0))))
        .withColumn("len", F.col("taken") + F.greatest(F.col("own") - F.col("share"), F.lit(0)))
        .select("conv", "head", "taken", "share", "len"), "trie-conversations")
    first = rows.where(F.col("pos") < SHARED).withColumnRenamed("conv", "head").join(
        info.where("taken > 0").select("conv", "head", "taken"), "head") \
        .where("pos < taken").select("conv", "pos", "id", "chars")
    moved = info.where("taken <> share").select("conv", (F.col("taken") - F.col("share")).alias("by"))
    own = rows.where(F.col("pos") >= share).join(moved, "conv", "left").select(
        "conv", (F.col("pos") + F.coalesce("by", F.lit(0))).alias("pos"), "id", "chars")
    return info.select("conv", "len"), stored(first.unionByName(own), "trie-rebuilt")


def sequences(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv, len, x, y``: two independent 64-bit hashes of the sequence of every conversation."""
    hashes = turns.groupBy("conv").agg(
        F.bit_xor(F.xxhash64("pos", "id")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("other"), "id", "pos")).alias("y"))
    return conversations.join(hashes, "conv", "left").select(
        "conv", "len", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("x", "y")))


def ends(seqs: DataFrame) -> DataFrame:
    """``ended, ends_sha256``: of each distinct sequence, named by its smallest conversation, the
    digest of the ids of all that equal it."""
    key = ["len", "x", "y"]
    chunks = seqs.groupBy(*key, F.floor(F.col("conv") / CHUNK).alias("chunk")).agg(
        F.sort_array(F.collect_list("conv")).alias("ids"))  # CHUNK ids at most
    chunks = chunks.select(*key, "chunk", F.col("ids")[0].alias("least"),
                           F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]):
        last = least = state = None
        for b in batches:
            done = []
            for *name, _, first, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if name == last:
                    state.update(b"," + ids.encode())
                    continue
                if last is not None:
                    done.append((least, state.hexdigest()))
                last, least, state = name, first, hashlib.sha256(ids.encode())
            yield _batch(done)
        if last is not None:
            yield _batch([(least, state.hexdigest())])

    def _batch(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in done], pa.int64()), pa.array([r[1] for r in done], pa.string())],
            names=["ended", "ends_sha256"])

    return (chunks.repartition(*key).sortWithinPartitions(*key, "chunk")
            .mapInArrow(run, "ended long, ends_sha256 string"))


def _lcp(a: list, b: list) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def sweep(conv: int, depth: int, parent: int | None, chars: int, found: list) -> list[list]:
    """The nodes of a container below ``conv`` at ``depth``, top first: conv_id, depth, parent,
    n_convs, n_children, n_leaves, saved_tokens, ended. ``found`` has (ids, chars, name, members) of
    each suffix; ``chars`` is the top's own text."""
    top = [conv, depth, parent, 0, 0, 0, 0, None]
    nodes, open_, last = [top], [(top, chars, None)], []

    def close(keep: int) -> None:
        while len(open_) > keep:
            node, own, above = open_.pop()
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * own
            if above is not None:
                above[0] = min(above[0], node[0])
                above[3] += node[3]
                above[4] += 1
                above[5] += node[5]
                above[6] += node[6]

    for ids, texts, name, members in sorted(found, key=lambda s: s[0]):
        close(1 + _lcp(last, ids))
        for i in range(len(open_) - 1, len(ids)):
            node = [name, depth + i + 1, open_[-1][0], 0, 0, 0, 0, None]
            nodes.append(node)
            open_.append((node, texts[i], open_[-1][0]))
        end = open_[-1][0]
        end[0], end[3], end[7], last = min(end[0], name), end[3] + members, name, ids
    close(0)
    for node in nodes[1:]:
        node[2] = node[2][0]
    return nodes


def _swept(containers: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of ``containers`` (container, depth, parent, text, conv, len, members), each of which
    is swept whole by one task."""
    own = ["container", "depth", "parent", "text", "conv", "members"]
    bare = containers.select(*own, F.lit(-1).cast("long").alias("pos"),
                             F.lit("").alias("id"), F.lit(0).cast("long").alias("chars"))
    full = containers.join(turns, "conv").where(F.col("pos") >= F.col("depth")).select(
        *own, "pos", "id", "chars")
    rows = bare.unionByName(full).repartition("container", "depth") \
        .sortWithinPartitions("container", "depth", "conv", "pos")

    def run(batches: Iterator[pa.RecordBatch]):
        held, found, out = None, [], []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (r[0], r[1]) != (held and held[:2]):
                    if held:
                        out += _tops(sweep(*held, found))
                    held, found = r[:4], []
                if r[6] < 0:
                    found.append(([], [], r[4], r[5]))
                else:
                    found[-1][0].append(r[7])
                    found[-1][1].append(r[8])
            if len(out) > TASK_ROWS:
                yield _node_batch(out)
                out = []
        if held:
            out += _tops(sweep(*held, found))
        yield _node_batch(out)

    return rows.mapInArrow(run, _NODE + ", top boolean")


def _tops(nodes: list[list]) -> list[list]:
    return [[*node, i == 0] for i, node in enumerate(nodes)]


def _node_batch(nodes: list[list]) -> pa.RecordBatch:
    columns = zip(*nodes, strict=True) if nodes else [[]] * 9
    names = [part.split()[0] for part in _NODE.split(", ")] + ["top"]
    kinds = [pa.int64()] * 8 + [pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _burst(open_: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Oversized containers -> their spines (container, depth, parent, text, bottom,
    members, ended), the
    spines' turns (container, depth, pos, chars) and the suffixes below in new containers."""
    name = ["container", "depth"]
    of = open_.groupBy(*name).agg(
        F.count(F.lit(1)).alias("suffixes"), F.sum("members").alias("all"),
        F.first("parent").alias("parent"), F.first("text").alias("text"))
    ahead = open_.join(turns, "conv").where(F.col("pos") >= F.col("depth"))
    places = stored(
        ahead.groupBy(*name, "pos").agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"),
            F.max("chars").alias("chars")).join(of, name)
        .select(*name, "pos", "chars", ((F.col("n") == F.col("suffixes"))
                                        & (F.col("lo") == F.col("hi"))).alias("shared")),
        "trie-places")
    bottoms = places.where("NOT shared").groupBy(*name).agg(F.min("pos").alias("bottom"))
    below = stored(open_.join(bottoms, name), "trie-below")
    ended = below.where("len = bottom").select(*name, F.col("conv").alias("ended"))
    spines = stored(of.join(bottoms, name).join(ended, name, "left").select(
        *name, "parent", "text", "bottom", F.col("all").alias("members"), "ended"), "trie-spines")
    along = places.where("shared").join(bottoms, name).where("pos < bottom").select(
        *name, "pos", "chars")
    stepped = stored(below.where("len > bottom").join(
        turns.withColumnsRenamed({"pos": "bottom", "chars": "step"}), ["conv", "bottom"])
        .select(*name, "conv", "len", "members", "bottom", "id", "step"), "trie-stepped")
    named = stored(stepped.groupBy(*name, "id").agg(F.min("conv").alias("new")), "trie-named")
    deeper = stepped.join(named, [*name, "id"]).select(
        F.col("new").alias("container"), (F.col("bottom") + 1).alias("depth"),
        F.col("container").alias("parent"), F.col("step").alias("text"), "conv", "len", "members")
    return spines, along, stored(deeper, "trie-suffixes")


def _from_below(rows: DataFrame) -> DataFrame:
    """``rows`` (container, depth, pos, chars) with ``upto``: the sum of ``chars`` from the row's
    place to the end. Blocks are summed first, so no window meets a whole spine's rows."""
    name = ["container", "depth"]
    rows = rows.withColumn("block", F.floor(F.col("pos") / BLOCK))
    sums = rows.groupBy(*name, "block").agg(F.sum("chars").alias("sum"))
    later = Window.partitionBy(*name).orderBy(F.desc("block"))
    after = sums.select(*name, "block", (F.sum("sum").over(later) - F.col("sum")).alias("after"))
    inside = Window.partitionBy(*name, "block").orderBy(F.desc("pos"))
    return rows.withColumn("inside", F.sum("chars").over(inside)).join(
        after, [*name, "block"]).select(*name, "pos", (F.col("inside") + F.col("after")).alias("upto"))


def trie(seqs: DataFrame, turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of ``seqs`` (conv, len, x, y; stored) over ``turns`` (conv, pos, id,
    chars; stored): ``_NODE``, where ``ended`` names the sequence that ends there."""
    distinct = stored(seqs.groupBy("len", "x", "y").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("members"))
        .select("conv", "len", "members"), "trie-distinct")
    turns = stored(turns.join(distinct.select("conv"), "conv", "left_semi"), "trie-kept")
    # The root's container: named by the least of all.
    least = distinct.agg(F.min("conv")).first()[0]
    suffixes = distinct.select(
        F.lit(least).cast("long").alias("container"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"),
        F.lit(0).cast("long").alias("text"), "conv", "len", "members")
    name, left, bursts, alone = ["container", "depth"], [], [], []
    while True:
        sizes = stored(suffixes.groupBy(*name).agg(
            F.count(F.lit(1)).alias("suffixes"),
            F.sum(F.col("len") - F.col("depth") + 1).alias("size")).where(F.col("size") > limit)
            .select(*name, "suffixes"), "trie-oversized")
        left.append(suffixes.join(sizes, name, "left_anti"))
        if sizes.isEmpty():
            break
        alone.append(suffixes.join(sizes.where("suffixes = 1").select(*name), name, "left_semi"))
        open_ = stored(suffixes.join(sizes.where("suffixes > 1").select(*name), name, "left_semi"),
                       "trie-open")
        if open_.isEmpty():
            break
        spines, along, suffixes = _burst(open_, turns)
        bursts.append((spines, along))
    swept = stored(_swept(_union(left), turns), "trie-swept")
    if not bursts and not alone:
        return swept.drop("top")

    # Tops of containers and spines, as children of the bottoms above them.
    tops = [swept.where("top").select("parent_conv_id", (F.col("depth") - 1).alias("at"),
                                      "n_leaves", "saved_tokens")]
    heads, rows = [], []
    if alone:
        lone = _union(alone)
        ahead = lone.join(turns, "conv").where(F.col("pos") >= F.col("depth")).select(
            *name, "pos", "chars")
        bursts.append((lone.select(*name, "parent", "text", F.col("len").alias("bottom"), "members",
                                   F.col("conv").alias("ended")), ahead))
    for spines, along in reversed(bursts):
        held = stored(along.unionByName(spines.select(
            *name, (F.col("depth") - 1).alias("pos"), F.col("text").alias("chars"))), "trie-along")
        children = _union(tops).groupBy(F.col("parent_conv_id").alias("container"),
                                        F.col("at").alias("bottom")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("below"))
        total = held.groupBy(*name).agg(F.sum("chars").alias("total"))
        spines = stored(spines.join(total, name).join(children, ["container", "bottom"], "left")
                        .select(*name, "parent", "bottom", "members", "ended", "total",
                                F.coalesce("n_children", F.lit(0)).alias("n_children"),
                                F.coalesce("leaves", F.lit(1)).alias("leaves"),
                                F.coalesce("below", F.lit(0)).alias("below")), "trie-heads")
        heads.append(spines)
        rows.append(held)
        tops.append(spines.select(
            F.col("parent").alias("parent_conv_id"), (F.col("depth") - 1).alias("at"),
            F.col("leaves").alias("n_leaves"),
            (F.col("below") + (F.col("members") - 1) * F.col("total")).alias("saved_tokens")))
    at = F.col("pos") + 1
    bottom = at == F.col("bottom")
    nodes = _from_below(_union(rows)).join(_union(heads), name).select(
        F.col("container").alias("conv_id"), at.alias("depth"),
        F.when(at == F.col("depth"), F.col("parent")).otherwise(F.col("container"))
        .alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.when(bottom, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("members") - 1) * F.col("upto")).alias("saved_tokens"),
        F.when(bottom, F.col("ended")).alias("ended"))
    return swept.drop("top").unionByName(nodes)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def prefix_trie(turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations of ``turns`` (conv_id, turn, role,
    text)."""
    conversations, rows = rebuilt(turns)
    seqs = stored(sequences(conversations, rows), "trie-sequences")
    nodes = trie(seqs, rows, limit)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(ends(seqs), "ended", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
