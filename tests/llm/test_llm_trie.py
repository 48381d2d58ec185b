"""The conversation trie against brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import conversation_trie as trie
from sensorlake.llm import queries

COLUMNS = "conv_id long, turn long, role string, text string"


def brute_rebuilt(data):
    own = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute_nodes(data):
    convs = brute_rebuilt(data)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    out = {}
    for path in sorted(members, key=len, reverse=True):  # children before their parents
        below = [out[p] for p in children[path]]
        n = len(members[path])
        ended = sorted(c for c in members[path] if len(convs[c]) == len(path))
        out[path] = (min(members[path]), len(path),
                     min(members[path[:-1]]) if path else None, n, len(below),
                     sum(b[5] for b in below) or 1,
                     sum(b[6] for b in below) + (n - 1) * len(path[-1][1] if path else ""),
                     hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest())
    return sorted(out.values(), key=str)


def found(spark, data, **more):
    turns = spark.createDataFrame(data, COLUMNS).withColumns(
        {"pos": F.lit("x"), "conv": F.lit(1), "members": F.lit(2), "id": F.lit(3)})
    nodes = trie.prefix_trie(turns, **more)
    return sorted((tuple(r) for r in nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=str)


def made(seed, convs, texts, most):
    rng = np.random.default_rng(seed)
    data = []
    for c in rng.choice(convs * 3, convs, replace=False):
        for turn in range(int(rng.integers(1, most))):
            data.append((int(c), turn, ["user", "assistant"][turn % 2],
                         "é" * int(rng.integers(0, texts))))
    return data


@pytest.mark.parametrize("limit", [2, 40, 20_000])
def test_any_limit_gives_the_nodes_of_brute_force(spark, limit):
    data = made(limit, 60, 2, 6)
    assert found(spark, data, limit=limit) == brute_nodes(data)


def test_edge_cases(spark):
    data = [(1, None, None, None), (1, None, "a", "x"), (1, 0, "user", ""), (1, 0, "user", ""),
            (None, 0, "user", "lost"), (100, 0, "user", "long " * 30_000), (100, 0, None, "y"),
            (103, 3, "u", "z"), (207, 1, "u", "z"), (-5, 0, "u", "q"), (300, 2, "r", "o"),
            (305, 0, "r", "o"), (305, 1, "r", "p"), (9, 9, "ro", "le"), (10, 9, "r", "ole")]
    assert any(not turns for turns in brute_rebuilt(data).values())
    for limit in (1, 20_000):
        assert found(spark, data, limit=limit) == brute_nodes(data)
    assert found(spark, []) == []


def test_copies_of_a_long_conversation_and_one_that_leaves_it_late(spark, monkeypatch):
    """Long spines, in blocks, and a digest over many chunks."""
    monkeypatch.setattr(trie, "BLOCK", 16)
    monkeypatch.setattr(trie, "CHUNK", 8)
    monkeypatch.setattr(trie, "TASK_ROWS", 100)
    turns = [("user" if i % 2 else "assistant", f"t{i}") for i in range(90)]
    data = [(c, i, *t) for c in range(0, 40) for i, t in enumerate(turns)]
    data += [(50, i, *t) for i, t in enumerate([*turns[:70], ("user", "other"), *turns[70:]])]
    data += [(60, i, "user", f"alone {i}") for i in range(200)]
    assert found(spark, data, limit=50) == brute_nodes(data)


def test_numbering_goes_over_task_bounds(spark, monkeypatch):
    monkeypatch.setattr(trie, "TASK_ROWS", 20)
    rng = np.random.default_rng(4)
    data = [(5, int(i), "r", f"{i}") for i in rng.permutation(300)]
    data += [(int(c), t, "r", f"{c}-{t}") for c in range(6, 30) for t in range(3)]
    got = trie.numbered(spark.createDataFrame(data, COLUMNS))
    places = {(r["conv"], r["pos"], r["id"]) for r in got.collect()}
    want = {(c, t, hashlib.md5(f"1:r{x}".encode()).hexdigest()) for c, t, _, x in data}
    assert places == want


def test_query_has_sql():
    assert "op13_conversation_trie" in queries.QUERIES
    assert "op13_conversation_trie" in queries.ORACLE_SQL
