"""Repeated passages against brute-force windows of 50 words."""

import re
from collections import defaultdict

import numpy as np

from sensorlake.llm import passages, queries, substring_dedup
from sensorlake.llm.common import ship_code

SF = "/root/testdata/sf0.001"


def words_at(text):
    return [(re.sub("[A-Z]", lambda m: m[0].lower(), m[0]), m.start(), m.end())
            for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]


def windows_of(text):
    w = [x for x, _, _ in words_at(text)]
    return [tuple(w[i:i + 50]) for i in range(len(w) - 49)]


def brute_words(docs):
    """(document, word) of all words inside windows that two documents hold."""
    held = defaultdict(set)
    for i, (_, text) in enumerate(docs):
        for x in windows_of(text):
            held[x].add(i)
    return {(k, i + j) for k, text in docs for i, x in enumerate(windows_of(text))
            if len(held[x]) > 1 for j in range(50)}


def covered(docs, rows):
    out = set()
    spans = defaultdict(list)
    for r in rows:
        spans[r.key].append(r)
    for k, text in docs:
        for i, (_, a, b) in enumerate(words_at(text)):
            hits = [r for r in spans[k] if r.start <= a and b <= r.start + r.length]
            assert len(hits) <= 1
            if hits:
                out.add((k, i))
        assert sum(r.words for r in spans[k]) == len([1 for d, _ in out if d == k])
    return out


def text_of(rng, n):
    return " ".join(f"w{i}" for i in rng.integers(0, 5000, n))


def tricky():
    """A passage in a longer line, wrapped over short lines, in other case, next to other repeats."""
    rng = np.random.default_rng(3)
    p, q = text_of(rng, 70).split(), text_of(rng, 55).split()
    wrapped = "\n".join(" ".join(p[i:i + 7]) for i in range(0, 70, 7))
    docs = [(1, f"{text_of(rng, 200)} {' '.join(p)} {text_of(rng, 90)}"), (2, f"é ü {wrapped}"),
            (3, f"{text_of(rng, 30)}\n{' '.join(p).upper()}  {' '.join(q)}"),
            (4, f"x {' '.join(p[40:])} {' '.join(q)} y"), (5, " ".join(p[:49])),
            (6, "a b c d e " * 40), (7, None), (8, ""), (9, text_of(rng, 300))]
    return docs


def test_passages_match_brute_force(spark):
    ship_code(spark)
    docs = tricky()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_words(docs)
    assert {k for k, _ in want} == {1, 2, 3, 4}
    assert covered(docs, passages.repeated_passages(frame).collect()) == want
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = queries.op2_repeated_passages(spark, SF).withColumnRenamed("doc_id", "key").collect()
    assert covered(docs, rows) == brute_words(docs)


def test_substring_dedup_finds_passages_inside_and_across_lines(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = (queries.op2_substring_dedup(spark, SF).where("paragraph IS NULL")
            .withColumnRenamed("doc_id", "key").collect())
    want = brute_words(docs)
    assert want and covered(docs, rows) == want
    assert {r.class_id for r in rows} == {None} and {r.removed for r in rows} == {True, False}


def test_passages_of_seeds_with_many_blocks(spark, monkeypatch):
    """Windows dealt one by one give the rows of windows dealt by seed."""
    ship_code(spark)
    frame = spark.createDataFrame(tricky(), "doc_id long, text string")
    found = []
    for many in (0, 1, 1_000):
        monkeypatch.setattr(passages, "MANY", many)
        found.append(sorted(map(tuple, passages.repeated_passages(frame).collect())))
    assert found[0] and found[0] == found[1] == found[2]


def test_dropped_passages_stay_once(spark):
    """No window is left in two documents but where a staying one needs it, and none is lost."""
    ship_code(spark)
    docs = tricky()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    left = {r.doc_id: r.text for r in substring_dedup.drop_repeats(frame).collect()}
    before = {x for _, t in docs for x in windows_of(t)}
    held = defaultdict(set)
    for k, t in left.items():
        for x in windows_of(t):
            held[x].add(k)
    repeated = {x for x in before if sum(x in windows_of(t) for _, t in docs) > 1}
    assert repeated and all(len(held[x]) == 1 for x in repeated)
    assert left[2] == "é ü " and left[1] == docs[0][1]
    assert all(left[k] == dict(docs)[k] for k in (5, 6, 7, 8, 9))


def test_repeated_rows_and_empty_tables(spark):
    ship_code(spark)
    text = text_of(np.random.default_rng(8), 60)
    twins = spark.createDataFrame([(None, text), (None, text)], "doc_id long, text string")
    assert [r.words for r in passages.repeated_passages(twins).collect()] == [60]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert passages.repeated_passages(none).count() == passages.drop_passages(none).count() == 0
