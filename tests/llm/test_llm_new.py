"""Jump sharding, spelling variants and the conversation trie, against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import queries, sharding, spelling

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict() for r in df.collect()]


# ---------------------------------------------------------------- sharding

def brute_jump(key, shards):
    """The published loop, in exact integers but for its one division."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop():
    keys = np.random.default_rng(3).integers(0, 2**64, 2_000, dtype=np.uint64)
    got = sharding.jump(keys, (1, 7, 24, 25, 1000))
    for n, shards in zip((1, 7, 24, 25, 1000), got, strict=True):
        assert shards.tolist() == [brute_jump(int(k), n) for k in keys]
    assert not got[0].any()


def test_only_the_new_shard_takes_rows():
    keys = np.arange(100_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = tuple(range(1, 40))
    shards = sharding.jump(keys, counts)
    for n, (a, b) in enumerate(zip(shards[:-1], shards[1:], strict=True), 1):
        moved = a != b
        assert (b[moved] == n).all()
        assert abs(moved.mean() - 1 / (n + 1)) < 0.01


DOCS = [(1, "aé"), (2, None), (2, None), (None, ""), (None, "x"), (3, "long " * 50_000), (3, "b")]


def placed(spark, data, **more):
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumns(
        {"shard": F.lit(1), "slot": F.lit("x"), "_key": F.lit(2), "key": F.lit(3)})
    return rows(sharding.placed_rows(docs, **more))


def check_slots(found):
    for s in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_placed_rows_edge_cases(spark):
    found = placed(spark, DOCS)
    want = sorted((k or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
                  for k, t in DOCS)
    assert sorted((r["key"] or -1, r["size"], r["text_crc32"]) for r in found) == want
    check_slots(found)
    by_key = {}
    for r in found:
        assert r["grown_shard"] in (r["shard"], 24)
        assert by_key.setdefault(r["key"], r["shard"]) == r["shard"]
    assert placed(spark, []) == []


def test_a_row_that_repeats_is_dealt_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 10)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 1)
    found = placed(spark, [(5, "same")] * 57 + [(i, f"t{i}") for i in range(300)], shards=3)
    assert len(found) == 357
    check_slots(found)


def test_written_shards_hold_all_rows(spark, scratch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    sharding.write_shards(docs, f"{scratch}/out", files=2)
    back = spark.read.parquet(f"{scratch}/out")
    assert back.count() == len(DOCS)
    shards = {r["doc_id"]: r["_shard"] for r in rows(back)}
    assert all(shards[r["key"]] == r["shard"] for r in placed(spark, DOCS))
    assert dict(sharding.with_shards(docs.withColumn("shard", F.lit("x"))).dtypes)["shard"] == "int"


# ---------------------------------------------------------------- spelling variants

def brute_words(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute_variants(words):
    out = {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if one_edit(w, v))
        form = near[0][1] if near and -near[0][0] >= 10 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)

    def root(w):
        return root(out[w][0]) if out[w][0] else w
    return {w: (form, root(w), n, near, m) for w, (form, n, near, m) in out.items()}


def test_spelling_variants_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = ["because", "receive", "Straße", "éléphants", "aaaaaaa", "aaaaaaaa", "zzzzzzz",
            "separate", "bücherei", "ÀÿÀÿÀÿÀ", "neighbour", "neighbor"]
    docs = []
    for i in range(400):
        text = []
        for w in rng.choice(base, 30, p=[0.3, 0.2, *[0.05] * 10]):
            if rng.random() < 0.15:
                at, c = int(rng.integers(0, len(w))), "abeéÿz×"[rng.integers(0, 7)]
                w = [w[:at] + c + w[at:], w[:at] + w[at + 1:], w[:at] + c + w[at + 1:]][
                    int(rng.integers(0, 3))]
            text.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((int(i), " ".join(text)))
    docs += [(None, "because " * 5), (7, None), (7, ""), (7, "because because"), (9, "ab1cd" * 99)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"word": F.lit("x"), "n": F.lit(1), "_run": F.lit(2)})
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
             for r in rows(spelling.spelling_variants(frame))}
    want = brute_variants(brute_words(docs))
    assert found == want
    assert any(form for form, *_ in want.values())


def test_chains_of_forms_end_at_the_last(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000,
             "aaabbbc": 20_000, "qqqqqqqq": 5}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
             for r in rows(spelling.variants(frame))}
    assert found == brute_variants(words)
    assert found["aaaaaaa"][1] == "aaabbbb"


def test_spelling_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rows(spelling.spelling_variants(docs)) == []


def test_small_passes_and_slices_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = {"".join(rng.choice(list("abc"), rng.integers(7, 10))): int(rng.integers(2, 99))
             for _ in range(1_500)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").cache()
    want = {frozenset((a, b)) for a, b in map(tuple, spelling.near_words(frame).collect())}
    monkeypatch.setattr(spelling, "PASS_BYTES", 1_000)
    passes = spelling.filter_sizes({7: 500, 8: 500, 9: 500})
    assert all(sum(b * 64 for b, *_ in p.values()) <= 1_000 for p in passes)
    got = [frozenset((a, b)) for a, b in map(tuple, spelling.near_words(frame).collect())]
    assert len(got) == len(set(got)) and set(got) == want
    assert want == {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}


def test_filters_hold_every_key_and_few_others():
    rng = np.random.default_rng(8)
    keys = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    blocks = len(keys) * spelling.BITS // 512 + 1
    block, bits = spelling.bits_of(keys, blocks)
    words = np.zeros((blocks, spelling.BLOCK), np.uint64)
    np.bitwise_or.at(words, block, bits)
    made = spelling.Filter(words)
    assert len(made.holds(keys)) == len(keys)
    others = rng.integers(0, 2**64, 100_000, dtype=np.uint64)
    assert len(made.holds(others)) < 0.01 * len(others)


@pytest.mark.parametrize("name", ["op11_jump_sharding", "op12_spelling_variants"])
def test_queries_have_sql(name):
    assert name in queries.QUERIES and name in queries.ORACLE_SQL


# ---------------------------------------------------------------- pages

def test_an_unclosed_element_hides_its_tag_alone():
    from sensorlake.llm.language_id import visible

    def words(page):
        return visible(page).split()

    assert words("a <nav class='x'> b <p>c</p>") == ["a", "b", "c"]
    assert words("a <nav> b </NAV > c <footer>d</footer>e<aside> f") == ["a", "c", "e", "f"]
    assert words("<script>var x = 1 < 2;</script>t &amp; u<!-- no --><style>s") == ["t", "&", "u", "s"]
    assert words("<header>a<nav>b</nav>c</header>d") == ["d"]
    assert words("a <!-- never closed <p>b") == ["a"]
    assert words(None) == [] and words("< 3 <") == ["<", "3", "<"]
    assert len(words("<nav> x " * 20_000)) == 20_000
