"""Quality rules and the deduplication operators against brute force, and their defined cases."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import (
    exact_dedup,
    linking,
    near_dedup,
    quality_rules,
    queries,
    substring_dedup,
)
from sensorlake.llm import text as T
from sensorlake.llm.common import ship_code
from sensorlake.llm.components import components
from sensorlake.llm.shingles import set_identities, shingle_sets

SF = "/root/testdata/sf0.001"
# Extra columns that clash with names the operators use inside.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, "
        "node long, _row string, _fp int, _id string, c0 int")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{int(i)}" for i in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    ship_code(spark)
    rng = np.random.default_rng(1)
    base = sentence(rng, 120, 5000)
    close = base.replace(base.split()[60], "changed", 1)
    long_text = "\n".join(sentence(rng, 40, 9000) for _ in range(6000))
    texts = [(1, base), (2, base.upper()), (3, close), (3, close), (4, None), (5, ""), (6, " \n\t "),
             (7, "one two three"), (8, "One two three"), (None, base), (None, None),
             (9, long_text), (10, long_text + "\nend"), (11, "ünï code word " * 30),
             (12, "a line that comes back\n" * 20 + base), (13, "x" * 300_000)]
    rows = [(k, t, None if i % 3 else "en", None if i % 2 else "s", None, None, 5, "r", None, "i",
             i) for i, (k, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    ship_code(spark)
    return spark.createDataFrame([], DOCS)


def test_word_and_span_hashes_tell_equal_from_different():
    text = "aa b aa  ccc\tb\x0b\x0caa\r\nb"
    buf = np.frombuffer(text.encode() + b"\n", np.uint8)
    starts, ends, ptr = T.word_spans(buf, np.array([0, len(buf)]))
    found = [buf[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert found == words_of(text) and list(ptr) == [0, len(found)]
    hashes = T.span_hashes(buf, starts, ends)
    assert len(set(zip(found, hashes, strict=True))) == len(set(found)) == len(set(hashes))
    two = T.window_hashes(hashes, 2)
    pairs = list(zip(found, found[1:], strict=False))
    assert len(set(two)) == len(set(pairs))


def test_long_spans_hash_alike_in_any_place():
    rng = np.random.default_rng(0)
    part = rng.integers(97, 122, T.SPAN_BYTES + 5000).astype(np.uint8)
    buf = np.concatenate([part[:100], [32], part, [32], part, [10]]).astype(np.uint8)
    starts, ends = T.spans(~T.SPACE[buf])
    h = T.span_hashes(buf, starts, ends)
    assert h[1] == h[2] != h[0]


def brute_rules(text):
    text = text or ""
    w = words_of(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    counts = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if counts[tuple(w[i:i + 3])] > 1
               for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    chars = sum(map(len, w))

    def later(n):
        seen, cover = set(), set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in seen:
                cover |= set(range(i, i + n))
            seen.add(tuple(w[i:i + n]))
        return sum(len(w[i]) for i in cover) / max(chars, 1)

    seen, lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            lines += sum(map(len, words_of(line)))
        seen.add(line)
    kept = not failed and lines / max(chars, 1) <= quality_rules.LINE_LIMIT and all(
        later(n) <= x for n, x in quality_rules.LIMITS.items())
    return (len(w), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed, kept)


def test_quality_rules_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: tuple(r)[1:8] for r in queries.op1_quality_rules(spark, SF).collect()}
    assert got == {k: brute_rules(t) for k, t in texts.items()}
    assert len({v[-1] for v in got.values()}) == 2


def test_quality_rules_defined_cases(odd_docs, no_docs):
    got = sorted((tuple(r)[:8] for r in quality_rules.quality_measures(odd_docs).collect()),
                 key=repr)
    want = sorted(((r.doc_id, *brute_rules(r.text)) for r in odd_docs.collect()), key=repr)
    assert got == want
    kept = quality_rules.filter_quality(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.c0 for r in kept.collect()) == sorted(
        r.c0 for r in odd_docs.collect() if brute_rules(r.text)[-1])
    assert quality_rules.quality_measures(no_docs).count() == 0
    assert quality_rules.filter_quality(no_docs).count() == 0


def test_fingerprints_compose():
    rng = np.random.default_rng(2)
    for n in (0, 1, 100, exact_dedup.CHUNK, 3 * exact_dedup.CHUNK + 17):
        data = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        want = tuple(sum(b * pow(base, n - 1 - i, p) for i, b in enumerate(data)) % p
                     for base, p in zip(exact_dedup.BASES, exact_dedup.PRIMES, strict=True))
        assert exact_dedup.fingerprint(data) == want[0] << 31 | want[1]


def brute_copies(rows):
    groups = defaultdict(list)
    for k, t in rows:
        groups[(t or "").encode().lower()].append(k)
    return sorted(((k, max((x for x in v if x is not None), default=None), len(v),
                    hashlib.sha256(t).hexdigest()) for t, v in groups.items() for k in v), key=repr)


@pytest.mark.parametrize("of", [exact_dedup.fingerprint, lambda data: len(data) % 3])
def test_exact_groups_match_brute_force_even_when_fingerprints_collide(spark, odd_docs, of):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    docs = docs.unionByName(odd_docs.select("doc_id", "text"))
    # The weak fingerprint keeps equal lengths together, which the operator takes for granted.
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = exact_dedup.copy_groups(docs, of=of, bits=1 << 10, compare=64)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_copies(rows)


def test_exact_dedup_query_and_kept_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op10_exact_dedup(spark, SF).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got),
                  key=repr) == brute_copies(docs)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    left = exact_dedup.drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    kept = Counter((r.doc_id, (r.text or "").lower()) for r in left.collect())
    want = {(keep, size, sha) for _, keep, size, sha in brute_copies(
        [(r.doc_id, r.text) for r in odd_docs.collect()])}
    assert len(kept) == len(want) and set(kept.values()) == {1}
    assert exact_dedup.copy_groups(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).count() == 0


def test_components_match_union_find(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, i) for i in range(6000, 6100)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in
           components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    for n, shared in ((50, 40), (800, 600)):
        hits = []
        for _ in range(12):
            s = rng.choice(pool, 2 * n - shared, replace=False)
            both = np.r_[np.sort(s[:n]), np.sort(s[n - shared:])]
            sig = near_dedup.signatures(both, np.array([0, n, 2 * n]))
            assert (sig != 0).all()
            hits.append((sig[0] == sig[1]).mean())
        assert abs(np.mean(hits) - shared / (2 * n - shared)) < 0.05
    x, w = np.sort(pool[:300]), rng.integers(1, 9, (2, 300)).astype(float)
    hits = []
    for i in range(15):
        y = T.mix(x + np.uint64(i))
        sig = near_dedup.signatures(np.r_[y, y], np.array([0, 300, 600]), w.ravel())
        hits.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(hits) - np.minimum(*w).sum() / np.maximum(*w).sum()) < 0.05


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_classes(units, least_words=1):
    """Classes (sets of unit names) of similar shingle sets, units without words apart."""
    sets = {}
    for name, text in units:
        w = words_of(lower_ascii(text))
        if len(w) >= least_words:
            sets[name] = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or frozenset(
                [tuple(w)])
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = list(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                root[find(a)] = find(b)
    out = defaultdict(set)
    for k in sets:
        out[find(k)].add(k)
    return {frozenset(v) for v in out.values()}


def test_near_groups_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = defaultdict(set)
    rows = queries.op9_minhash_near_dedup(spark, SF).collect()
    for r in rows:
        got[r.class_id].add(r.doc_id)
    assert {frozenset(v) for v in got.values()} == brute_classes(docs)
    assert all(r.class_size == len(got[r.class_id]) and r.kept == (r.doc_id == r.class_id)
               for r in rows)
    assert any(len(v) > 1 for v in got.values())


def test_near_groups_tell_no_partial_link_counts(spark):
    """Pairs already joined are not compared, so counts of links would depend on the hubs."""
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    ship_code(spark)
    assert near_dedup.near_groups(docs).columns == ["key", "row", "group", "group_row",
                                                    "group_size", "kept"]


def test_near_groups_find_chains_and_many_variants(spark):
    """Variants of a text that are close to it but not to each other, and chains of them."""
    ship_code(spark)
    rng = np.random.default_rng(6)
    base = sentence(rng, 200, 5000).split()
    docs = [(0, " ".join(base))]
    for i in range(1, 80):
        w = list(base)
        for at in rng.choice(len(w), 3, replace=False):
            w[at] = f"v{i}x{at}"
        docs.append((i, " ".join(w)))
    w = sentence(rng, 150, 5000).split()
    for i in range(100, 130):  # a chain: each differs from the one before in two places
        for at in rng.choice(len(w), 2, replace=False):
            w[at] = f"c{i}x{at}"
        docs.append((i, " ".join(w)))
    docs += [(i, sentence(rng, 100, 5000)) for i in range(200, 230)]
    got = defaultdict(set)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for r in near_dedup.near_groups(frame).collect():
        got[r.group].add(r.key)
    assert {frozenset(v) for v in got.values()} == brute_classes(docs)


def test_pairs_that_are_only_alike_make_no_rows(spark, monkeypatch):
    """Of many variants that share buckets but are not similar enough, pairs go to verification
    by the hundred, not by the square; the similar ones among them are still found."""
    ship_code(spark)
    rng = np.random.default_rng(9)
    base = sentence(rng, 200, 5000).split()
    docs = []
    for i in range(120):
        w = list(base)
        for at in rng.choice(len(w), 4, replace=False):
            w[at] = f"v{i}x{at}"
        docs.append((i, " ".join(w)))
    docs += [(200 + i, f"{docs[i][1]} more") for i in range(0, 120, 10)]
    pairs, verified = [], linking._verified

    def counted(near, sets, similarity):
        pairs.append(near.count())
        return verified(near, sets, similarity)

    monkeypatch.setattr(linking, "_verified", counted)
    got = defaultdict(set)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for r in near_dedup.near_groups(frame).collect():
        got[r.group].add(r.key)
    assert {frozenset(v) for v in got.values()} == brute_classes(docs)
    assert sum(len(v) > 1 for v in got.values()) >= 12
    assert sum(pairs) < len(docs) * 10


def test_parities_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(10)
    whole = rng.integers(0, 2**63, 700, dtype=np.uint64)
    sets = [np.unique(rng.choice(whole, n)) for n in (3, 40, 300, 600, 650)] + [whole[:1]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets))),
                                        pa.array([x.tobytes() for x in sets], pa.binary())],
                                       names=["node", "shingles"])
    (found,) = linking._parities([batch])
    bits = [np.unpackbits(np.array(x, np.int64).view(np.uint8))
            for x in found.column("parity").to_pylist()]
    for x, p in zip(sets, bits, strict=True):
        for y, q in zip(sets, bits, strict=True):
            differ = len(np.setxor1d(x, y))
            assert (p != q).sum() <= differ and (p != q).sum() % 2 == differ % 2


def test_near_dedup_defined_cases(odd_docs, no_docs):
    rows = near_dedup.near_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    alone = [r for r in rows if r.key in (4, 5, 6)]
    assert all(r.group == r.key and r.group_size == 1 for r in alone) and len(alone) == 3
    assert {r.group for r in rows if r.key in (1, 2, 3)} == {None}  # the null key's copy stays
    assert {r.group for r in rows if r.key in (7, 8)} == {7}
    assert {r.group for r in rows if r.key in (9, 10)} == {9}
    left = near_dedup.drop_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 4, 5, 6, 7, 9, 11, 13]
    assert near_dedup.near_groups(no_docs).count() == 0
    assert near_dedup.drop_near_copies(no_docs).count() == 0


def test_bands_are_tuned_for_recall():
    bands, rows = substring_dedup.tuned(80, 0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999
    assert 1 - (1 - 0.8 ** (rows + 1)) ** (80 // (rows + 1)) < 0.9999


def test_repeated_paragraphs_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    units = [((k, i), line) for k, t in docs for i, line in enumerate(t.split("\n"))]
    want = {c for c in brute_classes(units, substring_dedup.LEAST) if len(c) > 1}
    got, texts = defaultdict(set), dict(docs)
    rows = queries.op2_substring_dedup(spark, SF).where("paragraph IS NOT NULL").collect()
    for r in rows:
        got[r.class_id, r.class_paragraph].add((r.doc_id, r.paragraph))
        assert texts[r.doc_id][r.start:r.start + r.length] == \
            texts[r.doc_id].split("\n")[r.paragraph]
        assert r.removed == ((r.doc_id, r.paragraph) != (r.class_id, r.class_paragraph))
    assert {frozenset(v) for v in got.values()} == want and want


def test_substring_dedup_defined_cases(spark, odd_docs, no_docs):
    rows = substring_dedup.repeated_paragraphs(odd_docs).collect()
    assert {r.key for r in rows} == {None, 1, 2, 3, 9, 10, 12}
    left = {r.c0: r.text for r in substring_dedup.drop_repeats(odd_docs).collect()}
    before = {r.c0: (r.doc_id, r.text) for r in odd_docs.collect()}
    assert set(left) == set(before)
    for c0, (key, text) in before.items():
        if key in (1, 2, 3):
            assert left[c0] == ""  # the null key's copy stays
        elif key == 10:
            assert left[c0] == "end"
        elif key == 12:
            assert left[c0] == text[:text.rindex("\n")]
        else:
            assert left[c0] == text
    assert substring_dedup.repeated_paragraphs(no_docs).count() == 0
    assert substring_dedup.drop_repeats(no_docs).count() == 0


def test_shingle_sets_of_short_texts():
    import pyarrow as pa

    (_, _, hashes, begins), = shingle_sets(pa.array(["a b c d e f", "A B", "", None, "a b"]))
    sizes = np.diff(begins)
    assert list(sizes) == [2, 1, 0, 0, 1]
    assert hashes[begins[1]] == hashes[begins[4]]


def test_bitmap_has_no_false_miss(spark):
    from sensorlake.llm.common import bitmap

    rows = spark.range(-50, 500, 7).withColumn("id", F.col("id") * 1_000_003)
    marks = np.frombuffer(bitmap(rows, "id", 1 << 12), np.uint8)
    for r in rows.collect():
        slot = r.id % (1 << 12)
        assert marks[slot >> 3] >> (slot & 7) & 1


def test_one_of_repeated_rows_stays(spark):
    ship_code(spark)
    docs = spark.createDataFrame([(1, "a b c d e f g")] * 3 + [(2, "a b c d e f g"), (3, "")],
                                 "doc_id long, text string")
    rows = near_dedup.near_groups(docs).collect()
    assert sorted((r.key, r.kept) for r in rows) == [
        (1, False), (1, False), (1, True), (2, False), (3, True)]
    assert sorted(r.doc_id for r in near_dedup.drop_near_copies(docs).collect()) == [1, 3]


def test_low_bits_differ_in_no_more_coordinates_than_sketches(spark):
    rng = np.random.default_rng(3)
    for size in (70, 160):
        x = rng.integers(-128, 128, size).astype(np.int8)
        y = np.where(rng.random(size) < 0.3, rng.integers(-128, 128, size), x).astype(np.int8)
        b = pa.RecordBatch.from_arrays([pa.array([1, 2]), linking.row_lists(np.stack([x, y]))],
                                       names=["node", "sketch"])
        low = next(linking._low_bits(size)([b])).column("low").to_pylist()
        found = spark.createDataFrame([tuple(low)], "x array<long>, y array<long>").select(
            linking._coordinates_differing("x", "y", size)).first()[0]
        assert found == ((x & 3) != (y & 3)).sum() <= (x != y).sum()


def test_a_bucket_of_variants_is_linked_by_slices(spark):
    """More nodes than the first slices hold, in pairs of likes: each pair is linked in the round of
    the one that comes first."""
    rng = np.random.default_rng(5)
    common = rng.integers(1, 2**62, 60, dtype=np.uint64)
    sets = []
    for _ in range(60):
        own = rng.integers(1, 2**62, 40, dtype=np.uint64)
        sets += [np.sort(np.r_[common, own]), np.sort(np.r_[common, own[:-1], own[:1] + np.uint64(1)])]
    begins = np.r_[0, np.cumsum([len(s) for s in sets])]
    ids = set_identities(np.concatenate(sets), begins).view(np.int64).tolist()
    nodes = spark.createDataFrame(
        [(i, len(s), [7], [1] * 8) for i, s in zip(ids, sets, strict=True)],
        "node long, n long, bands array<long>, sketch array<tinyint>")
    held = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in zip(ids, sets, strict=True)],
                                 "node long, shingles binary")
    links, roots = linking.linked(nodes, lambda marks: held, 8, 4, 0.8)
    want = {tuple(sorted(ids[i:i + 2])) for i in range(0, len(ids), 2)}
    assert {tuple(r) for r in links.collect()} == want
    assert links.count() == roots.count() == len(want)
