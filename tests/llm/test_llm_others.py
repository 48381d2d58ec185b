"""Mixing, packing, chat formatting, language identification, classifiers and the pipeline."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorlake.llm import (
    chat_format,
    exact_dedup,
    factorisation,
    language_id,
    mixing,
    near_dedup,
    packing,
    quality_rules,
    queries,
    toxicity,
)
from sensorlake.llm.common import ship_code

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---------------------------------------------------------------- mixing

def brute_targets(sizes):
    """Deal 150% of all sizes by weight, cap at twice a size, deal the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = dict(zip(order, [(5, 2, 1)[i % 3] for i in range(len(order))], strict=True))
    left, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        each = left / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if weight[s] * each >= 2 * sizes[s]]
        if not over:
            return {**capped, **{s: weight[s] * each for s in rest}}
        for s in over:
            capped[s] = 2 * sizes[s]
            left -= capped[s]


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1009])
def test_permutation_is_a_bijection(spark, n):
    for seed in (1, 2):
        got = [r[0] for r in spark.range(n).select(
            mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(seed))).collect()]
        assert sorted(got) == list(range(n))
        if n > 50:
            assert got != sorted(got)


def test_mix_targets_and_limits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op3_mix_sources(spark, SF).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    size = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    sizes = defaultdict(int)
    for k, s in source.items():
        sizes[s] += size[k]
    want, taken = brute_targets(sizes), defaultdict(int)
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert abs(r.target - want[source[r.doc_id]]) < 1e-6 * (1 + r.target)
        assert 0 <= r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert len(rows) == len(size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= mixing.BLOCK
    again = queries.op3_mix_sources(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mixing_places_every_slot_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = mixing.mixture(docs, block=32, shard=50)
    info = {r._no: r for r in m.sources.collect()}
    slots = m.placements.where("shard IS NOT NULL").select(
        "_no", "block", "pass", "shard", "slot").distinct().collect()
    places = {r.shard * 50 + r.slot for r in slots}
    assert len(places) == len(slots) == sum(r.slots for r in info.values())
    assert places == set(range(len(places)))
    per = defaultdict(list)
    for r in slots:
        per[r._no].append((r["pass"], r.block))
    for no, got in per.items():
        assert len(set(got)) == len(got) and max(p for p, _ in got) <= 1
        first = {b for p, b in got if p == 0}
        assert len(first) == min(info[no].slots, info[no].blocks)
    counts = {(r.shard, r._no): r["count"] for r in mixing.shard_counts(m).collect()}
    assert sum(counts.values()) == len(slots)


@pytest.fixture(scope="module")
def odd_docs(spark):
    ship_code(spark)
    rng = np.random.default_rng(3)
    rows = [(1, "alpha beta\tgamma\n" * 40, "a", None, 1.0), (2, None, "a", None, None),
            (3, "", None, "x", None), (None, "some text of a null key", None, None, None),
            (4, "tied row " * 20, "b", None, None), (4, "tied row " * 20, "b", None, None),
            (5, " ".join(map(str, rng.integers(0, 99, 40_000))), "\U0001F600", None, None),
            (6, " lead and\n\ntrail \n", "�", None, None), (7, "y" * 200_000, "b", "z", None)]
    return spark.createDataFrame(
        [(k, t, "en", s, None, x, 1, 2, f) for k, t, s, x, f in rows],
        "doc_id long, text string, lang string, source string, n_chars long, _source string, "
        "_no int, length long, slots double")


@pytest.fixture(scope="module")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def test_mixing_defined_cases(odd_docs, no_docs):
    taken = mixing.taken_words(mixing.mixture(odd_docs, block=8)).collect()
    assert len(taken) == odd_docs.count()
    sizes = defaultdict(int)
    for r in odd_docs.collect():
        sizes[r.source] += len(words(r.text))
    want = brute_targets(sizes)
    assert sorted({round(r.target, 6) for r in taken}) == sorted({round(t, 6)
                                                                 for t in want.values()})
    mixed = mixing.mixed_documents(odd_docs, block=8)
    assert mixed.columns == odd_docs.columns
    total = sum(len(words(r.text)) for r in mixed.collect())
    assert total == sum(r.taken for r in taken) and abs(total - 1.5 * sum(sizes.values())) <= 50
    source = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in mixed.collect():
        inside = iter(words(source[r.doc_id]))
        assert all(w in inside for w in words(r.text))  # words of the text, in their order
    assert mixing.taken_words(mixing.mixture(no_docs)).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0


# ---------------------------------------------------------------- packing

def test_encoder_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    theirs, ours = Tokenizer.from_file(path), packing.encoder(path)
    texts = ["", "Hello, world", "<|endoftext|>a<|endoftext|>", "  a\n\n b\t\tö 😀 　x", "'LL don't",
             "\x00\x01", "a" * 3000, " " * 500, "123 4567 äöü ﬁ"]
    for t in texts:
        assert ours.encode(t, allowed_special="all") == theirs.encode(
            t, add_special_tokens=False).ids


def test_plan_holds_every_piece_and_is_close_to_the_bound():
    rng = np.random.default_rng(1)
    for size, kinds in ((64, 30), (64, 0), (256, 200)):
        for _ in range(8):
            counts = np.zeros(size + 1, int)
            for length in rng.integers(1, size + 1, kinds):
                counts[length] += rng.integers(1, 60)
            made = packing.plan(counts)
            lengths = np.arange(size + 1)
            assert (sum((m * x for m, x in made), np.zeros(size + 1, int)) == counts).all()
            assert all((m * lengths).sum() <= size for m, _ in made)
            used = sum(x for _, x in made)
            big = int(counts[size // 2 + 1:].sum())
            bound = max(-(-int((counts * lengths).sum()) // size), big)
            assert used <= 1.02 * sum(x for _, x in packing._best_fit(counts)) + 1
            if size == 256:
                assert used <= 1.05 * bound + 2


def test_plan_where_no_lengths_fill_a_sequence():
    """Lengths of which no combination sums to the size (1,023 at most): 9n sequences hold them."""
    lengths = np.arange(packing.SIZE + 1)
    for n in (1, 10, 1000):
        counts = np.zeros(packing.SIZE + 1, int)
        counts[[515, 262, 258, 249]] = 6 * n, 6 * n, 6 * n, 12 * n
        made = packing.plan(counts)
        assert (sum((m * x for m, x in made), 0 * lengths) == counts).all()
        assert all((m * lengths).sum() <= packing.SIZE for m, _ in made)
        assert sum(x for _, x in made) <= 9 * n + 1


def check_packed(rows, ids_of, size):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.key].append(r)
        by_seq[r.sequence_id].append(r)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    for key, parts in by_doc.items():
        ids, at = ids_of[key], 0
        for i, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            assert r.piece == i and r.start == at and (i == 0 or r.length == size)
            data = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(data)
            assert "ids" not in r or bytes(r.ids) == data
            at += r.length
        assert at == len(ids) and (len(ids) > size or len(parts) == 1)
    return len(by_seq)


def test_packing_round_trip_over_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ship_code(spark)
    enc = packing.encoder(packing.default_tokenizer())
    ids = {r.doc_id: [*enc.encode(r.text or "", allowed_special="all"), 2]
           for r in docs.collect()}
    rows = packing.packed_documents(docs).collect()
    used = check_packed(rows, ids, packing.SIZE)
    assert set(ids) == {r.key for r in rows}
    assert used <= -(-sum(map(len, ids.values())) // packing.SIZE) + 4
    assert queries.op5_best_fit_packing(spark, SF).count() == len(rows)


def test_packing_defined_cases(odd_docs, no_docs):
    rows = packing.packed_documents(odd_docs.where("doc_id <> 4 OR doc_id IS NULL")).collect()
    enc = packing.encoder(packing.default_tokenizer())
    check_packed(rows, {r.doc_id: [*enc.encode(r.text or "", allowed_special="all"), 2]
                        for r in odd_docs.collect()}, packing.SIZE)
    assert {r.length for r in rows if r.key in (2, 3)} == {1}
    twins = packing.packed_documents(odd_docs.where("doc_id = 4")).collect()
    assert len(twins) == 2 and len({(r.sequence_id, r.offset) for r in twins}) == 2
    assert packing.packed_documents(no_docs).count() == 0


# ---------------------------------------------------------------- chat

TURNS = "conv_id long, turn long, role string, text string, seg string, example int"
CHATS = [(1, 0, "system", "be ~0 <kind>"), (1, 1, "user", "hi </turn>\n<turn assistant>\nx"),
         (1, 2, "assistant", "a\n</turn>~1~~2 ü😀"), (1, 3, "user", None), (1, 4, "assistant", ""),
         (1, 5, "user", "trailing"), (2, 0, "user", "no reply"), (3, 0, "assistant", "alone"),
         (4, 0, None, None), (None, 1, "assistant", "null conversation"),
         (5, 7, "user", "tie b"), (5, 7, "user", "tie a"), (5, 7, "user", "tie a"),
         (5, None, "assistant", "null turn first"), (6, 0, "a>b<c~", "odd role"),
         (6, 1, "assistant", "long " * 50_000)]


def test_chat_round_trip_and_defined_cases(spark):
    turns = spark.createDataFrame([(*r, "clash", 1) for r in CHATS], TURNS)
    formatted = chat_format.examples(turns)
    got = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    convs = defaultdict(list)
    for conv, turn, role, text in CHATS:
        convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    assert set(got) == set(convs)
    for conv, own in convs.items():
        own = [(role, text) for _, role, text in sorted(own)]
        assert [(t.role, t.text) for t in got[conv].turns] == own
        assert got[conv].loss == "".join(t for r, t in own if r == "assistant")
    for r in formatted.withColumn("loss", chat_format.loss_text()).collect():
        own = [(role, text) for _, role, text in sorted(convs[r.conv_id])]
        replies = [i for i, (role, _) in enumerate(own) if role == "assistant"]
        if r.example < len(replies):  # the reply closes its example, all before it is context
            assert r.loss == own[replies[r.example]][1]
            assert r.formatted.count("<turn ") == replies[r.example] + 1
        else:
            assert r.loss_length == 0 and r.formatted.count("<turn ") == len(own)
        assert r.formatted.endswith("</turn>\n")
    empty = spark.createDataFrame([], TURNS)
    assert chat_format.read_back(chat_format.examples(empty)).count() == 0


def test_chat_query_over_the_table(spark):
    rows = {r.conv_id: r for r in queries.op6_chat_format(spark, SF).collect()}
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        convs[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    convs[-7] = [(0, "user", queries.TRICKY), (1, "assistant", queries.TRICKY)]
    assert set(rows) == set(convs)
    for conv, own in convs.items():
        own.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        lost = "".join(text for _, role, text in own if role == "assistant")
        r = rows[conv]
        assert (r.n_turns, r.loss_chars) == (len(own), len(lost))
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(lost.encode()).hexdigest()


# ---------------------------------------------------------------- language

def test_language_of_held_out_documents(spark):
    ship_code(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1").toPandas()
    score = model.scores(pa.array(held.text)) + model.prior
    assert (np.array(model.languages)[score.argmax(1)] == held.lang).mean() > 0.98


def test_language_of_pages_agrees_with_their_addresses(spark):
    got = queries.op4_language_id(spark, "/root/testdata/sf0.01").toPandas()
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").toPandas()
    both = got.merge(pages, on="page_id")
    told = both.url.str.extract("/(de|en|es|fr)/")[0]
    assert len(both) == len(pages) and (both.lang == told).mean() > 0.99


PAGES = "page_id long, url string, html string, host string, p double, declared int"


def test_language_evidence_is_fused(spark):
    """A page without text takes its declared language; one without either, its host's."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(docs)
    de = [r.text[:600] for r in docs.where("lang = 'de'").limit(30).collect()]
    en = [r.text[:600] for r in docs.where("lang = 'en'").limit(30).collect()]
    page = '<html lang="{}"><script>function the() {{ of and }}</script><p>{}</p></html>'.format
    rows = [(i, f"http://a.example.de/{i}", page("de", t)) for i, t in enumerate(de)]
    rows += [(100 + i, f"http://b.example.com/{i}", page("en", t)) for i, t in enumerate(en)]
    rows += [(200, "http://c.another.org/", page("de", "")), (201, "http://a.example.de/x", "<p></p>"),
             (202, "http://b.example.com/y", None), (203, None, page("en", en[0])),
             (204, "", ""), (None, None, None), (100, "http://b.example.com/0", page("en", en[0])),
             (205, "http://b.example.com/z", page("en", de[0] + "<!-- " + "x " * 100_000))]
    frame = spark.createDataFrame([(*r, "h", 0.5, 3) for r in rows], PAGES)
    found = language_id.identify(frame, model).collect()
    got = {r.page_id: r for r in found}
    assert len(found) == len(rows)
    assert got[200].lang == "de" and got[201].lang == "de" and got[202].lang == "en"
    assert got[203].lang == "en" and got[205].lang == "de" and got[0].lang == "de"
    assert all(0 <= r.confidence <= 1 for r in found)
    assert language_id.identify(frame.limit(0), model).count() == 0
    none = language_id.train(docs.limit(0))
    assert {r.lang for r in language_id.identify(frame, none).collect()} == {None}


# ---------------------------------------------------------------- classifiers

def test_classifiers_learn_without_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    for name, label, folds, held, least in (("op7_toxicity", "toxic", 4, 2, 0.95),
                                            ("op8_quality_classifier", "quality", 5, 0, 0.98)):
        rows = queries.QUERIES[name](spark, sf).toPandas()
        assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
        fold = rows.doc_id.map(lambda k, n=folds: zlib.crc32(str(k).encode()) % n)
        assert (rows.held_out == (fold == held)).all()
        assert rows.score.between(0, 1).all()
        assert (rows.predicted == (rows.score >= 0.3)).all()
        both = rows[rows.held_out].merge(labels, on="doc_id")
        assert (both.predicted == both[label]).mean() > least


def test_held_out_labels_are_not_used(spark):
    ship_code(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    for fit, label, held in ((toxicity.toxicity_model, "toxic", key % 4 == 2),
                             (factorisation.quality_model, "quality", key % 5 == 0)):
        turned = labels.withColumn(label, F.when(held, 1 - F.col(label)).otherwise(F.col(label)))
        a, b = fit(docs, labels), fit(docs, turned)
        first = "weights" if label == "toxic" else "weight"
        assert a.bias == b.bias and (getattr(a, first) == getattr(b, first)).all()


def features_of(texts):
    slots, begins = [], [0]
    for _, _, s, b in toxicity.features(pa.array(texts)):
        slots.append(s)
        begins += (b[1:] + begins[-1]).tolist()
    return np.concatenate(slots), np.array(begins)


def test_swapping_identity_terms_hardly_moves_the_score():
    """Insults that in the labelled texts fall on one group only must not colour its mention."""
    rng = np.random.default_rng(8)
    groups = (("muslims", "christians", "jews", "buddhists"),)

    def filler(n):
        return " ".join(f"word{int(i)}" for i in rng.integers(0, 200, n))

    texts = [f"{filler(12)} {w} {filler(8)}" for w in ("muslims",) * 60 for _ in range(1)]
    texts = [t + " idiot" for t in texts] + [f"{filler(15)} muslims" for _ in range(25)]
    labels = [1] * 60 + [0] * 25
    texts += [f"{filler(12)} christians {filler(6)}" for _ in range(150)]
    texts += [f"{filler(20)} scum {filler(3)}" for _ in range(40)]
    labels += [0] * 150 + [1] * 40
    slots, begins = features_of(texts)
    y = np.array(labels, float)
    plain = toxicity.train(slots, begins, y, groups, fairness=0.0)
    fair = toxicity.train(slots, begins, y, groups)
    neutral = [f"we met some {g} today" for g in groups[0]]
    s, b = features_of(neutral)

    def spread(m):
        return np.ptp(m.logits(s, b))

    assert spread(fair) < 0.2 * spread(plain) and spread(fair) < 0.5
    assert toxicity.sigmoid(fair.logits(s, b)).max() < 0.3
    s, b = features_of(["such an idiot", "you scum", "a nice day"])
    assert list(toxicity.sigmoid(fair.logits(s, b)) >= 0.3) == [True, True, False]


def test_linear_time_interactions_equal_the_pairwise_sum():
    rng = np.random.default_rng(9)
    size = factorisation.SLOTS + len(factorisation.STATS)
    m = factorisation.Model(0.3, rng.normal(size=size), rng.normal(size=(size, 8)),
                            np.zeros(len(factorisation.STATS)), np.ones(len(factorisation.STATS)))
    slots = rng.choice(factorisation.SLOTS, 12, replace=False)
    begins = np.array([0, 5, 5, 12])
    stats = rng.normal(size=(3, len(factorisation.STATS)))
    got = m.logits(slots, begins, stats)
    for r in range(3):
        own = slots[begins[r]:begins[r + 1]]
        x = np.r_[np.full(len(own), 1 / max(len(own), 1) ** 0.5), m.dense(stats)[r]]
        at = np.r_[own, np.arange(factorisation.SLOTS, size)]
        v, want = m.factor[at], m.bias + m.weight[at] @ x
        want += sum(v[i] @ v[j] * x[i] * x[j] for i in range(len(x)) for j in range(i))
        assert abs(want - got[r]) < 1e-9


def test_classifiers_defined_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 1, "c"), (1, 0, 0, "c"), (3, 0, 0, None), (5, None, None, "c"), (None, 1, 1, "c"),
         (6, 7, 7, "c")], "doc_id long, quality int, toxic int, text string")
    for fit, score in ((toxicity.toxicity_model, toxicity.score_toxicity),
                       (factorisation.quality_model, factorisation.score_quality)):
        for given in (labels, labels.limit(0)):
            rows = score(odd_docs, fit(odd_docs, given)).collect()
            assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
            assert len({r.score for r in rows if r.doc_id == 4}) == 1
        assert score(no_docs, fit(no_docs, labels)).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages_act_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [s.__module__ for _, s in corpus_pipeline.STAGES] == ["corpus_pipeline"] * 5
    kept, wanted = docs, {r.doc_id for r in quality_rules.quality_measures(docs).where("kept")
                          .collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, SF)
        if i < 4:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{i}")
        before, kept = kept, spark.read.parquet(f"{tmp_path}/{i}")
        if i == 0:
            assert {r.doc_id for r in kept.collect()} == wanted
        elif i == 1:
            assert {r.doc_id for r in kept.collect()} == {
                r._keep for r in exact_dedup.copy_groups(before).collect()}
        elif i == 2:
            assert {r.doc_id for r in kept.collect()} == {
                r.group for r in near_dedup.near_groups(before).collect()}
        elif i == 3:
            taken = {r.key: r.taken for r in
                     mixing.taken_words(mixing.mixture(before)).collect() if r.taken}
            got = defaultdict(int)
            for r in kept.collect():
                got[r.doc_id] += len(words(r.text))
                assert r.n_chars == len(r.text)
            assert got == taken
        else:
            enc = packing.encoder(packing.default_tokenizer())
            want = sum(len(enc.encode(r.text, allowed_special="all")) + 1
                       for r in before.collect())
            assert sum(r.length for r in kept.collect()) == want
            assert max(r.offset + r.length for r in kept.collect()) <= packing.SIZE
    assert corpus_pipeline.run(spark, SF).count() == kept.count()
