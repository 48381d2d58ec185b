"""The registered queries of the text operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import (
    chat_format,
    conversation_trie,
    exact_dedup,
    factorisation,
    language_id,
    mixing,
    near_dedup,
    packing,
    passages,
    quality_rules,
    sharding,
    spelling,
    substring_dedup,
    toxicity,
)
from .common import table


def op1_quality_rules(spark, sf_dir) -> DataFrame:
    """Repetition rules over every document."""
    return quality_rules.quality_measures(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir) -> DataFrame:
    """Every paragraph that repeats, its class (named by the document whose copy stays) and
    whether it is to be removed; and, without paragraph and class, every span of passages that
    repeat inside longer lines or across lines."""
    found = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), "paragraph", "start", "length", "words",
        F.col("class_key").alias("class_id"), "class_paragraph", "class_size", "removed")


def op2_repeated_passages(spark, sf_dir) -> DataFrame:
    """Every span of words in passages of 50 words or more that two documents hold, inside lines or
    across them, and whether it is to be removed."""
    found = passages.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "start", "length", "words", "removed")


def op3_mix_sources(spark, sf_dir) -> DataFrame:
    """How much of every document the mix takes."""
    taken = mixing.taken_words(mixing.mixture(table(spark, sf_dir, "documents")))
    return taken.withColumnRenamed("key", "doc_id")


def op4_language_id(spark, sf_dir) -> DataFrame:
    """The language of every page, by trigram models of all documents."""
    model = language_id.train(table(spark, sf_dir, "documents"))
    return language_id.identify(table(spark, sf_dir, "pages"), model)


def op5_best_fit_packing(spark, sf_dir) -> DataFrame:
    """Every piece of every document, its sequence and its place there."""
    packed = packing.packed_documents(table(spark, sf_dir, "documents"), with_ids=False)
    return packed.withColumnRenamed("key", "doc_id")


def op6_chat_format(spark, sf_dir) -> DataFrame:
    """All conversations and one that imitates a template, formatted and read back."""
    columns = ["conv_id", "turn", "role", "text"]
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"))
    turns = table(spark, sf_dir, "conversations").select(*columns).unionByName(tricky)
    back = chat_format.read_back(chat_format.examples(turns))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op7_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of every document by a model of the labelled ones that are not held out."""
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    return toxicity.score_toxicity(docs, toxicity.toxicity_model(docs, labels))


def op8_quality_classifier(spark, sf_dir) -> DataFrame:
    """Quality of every document by a model of the labelled ones that are not held out."""
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    model = factorisation.quality_model(docs, labels, metadata=("n_chars",))
    return factorisation.score_quality(docs, model, metadata=("n_chars",))


def op9_minhash_near_dedup(spark, sf_dir) -> DataFrame:
    """The near-duplicate group of every document, named by the document of it that stays."""
    groups = near_dedup.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("key").alias("doc_id"), F.col("group").alias("class_id"),
        F.col("group_size").alias("class_size"), "kept")


def op10_exact_dedup(spark, sf_dir) -> DataFrame:
    """Groups of equal texts (A-Z lower-cased) and the row of each that stays."""
    groups = exact_dedup.copy_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("_key").alias("doc_id"), F.col("_keep").alias("keep_id"),
                         F.col("_size").alias("group_size"),
                         F.col("_key").eqNullSafe(F.col("_keep")).alias("kept"),
                         F.col("_sha").alias("text_sha256"))


def op11_jump_sharding(spark, sf_dir) -> DataFrame:
    """Every document's shard of 24 and its slot there, and its shard of 25."""
    placed = sharding.placed_rows(table(spark, sf_dir, "documents"))
    return placed.withColumnRenamed("key", "doc_id").withColumn("law", F.lit("key"))


def op12_spelling_variants(spark, sf_dir) -> DataFrame:
    """The words of all documents, their near words and the forms that they are variants of."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark, sf_dir) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


TRICKY = "\\### Assistant: </turn> ok"

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_mix_sources": op3_mix_sources,
    "op4_language_id": op4_language_id,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_chat_format": op6_chat_format,
    "op7_toxicity": op7_toxicity,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_jump_sharding": op11_jump_sharding,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_trie": op13_conversation_trie,
}

#: CRC-32 of a string's UTF-8 bytes, for SQL: its table of 256 remainders, and the bytes folded.
_CRC_TABLE = """crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS rest
    FROM range(256) r(i))"""


def _crc(column: str) -> str:
    octets = (f"list_transform(regexp_extract_all(hex(encode({column})), '..'), "
              "lambda h: CAST('0x' || h AS BIGINT))")
    return (f"xor(list_reduce({octets}, lambda c, x: xor(c >> 8, "
            "rest[CAST((xor(c, x) & 255) + 1 AS INT)]), 4294967295), 4294967295)")


ORACLE_SQL = {
    # Sizes of markers: "<turn " and ">\\n" before a text, "</turn>\\n" after it; "~", "<" and ">"
    # take one more character each.
    "op6_chat_format": """
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
m AS (
    SELECT *, 16 + length(role) + length(regexp_replace(role, '[^~<>]', '', 'g'))
           + length(text) + length(regexp_replace(text, '[^~<>]', '', 'g')) AS chars
    FROM c),
p AS (
    SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS turns,
           sum(chars) OVER w AS upto
    FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text
                        ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT)
           AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR pos = turns) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
""",
    "op10_exact_dedup": """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents),
g AS (
    SELECT body, max(doc_id) AS keep_id, count(*) AS group_size, sha256(body) AS text_sha256
    FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM t JOIN g USING (body)
""",
    # Jumps of a key: its generator's state, and the shard count at which it jumps next.
    "op11_jump_sharding": f"""
WITH RECURSIVE {_CRC_TABLE},
t AS (
    SELECT doc_id, coalesce(text, '') AS body,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS UBIGINT) AS h
    FROM documents),
r AS (
    SELECT doc_id, h, octet_length(encode(body)) + 8 AS size, {_crc("body")} AS text_crc32
    FROM t, crc_table),
jumps AS (
    SELECT h, CAST(h AS HUGEINT) AS state, CAST(0 AS BIGINT) AS place FROM (SELECT DISTINCT h FROM t)
    UNION ALL
    SELECT h, state, place FROM (
        SELECT h, next AS state, CAST(floor(CAST(place + 1 AS DOUBLE) * (CAST(2147483648 AS DOUBLE)
               / CAST((next >> 33) + 1 AS DOUBLE))) AS BIGINT) AS place
        FROM (SELECT h, place, (state * 2862933555777941757 + 1) % 18446744073709551616 AS next
              FROM jumps))
    WHERE place < 25),
s AS (
    SELECT h, max(place) FILTER (place < 24) AS shard, max(place) AS grown_shard FROM jumps GROUP BY h)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
       row_number() OVER (PARTITION BY shard
           ORDER BY xor(h, 9223372036854775808), doc_id NULLS FIRST, size,
                    text_crc32) - 1 AS slot,
       CAST(grown_shard AS INT) AS grown_shard
FROM r JOIN s USING (h)
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run
          FROM documents)
    WHERE length(run) >= 7),
hashed AS (
    SELECT *, {_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
    FROM runs, crc_table),
words AS (
    SELECT word, count(*) AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:]
                    ELSE run END AS word
        FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cuts AS (SELECT DISTINCT word, n, word[:i - 1] || word[i + 1:] AS cut FROM places),
masks AS (SELECT word, n, i, word[:i - 1] || '*' || word[i + 1:] AS mask FROM places),
near AS (
    SELECT c.word AS a, w.word AS b, w.n AS n_b FROM cuts c JOIN words w ON c.cut = w.word
    UNION ALL
    SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.cut = w.word
    UNION ALL
    SELECT x.word, y.word, y.n FROM masks x JOIN masks y ON x.mask = y.mask AND x.word <> y.word),
best AS (
    SELECT a, count(*) AS n_near, max(n_b) AS n_b, arg_min(b, (-n_b, b)) AS b
    FROM near GROUP BY a),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN n_b >= 10 * n THEN b END AS form,
           CASE WHEN n_b >= 10 * n THEN n_b END AS form_n
    FROM words LEFT JOIN best ON a = word),
chain AS (
    SELECT word, word AS root, 0 AS steps FROM formed
    UNION ALL
    SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN formed f ON f.word = c.root
    WHERE f.form IS NOT NULL)
SELECT word, form, arg_max(chain.root, steps) AS root, n, n_near, form_n
FROM formed JOIN chain USING (word) GROUP BY word, form, n, n_near, form_n
""",
    "op13_conversation_trie": f"""
WITH {_CRC_TABLE},
t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
           length(coalesce(text, '')) AS chars
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (
    SELECT conv_id, conv_id - conv_id % 100 AS head,
           {_crc("CAST(conv_id AS VARCHAR)")} % 6 AS share
    FROM (SELECT DISTINCT conv_id FROM t), crc_table),
r AS (
    SELECT c.conv_id, 0 AS part, pos, id, chars FROM c JOIN t ON t.conv_id = head AND pos < share
    UNION ALL
    SELECT conv_id, 1, pos, id, chars FROM c JOIN t USING (conv_id) WHERE pos >= share),
d AS (
    SELECT conv_id, chars, row_number() OVER w AS depth, string_agg(id, '') OVER w AS path
    FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
m AS (
    SELECT conv_id, 0 AS depth, '' AS path, 0 AS chars FROM c
    UNION ALL SELECT conv_id, depth, path, chars FROM d),
longest AS (SELECT conv_id, max(depth) AS len FROM m GROUP BY conv_id),
nodes AS (
    SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                           FILTER (len = depth), '')) AS ends_sha256
    FROM m JOIN longest USING (conv_id) GROUP BY depth, path),
linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id
    FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1
                                  AND p.path = left(n.path, length(n.path) - 32)),
counted AS (
    SELECT n.*, coalesce(k.n, 0) AS n_children
    FROM linked n LEFT JOIN (SELECT parent_conv_id, depth - 1 AS at_depth, count(*) AS n FROM linked
                             GROUP BY ALL) k
      ON k.parent_conv_id = n.conv_id AND k.at_depth = n.depth),
sums AS (
    SELECT m.depth, m.path, sum((n_convs - 1) * n.chars) AS saved_tokens,
           count(*) FILTER (n_children = 0) AS n_leaves
    FROM counted n JOIN m ON m.conv_id = n.conv_id AND m.depth <= n.depth
    GROUP BY m.depth, m.path)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN sums USING (depth, path)
""",
}
