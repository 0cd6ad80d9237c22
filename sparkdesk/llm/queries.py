"""One query per operator, over whole tables with production parameters; each derives its digest from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.llm import decontaminate, jaccard, language, merkle, pieces, prefix_trie, pseudonyms, sentence_spans, sharding, suffixes, toxicity, vantage, whitening
from sparkdesk.llm.common import fold, table

PSEUDONYM_KEY = "corpus-2024"  # in production from the caller's secret store
TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.with_edited(table(spark, sf_dir, "documents"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       merkle.fingerprint(F.col("text")).alias("fingerprint"), merkle.fingerprint(F.col("edited")).alias("edited_fingerprint"), "after_print")
    rows = rows.withColumns({k: merkle.leaf_set(F.col(c)) for k, c in (("own", "fingerprint"), ("new", "edited_fingerprint"), ("after", "after_print"))})
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       merkle.likeness(F.col("own"), F.col("new")).alias("near_edited"), merkle.likeness(F.col("own"), F.col("after")).alias("near_next"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffled(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 0
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.scored(docs.select("doc_id", "text"), machine).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sentence_spans.without_repeats(docs, passage_words=sentence_spans.PASSAGE_WORDS).where(F.size("removed") > 0)
    return rows.select("doc_id", F.size("removed").alias("removed_sentences"), "removed", F.sort_array("first_docs").alias("first_docs"), "kept")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = language.fit(language.learned(docs))
    return language.identified(docs.select("doc_id", "text"), models).select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("n_links")  # which links were verified has no SQL


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.positioned(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_shared_openings(turns, group=100, most=6))


def op12_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = vantage.Index(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return index.nearest(F.col("id") % 20 == 0, k=20)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_merkle, op3_shards, op4_toxicity, op5_sentence_spans, op6_language, op7_pseudonyms, op8_jaccard, op9_suffixes, op10_pieces,
                          op11_prefix_trie, op12_vantage_trees, op13_whitening)
}

_JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), e AS (SELECT doc_id, unnest(s) AS k FROM s),
reps AS (SELECT min(doc_id) AS rep, list_sort(s) AS t, len(any_value(s)) AS n FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
own AS (SELECT s.doc_id, coalesce(r.rep, s.doc_id) AS rep, len(s.s) AS n FROM s LEFT JOIN reps r ON list_sort(s.s) = r.t),
er AS (SELECT hash(k) AS k, doc_id, n FROM e JOIN reps ON doc_id = rep),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM er a JOIN er b ON a.k = b.k AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
g AS (SELECT u, v FROM p UNION SELECT v, u FROM p),
r(a, b) AS (SELECT rep, rep FROM reps UNION SELECT r.a, g.v FROM r JOIN g ON r.b = g.u)
SELECT o.doc_id, CAST(o.n AS BIGINT) AS n_shingles, coalesce(m.c, o.doc_id) AS component_id
FROM own o LEFT JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON o.rep = m.a
"""

_CRC32_SQL = """xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""

_TRIE_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), s AS (SELECT conv_id, count(*) AS size, CAST({_CRC32_SQL} AS BIGINT) % 6 AS h, conv_id - conv_id % 100 AS base FROM t GROUP BY conv_id),
c AS (SELECT s.*, least(s.h, coalesce(b.size, 0)) AS opened FROM s LEFT JOIN s b ON b.conv_id = s.base),
r AS (
  SELECT c.conv_id, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos < opened
  UNION ALL SELECT c.conv_id, t.pos - h + opened, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.pos >= h
), p AS (
  SELECT conv_id, pos + 1 AS depth, length(text) AS chars, string_agg(md5(length(role) || ':' || role || text), '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM r
), n AS (
  SELECT conv_id, depth, md5(path) AS id, coalesce(lag(md5(path)) OVER (PARTITION BY conv_id ORDER BY depth), 'root') AS parent, chars FROM p
  UNION ALL SELECT conv_id, 0, 'root', NULL, 0 FROM c
), g AS (SELECT id, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n, any_value(chars) AS chars FROM n GROUP BY id),
k AS (SELECT parent, count(*) AS n_children FROM g WHERE parent IS NOT NULL GROUP BY parent),
x AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k ON k.parent = g.id),
b AS (SELECT a.id, sum((x.n - 1) * x.chars) AS saved, count(*) FILTER (x.n_children = 0) AS leaves FROM x JOIN n a ON a.conv_id = x.conv_id AND a.depth <= x.depth GROUP BY a.id),
e AS (SELECT id, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ends FROM n WHERE depth = (SELECT max(m.depth) FROM n m WHERE m.conv_id = n.conv_id) GROUP BY id)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children, CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(e.ends, '')) AS ends_sha256
FROM x JOIN b ON b.id = x.id LEFT JOIN e ON e.id = x.id LEFT JOIN g q ON q.id = x.parent
"""

ORACLES: dict[str, str] = {"op8_jaccard": _JACCARD_SQL, "op11_prefix_trie": _TRIE_SQL}
