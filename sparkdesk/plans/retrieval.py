"""Retrieval queries. The query vectors are the mean vectors of all labels; text queries are the benchmark texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions import text as X
from sparkdesk.operators import retrieval as V
from sparkdesk.operators import table_functions as N
from sparkdesk.operators.inverted import recall
from sparkdesk.plans.corpus import QUALITY, WORDS, _KW, measured
from sparkdesk.plans.demand import r
from sparkdesk.plans.registry import query
from sparkdesk.session import materialize


def docs(t):
    return t.embeddings.select(F.col("vec_id").alias("doc_id"), "label", "embedding")


def label_queries(t):
    return V.centroids(t.embeddings, "label").select(F.col("label").cast("bigint").alias("query_id"), "label", "embedding")


def _hits_sql(k, cond="true"):
    return f"""vec AS (SELECT vec_id AS doc_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    cell AS (SELECT label, generate_subscripts(e, 1) AS p, unnest(e) AS x FROM vec), mean AS (SELECT label, p, avg(x) AS m FROM cell GROUP BY 1, 2),
    qv AS (SELECT CAST(label AS BIGINT) AS query_id, label, list(m ORDER BY p) AS c FROM mean GROUP BY ALL),
    sim AS (SELECT query_id, doc_id, list_cosine_similarity(e, c) AS similarity FROM vec JOIN qv ON {cond}),
    hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 6) DESC, doc_id) AS rank FROM sim) WHERE rank <= {k})"""


OUT = "query_id, doc_id, CAST(rank AS INTEGER) AS rank, round(similarity, 5) AS similarity"


def out(hits):
    return r(hits.select("query_id", "doc_id", "rank", "similarity"), 5)


@query("v01_cosine_top_k", f"WITH {_hits_sql(5)} SELECT {OUT} FROM hits")
def _(t):
    return out(V.cosine_top_k(label_queries(t), docs(t), 5))


@query("v02_filtered_top_k", f"WITH {_hits_sql(5, 'vec.label = qv.label OR qv.label >= 8')} SELECT {OUT} FROM hits")
def _(t):
    q = label_queries(t).withColumn("label", F.when(F.col("label") < 8, F.col("label")))
    return out(V.cosine_top_k(q, docs(t), 5, filters=["label"]))


@query("v03_threshold", f"WITH {_hits_sql(50)} SELECT {OUT} FROM hits WHERE similarity >= 0.3")
def _(t):
    return out(V.cosine_top_k(label_queries(t), docs(t), 50, threshold=0.3))


@query("v04_approximate_top_k")
def _(t):
    return out(V.approximate_top_k(label_queries(t), docs(t), 5))


@query("v04_recall", f"""WITH {_hits_sql(5)}, n AS (SELECT query_id, count(*) AS n FROM hits GROUP BY 1)
  SELECT count(*) AS wanted, true AS recall_of_nine_tenths, true AS as_many_as_asked FROM hits""")
def _(t):
    exact = materialize(V.cosine_top_k(label_queries(t), docs(t), 5), "v04-exact")
    found = materialize(V.approximate_top_k(label_queries(t), docs(t), 5), "v04-found")
    share = recall(found, exact, ["query_id", "doc_id"]).select("wanted", (F.col("recall") >= 0.9).alias("recall_of_nine_tenths"))
    many = lambda df: df.groupBy("query_id").agg(F.count("*").alias("n"))
    fewer = many(exact).join(many(found).withColumnRenamed("n", "m"), "query_id", "left").where("m IS NULL OR m < n").agg(F.count("*")).scalar()
    return share.withColumn("as_many_as_asked", fewer == 0)


_CALL = """SELECT query_id, doc_id, rank, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 6) DESC, doc_id) AS rank
  FROM nearest_vectors(5, TABLE({input}) PARTITION BY part ORDER BY is_doc)) WHERE rank <= 5"""


def called(t, queries):
    """The table function called from SQL."""
    N.register(t.spark)
    return out(t.spark.sql(_CALL, input=N.as_input(queries, docs(t), 8)))


@query("v01_table_function", f"WITH {_hits_sql(5)} SELECT {OUT} FROM hits")
def _(t):
    return called(t, label_queries(t).withColumn("label", F.lit(None)))


@query("v02_table_function", f"WITH {_hits_sql(5, 'vec.label = qv.label OR qv.label >= 8')} SELECT {OUT} FROM hits")
def _(t):
    return called(t, label_queries(t).withColumn("label", F.when(F.col("label") < 8, F.col("label"))))


# --- keywords ----------------------------------------------------------------------------------------
_TOK = lambda c: rf"list_filter(regexp_split_to_array({c}, '[\s\p{{Z}}]+'), lambda w: w <> '')"


def _bm25_sql(k):
    return f"""wd AS (SELECT doc_id, unnest({_TOK('text')}) AS term FROM documents), dl AS (SELECT doc_id, len({_TOK('text')}) AS dl FROM documents),
    st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), tf AS (SELECT doc_id, term, count(*) AS tf FROM wd GROUP BY 1, 2),
    dfreq AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS idf0 FROM tf, st GROUP BY term, n),
    idf AS (SELECT term, CASE WHEN idf0 < 0 THEN 0.25 * (SELECT avg(idf0) FROM dfreq) ELSE idf0 END AS idf FROM dfreq),
    qw AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest({_TOK('text')}) AS term FROM benchmark) GROUP BY 1, 2),
    sc AS (SELECT query_id, doc_id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM qw JOIN idf USING (term) JOIN tf USING (term) JOIN dl USING (doc_id), st GROUP BY 1, 2),
    bm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM sc) WHERE rank <= {k})"""


def text_queries(t):
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text")


@query("v05_bm25", f"WITH {_bm25_sql(4)} SELECT query_id, doc_id, CAST(rank AS INTEGER) AS rank, round(score, 5) AS score FROM bm")
def _(t):
    return r(V.bm25_top_k(text_queries(t), t.documents, 4), 5)


# one id space: a document and its vector share an id, a benchmark item asks with its text and with the vector of its id
_ITEM_HITS = """vec AS (SELECT vec_id AS doc_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)),
    qv AS (SELECT item_id AS query_id, CAST(embedding AS DOUBLE[]) AS c FROM benchmark JOIN embeddings ON vec_id = item_id),
    hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 6) DESC, doc_id) AS rank
      FROM (SELECT query_id, doc_id, list_cosine_similarity(e, c) AS similarity FROM vec CROSS JOIN qv)) WHERE rank <= 6)"""

FUSED = f"""{_ITEM_HITS}, {_bm25_sql(4)}, fs AS (SELECT query_id, doc_id, sum(p) AS fused FROM (SELECT query_id, doc_id, 0.4 / (60 + rank) AS p FROM hits
    UNION ALL SELECT query_id, doc_id, 0.6 / (60 + rank) FROM bm) GROUP BY 1, 2),
  fused AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 9) DESC, doc_id) AS rank FROM fs)"""


def fused(t):
    asked = text_queries(t).join(t.embeddings.select(F.col("vec_id").alias("query_id"), "embedding"), "query_id")
    vectors = docs(t).join(t.documents.select("doc_id"), "doc_id", "left_semi")
    vector = V.cosine_top_k(asked, vectors, 6)
    words = V.bm25_top_k(text_queries(t), t.documents, 4)
    return V.fuse_ranks([(vector, 0.4), (words, 0.6)])


@query("v06_fused_ranks", f"WITH {FUSED} SELECT query_id, doc_id, CAST(rank AS INTEGER) AS rank, round(fused, 8) AS fused FROM fused")
def _(t):
    return r(fused(t), 8)


@query("v07_source_context", f"""WITH {FUSED}, h AS (SELECT f.query_id, f.rank, CASE WHEN lang = 'en' THEN 'FILING' ELSE 'NEWS' END AS source, trim(text) AS t FROM fused f JOIN documents USING (doc_id) WHERE trim(text) <> ''),
  k AS (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY rank) AS k FROM h), j AS (SELECT query_id, source, string_agg(t, chr(10) || '---' || chr(10) ORDER BY k) AS found FROM k WHERE k <= 3 GROUP BY 1, 2)
  SELECT b.item_id AS query_id, s.source, coalesce(found, b.text) AS context FROM benchmark b CROSS JOIN (VALUES ('FILING'), ('NEWS')) s(source) LEFT JOIN j ON j.query_id = b.item_id AND j.source = s.source""")
def _(t):
    source = F.when(F.col("lang") == "en", "FILING").otherwise("NEWS").alias("source")
    hits = fused(t).join(t.documents.select("doc_id", source, "text"), "doc_id")
    fallback = t.benchmark.select(F.col("item_id").alias("query_id"), F.explode(F.array(F.lit("FILING"), F.lit("NEWS"))).alias("source"), F.col("text").alias("section"))
    return V.source_context(hits, "source", "text", fallback)


# --- evaluation ---------------------------------------------------------------------------------------
def hits_at(t, k):
    return V.cosine_top_k(label_queries(t), docs(t), k)


_BANDS = """count(*) AS n, round(avg(similarity), 5) AS mean_sim, round(min(similarity), 5) AS min_sim, round(max(similarity), 5) AS max_sim, round(avg(CASE WHEN similarity >= 0.85 THEN 1.0 ELSE 0.0 END), 5) AS good,
  round(avg(CASE WHEN similarity >= 0.70 AND similarity < 0.85 THEN 1.0 ELSE 0.0 END), 5) AS fair, round(avg(CASE WHEN similarity < 0.70 THEN 1.0 ELSE 0.0 END), 5) AS weak"""


@query("v08_bands_by_query", f"WITH {_hits_sql(10)} SELECT query_id, {_BANDS} FROM hits GROUP BY 1")
def _(t):
    return r(V.similarity_bands(hits_at(t, 10), "query_id"), 5)


@query("v08_bands_by_rank", f"WITH {_hits_sql(10)} SELECT CAST(rank AS INTEGER) AS rank, {_BANDS} FROM hits GROUP BY 1")
def _(t):
    return r(V.similarity_bands(hits_at(t, 10), "rank"), 5)


@query("v09_k_sensitivity", f"""WITH {_hits_sql(15)} SELECT k.k, query_id, round(avg(similarity), 5) AS mean_sim, round(min(similarity), 5) AS min_sim, round(max(similarity), 5) AS top1_sim,
  round(avg(CASE WHEN similarity < 0.70 THEN 1.0 ELSE 0.0 END), 5) AS weak FROM hits JOIN (SELECT unnest([3, 5, 7, 10, 15]) AS k) k ON rank <= k.k GROUP BY 1, 2""")
def _(t):
    return r(V.k_sensitivity(hits_at(t, 15)), 5)


@query("v10_trend_doc", """SELECT source, query_no, rank, chunk_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY query_no, rank) AS k FROM (
  SELECT source, doc_id % 4 AS query_no, doc_id AS rank, 'c' || doc_id AS chunk_id, CASE WHEN lang = 'de' THEN 'trend' WHEN lang = 'fr' THEN '' ELSE 'city' END AS section, text FROM documents)
  WHERE section IN ('', 'trend') AND contains(source || ' ' || section || ' ' || chunk_id || ' ' || text || ' kw', 'un')) WHERE k = 1""")
def _(t):
    section = F.when(F.col("lang") == "de", "trend").when(F.col("lang") == "fr", "").otherwise("city")
    hits = t.documents.select("source", (F.col("doc_id") % 4).alias("query_no"), F.col("doc_id").alias("rank"), F.concat(F.lit("c"), "doc_id").alias("chunk_id"),
                              section.alias("section"), F.col("source").alias("title"), F.col("text").alias("content"), F.array(F.lit("kw")).alias("keywords"))
    return V.matching_trend_doc(hits, "source", F.lit("un")).select("source", "query_no", "rank", "chunk_id")


@query("v11_retrieval_grade", f"""WITH {_hits_sql(10)}, {QUALITY}, rec AS (SELECT avg(len(list_intersect({_KW('a.text')}, {_KW('b.text')})) / CAST(greatest(len({_KW('a.text')}), 1) AS DOUBLE)) AS v
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
  m AS (SELECT 'mean_similarity' AS measure, avg(similarity) AS value FROM hits UNION ALL SELECT 'good_chunks', avg(CASE WHEN score >= 0.6 THEN 1.0 ELSE 0.0 END) FROM quality
    UNION ALL SELECT 'noise_at_5', avg(CASE WHEN similarity < 0.70 THEN 1.0 ELSE 0.0 END) FROM hits WHERE rank <= 5 UNION ALL SELECT 'keyword_recall', v FROM rec)
  SELECT measure, round(value, 5) AS value, CASE measure WHEN 'mean_similarity' THEN CASE WHEN value >= 0.80 THEN 'good' WHEN value >= 0.70 THEN 'fair' ELSE 'poor' END
    WHEN 'good_chunks' THEN CASE WHEN value >= 0.7 THEN 'good' WHEN value >= 0.5 THEN 'fair' ELSE 'poor' END WHEN 'noise_at_5' THEN CASE WHEN value <= 0.1 THEN 'good' WHEN value <= 0.2 THEN 'fair' ELSE 'poor' END
    ELSE CASE WHEN value >= 0.6 THEN 'good' WHEN value >= 0.4 THEN 'fair' ELSE 'poor' END END AS grade FROM m""")
def _(t):
    hits = hits_at(t, 10)
    weak = (F.col("similarity") < 0.70).cast("double")
    kw = t.conversations.select("conv_id", "turn", X.keyword_set("text", WORDS).alias("kw"))
    ctx = kw.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("kw").alias("ctx"))
    rows = [
        hits.agg(F.avg("similarity").alias("mean_similarity"), F.avg(F.when(F.col("rank") <= 5, weak)).alias("noise_at_5")).unpivot([], ["mean_similarity", "noise_at_5"], "measure", "value"),
        measured(t).agg(F.avg((F.col("score") >= 0.6).cast("double")).alias("value")).select(F.lit("good_chunks").alias("measure"), "value"),
        kw.join(ctx, ["conv_id", "turn"]).agg(F.avg(X.keyword_recall(F.col("kw"), F.col("ctx"))).alias("value")).select(F.lit("keyword_recall").alias("measure"), "value"),
    ]
    return r(V.retrieval_grade(rows[0].unionByName(rows[1]).unionByName(rows[2])), 5)
