"""Postings with skipped blocks, inverted lists, the table function, period bitmaps."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import reshape as R
from sparkdesk.operators import retrieval as V
from sparkdesk.operators import table_functions as N
from sparkdesk.operators.inverted import InvertedLists, recall
from sparkdesk.operators.postings import Postings


def bm25(docs, queries, k, k1=1.5, b=0.75, epsilon=0.25):
    words = {i: t.split() for i, t in docs if t is not None}
    n, avg = len(words), sum(map(len, words.values())) / len(words)
    df = Counter(w for ws in words.values() for w in set(ws))
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: v if v >= 0 else epsilon * mean for w, v in idf.items()}
    out = {}
    for q, text in queries:
        scores = defaultdict(float)
        for i, ws in words.items():
            tf = Counter(ws)
            for w in text.split():
                if w in tf:
                    scores[i] += idf[w] * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(ws) / avg))
        out[q] = sorted(((round(-s, 6), i) for i, s in scores.items()))[:k]
    return out


def test_skipping_blocks_keeps_the_best_exact(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(vocab[min(79, int(rng.exponential(12)))] for _ in range(int(rng.integers(1, 60))))) for i in range(500)] + [(900, None), (901, ""), (902, "only here")]
    queries = [(q, " ".join(rng.choice(vocab, 5))) for q in range(30)] + [(77, "only w1 w1"), (78, "nowhere")]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "query_id long, text string")
    want = {k: v for k, v in bm25(docs, queries, 7).items() if v}
    stored = Postings.build(d, "doc_id", "text", block_docs=8)
    for df in (V.bm25_top_k(q, d, 7, block_docs=8), stored.top_k(q, "query_id", "text", 7).withColumnRenamed("doc", "doc_id")):
        got = defaultdict(list)
        for r in df.orderBy("query_id", "rank").collect():
            got[r.query_id].append((round(-r.score, 6), r.doc_id))
        assert {k: [i for _, i in v] for k, v in got.items()} == {k: [i for _, i in v] for k, v in want.items()}


def test_inverted_lists_find_nine_tenths_and_never_fewer(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 24)) * 3
    rows = [(i, (centres[i % 20] + rng.standard_normal(24)).tolist()) for i in range(3000)] + [(5000, None), (5001, [0.0] * 24)]
    docs = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    queries = docs.where("doc_id % 60 = 0").select(F.col("doc_id").alias("query_id"), "embedding")
    exact = V.cosine_top_k(queries, docs, 10)
    index = InvertedLists(docs, "doc_id", "embedding")
    found = index.top_k(queries, "query_id", "embedding", 10).withColumnRenamed("doc", "doc_id")
    share = recall(found, exact, ["query_id", "doc_id"]).first()
    assert share.recall >= 0.9
    few = index.top_k(queries, "query_id", "embedding", 10, probes=1, keep=10).groupBy("query_id").count()
    assert {r["count"] for r in few.collect()} == {10}
    assert index.lists.count() == 3000
    tiny = InvertedLists(docs.limit(3), "doc_id", "embedding").top_k(queries.limit(2), "query_id", "embedding", 10)
    assert tiny.count() == 6
    assert InvertedLists(docs.limit(0), "doc_id", "embedding").top_k(queries, "query_id", "embedding", 3).count() == 0


def test_inverted_lists_find_nine_tenths_of_random_vectors(spark):
    """Neighbours of vectors without any structure lie in most lists; so many are read that they are found all the same."""
    rng = np.random.default_rng(8)
    docs = spark.createDataFrame([(i, rng.standard_normal(32).tolist()) for i in range(4000)], "doc_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, rng.standard_normal(32).tolist()) for i in range(40)], "query_id long, embedding array<double>")
    exact = V.cosine_top_k(queries, docs, 5)
    found = InvertedLists(docs, "doc_id", "embedding").top_k(queries, "query_id", "embedding", 5).withColumnRenamed("doc", "doc_id")
    assert recall(found, exact, ["query_id", "doc_id"]).first().recall >= 0.9


def test_table_function_from_sql(spark):
    rng = np.random.default_rng(6)
    docs = spark.createDataFrame([(i, i % 3, rng.standard_normal(4).tolist()) for i in range(5000)] + [(9000, 1, None), (9001, 1, [0.0] * 4)], "doc_id long, label long, embedding array<double>")
    asked = docs.where("doc_id % 700 = 0").select(F.col("doc_id").alias("query_id"), F.when(F.col("doc_id") % 1400 == 0, F.col("label")).alias("label"), "embedding")
    N.register(spark)
    got = spark.sql("""SELECT query_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 6) DESC, doc_id) AS rank
      FROM nearest_vectors(4, TABLE({input}) PARTITION BY part ORDER BY is_doc)) WHERE rank <= 4""", input=N.as_input(asked, docs, 2))
    want = V.cosine_top_k(asked, docs, 4, filters=["label"])
    rows = lambda df: sorted((r.query_id, r.doc_id) for r in df.collect())
    assert rows(got) == rows(want) and len(rows(got)) == 32


@pytest.mark.parametrize("periods", [1, 5, 63, 64, 200])
def test_gaps_of_entities(spark, periods):
    rng = np.random.default_rng(periods)
    held = {(e, p) for e in "abcdef" for p in range(periods) if e == "a" or rng.random() < 0.7}
    df = spark.createDataFrame([(e, f"p{p:03d}") for e, p in held for _ in range(2)] + [(None, "p000"), ("a", None)], "e string, p string")
    got = {(r.e, r.p) for r in R.missing_combinations(df, "e", "p").collect()}
    seen = {e for e, _ in held}
    assert got == {(e, f"p{p:03d}") for e in seen for p in range(periods)} - {(e, f"p{p:03d}") for e, p in held}
