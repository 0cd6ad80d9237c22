"""Exact vector and keyword retrieval, rank fusion and retrieval evaluation.

Scoring is a scan: every task scores its documents against the queries and keeps the best k per
query, so what is shuffled is k rows per query and task, never (query, document) pairs. A query set
of checked size travels with the tasks; a larger one is split into blocks that meet blocks of
documents by an equality key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, DoubleType

from sparkdesk.functions.text import tokens
from sparkdesk.operators.dedup import first_per_key
from sparkdesk.operators.inverted import InvertedLists
from sparkdesk.operators.postings import Postings

QUERY_LIMIT = 2000       # queries that may travel with every task
BLOCK_DOCS = 50_000      # documents per block when the query set is larger
Scorer = Callable[[pd.DataFrame], np.ndarray]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Top k by rounded score, smaller id first; NaN scores are no candidates."""
    keep = ~np.isnan(scores)
    ids, scores = ids[keep], scores[keep]
    if len(ids) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= cut - 1e-6
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -np.round(scores, 6)))[:k]
    return ids[order], scores[order]


def scan_top_k(docs: DataFrame, doc_id: str, queries: DataFrame, query_id: str,
               make_scorer: Callable[[pd.DataFrame], Scorer], k: int, query_limit: int = QUERY_LIMIT,
               block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Best k documents per query: (query_id, doc_id, score, rank).

    ``make_scorer(queries)`` returns a function from a batch of documents to a documents x queries
    score matrix.
    """
    schema = StructType([
        StructField(query_id, queries.schema[query_id].dataType), StructField(doc_id, docs.schema[doc_id].dataType),
        StructField("score", DoubleType()),
    ])

    def scan(query_rows: pd.DataFrame, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, names = make_scorer(query_rows), query_rows[query_id].to_numpy()
        held = [(np.empty(0, dtype=object), np.empty(0)) for _ in names]
        for batch in batches:
            if len(batch) == 0:
                continue
            ids, matrix = batch[doc_id].to_numpy(), scorer(batch)
            for j in range(len(names)):
                old_ids, old_scores = held[j]
                new_ids, new_scores = _best(ids, matrix[:, j], k)
                if len(old_ids):
                    new_ids, new_scores = _best(np.concatenate([old_ids, new_ids]), np.concatenate([old_scores, new_scores]), k)
                held[j] = new_ids, new_scores
        for name, (ids, scores) in zip(names, held):
            if len(ids):
                yield pd.DataFrame({query_id: name, doc_id: ids, "score": scores})

    local = queries.limit(query_limit + 1).toPandas()  # never more than the limit and one
    if len(local) <= query_limit:
        partial = docs.mapInPandas(lambda it: scan(local, it), schema)
    else:
        n_docs, n_queries = docs.count(), queries.count()
        parts, blocks = max(1, -(-n_docs // block_docs)), -(-n_queries // query_limit)
        spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        at = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        left = docs.withColumn("_part", at(doc_id, parts)).withColumn("_block", spread(blocks))
        right = queries.withColumn("_block", at(query_id, blocks)).withColumn("_part", spread(parts))
        right = right.select(*[F.col(c).alias(f"q_{c}") for c in right.columns])

        def meet(d: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            out = list(scan(q.rename(columns=lambda c: c[2:]), iter([d]))) if len(q) else []
            return pd.concat(out) if out else pd.DataFrame({query_id: [], doc_id: [], "score": []})

        partial = left.groupBy("_part", "_block").cogroup(right.groupBy("q__part", "q__block")).applyInPandas(meet, schema)
    w = W.partitionBy(query_id).orderBy(F.round("score", 6).desc(), doc_id)
    return partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# --- vectors ----------------------------------------------------------------------------------------
def _matrix(series: pd.Series) -> np.ndarray:
    m = np.stack(series.to_numpy()).astype(np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, np.nan, norm)


def cosine_top_k(queries: DataFrame, docs: DataFrame, k: int = 5, threshold: float | None = None, query_id: str = "query_id",
                 doc_id: str = "doc_id", vector: str = "embedding", filters: Sequence[str] = (), **limits: int) -> DataFrame:
    """k nearest documents by cosine similarity (V1), with equality filters per query (V2) and a cut-off (V3).

    A filter column exists on both sides; a null on the query side means no filter.
    """
    names = list(filters)

    def make(q: pd.DataFrame) -> Scorer:
        unit = _matrix(q[vector])

        def score(d: pd.DataFrame) -> np.ndarray:
            sims = _matrix(d[vector]) @ unit.T
            for f in names:
                want = q[f].to_numpy()
                free = pd.isna(want)
                sims = np.where(free[None, :] | (d[f].to_numpy()[:, None] == want[None, :]), sims, np.nan)
            return sims

        return score

    usable = docs.where(F.col(vector).isNotNull()).select(doc_id, vector, *names)
    hits = scan_top_k(usable, doc_id, queries.select(query_id, vector, *names), query_id, make, k, **limits)
    hits = hits.withColumnRenamed("score", "similarity")
    return hits if threshold is None else hits.where(F.col("similarity") >= threshold)


def centroids(docs: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per label; one row per (label, position) is brought together, not the vectors."""
    cells = docs.select(label, F.posexplode(vector).alias("_p", "_x"))
    means = cells.groupBy(label, "_p").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    ordered = F.array_sort(F.collect_list(F.struct("_p", "_m")))  # as long as one vector
    return means.groupBy(label).agg(F.transform(ordered, lambda s: s["_m"]).alias(vector))


def approximate_top_k(queries: DataFrame, docs: DataFrame, k: int = 5, query_id: str = "query_id", doc_id: str = "doc_id",
                      vector: str = "embedding", **options) -> DataFrame:
    """k nearest documents over inverted lists, in exact order of cosine similarity (V4); see :class:`InvertedLists`."""
    found = InvertedLists(docs, doc_id, vector).top_k(queries, query_id, vector, k, **options)
    return found.withColumnRenamed("doc", doc_id)


# --- keywords -----------------------------------------------------------------------------------------
def bm25_top_k(queries: DataFrame, docs: DataFrame, k: int = 4, query_id: str = "query_id", doc_id: str = "doc_id", text: str = "text",
               **options) -> DataFrame:
    """BM25 ranking of documents for text queries (V5), exact; see :class:`Postings`, which can be built once and asked often."""
    asked = queries.select(F.explode(tokens(text)).alias("term")).distinct()
    return Postings.build(docs, doc_id, text, terms=asked, **options).top_k(queries, query_id, text, k).withColumnRenamed("doc", doc_id)


def fuse_ranks(lists: Sequence[tuple[DataFrame, float]], query_id: str = "query_id", doc_id: str = "doc_id", c: int = 60) -> DataFrame:
    """Weighted reciprocal rank fusion: sum of w / (c + rank) (V6)."""
    parts = [df.select(query_id, doc_id, (F.lit(w) / (c + F.col("rank"))).alias("part")) for df, w in lists]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    fused = rows.groupBy(query_id, doc_id).agg(F.sum("part").alias("fused"))
    w = W.partitionBy(query_id).orderBy(F.round("fused", 9).desc(), doc_id)
    return fused.withColumn("rank", F.row_number().over(w))


def source_context(hits: DataFrame, source: str, text: str, fallback: DataFrame, query_id: str = "query_id", n: int = 3) -> DataFrame:
    """First n hits of each source joined by a rule line; the raw section where there is none (V7).

    ``fallback`` lists every (query, source) with the raw section.
    """
    w = W.partitionBy(query_id, source).orderBy("rank")
    kept = hits.where(F.trim(text) != "").withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n)
    ordered = F.array_sort(F.collect_list(F.struct("_k", F.trim(text).alias("t"))))  # at most n
    joined = kept.groupBy(query_id, source).agg(F.array_join(F.transform(ordered, lambda s: s["t"]), "\n---\n").alias("found"))
    return fallback.join(joined, [query_id, source], "left").select(
        query_id, source, F.coalesce("found", "section").alias("context"))


def matching_trend_doc(hits: DataFrame, key: str, trend_type: Column) -> DataFrame:
    """First document of the first candidate query whose section is 'trend' or empty and that names the trend.

    ``hits`` holds query_no, rank, chunk_id, section, title, content and keywords per key.
    """
    whole = F.concat_ws(" ", F.trim("title"), F.trim("section"), F.trim("chunk_id"), F.trim("content"), F.array_join("keywords", " "))
    fits = F.coalesce(F.trim("section"), F.lit("")).isin("", "trend") & whole.contains(trend_type)
    return first_per_key(hits.where(fits), [key], [F.col("query_no"), F.col("rank")])


# --- evaluation ---------------------------------------------------------------------------------------
def similarity_bands(hits: DataFrame, by: str, good: float = 0.85, fair: float = 0.70) -> DataFrame:
    """Similarity spread and share of hits in three bands (V8)."""
    s = F.col("similarity")
    share = lambda cond: F.avg(cond.cast("double"))
    return hits.groupBy(by).agg(
        F.count("*").alias("n"), F.avg(s).alias("mean_sim"), F.min(s).alias("min_sim"), F.max(s).alias("max_sim"),
        share(s >= good).alias("good"), share((s >= fair) & (s < good)).alias("fair"), share(s < fair).alias("weak"))


def k_sensitivity(hits: DataFrame, ks: Sequence[int] = (3, 5, 7, 10, 15), query_id: str = "query_id", fair: float = 0.70) -> DataFrame:
    """Mean, minimum, top similarity and weak share per k, from one ranking at the largest k (V9)."""
    rows = hits.select("*", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")).where(F.col("rank") <= F.col("k"))
    return rows.groupBy("k", query_id).agg(
        F.avg("similarity").alias("mean_sim"), F.min("similarity").alias("min_sim"), F.max("similarity").alias("top1_sim"),
        F.avg((F.col("similarity") < fair).cast("double")).alias("weak"))


# Measure -> (good limit, fair limit, larger is better).
GRADES = {"mean_similarity": (0.80, 0.70, True), "good_chunks": (0.7, 0.5, True), "noise_at_5": (0.1, 0.2, False), "keyword_recall": (0.6, 0.4, True)}


def retrieval_grade(measures: DataFrame) -> DataFrame:
    """Grade of each overall measure: good, fair or poor (V11). ``measures`` has measure and value."""
    good, fair = F.lit(False), F.lit(False)
    for name, (g, f, up) in GRADES.items():
        hit = F.col("measure") == name
        good = good | (hit & ((F.col("value") >= g) if up else (F.col("value") <= g)))
        fair = fair | (hit & ((F.col("value") >= f) if up else (F.col("value") <= f)))
    return measures.withColumn("grade", F.when(good, "good").when(fair, "fair").otherwise("poor"))
