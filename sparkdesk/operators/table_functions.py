"""Vector search as a table function, so that it can be called from SQL (V1, V2).

    SELECT * FROM nearest_vectors(5, TABLE(input) PARTITION BY part ORDER BY is_doc)

``input`` holds queries (is_doc = 0, in every part) and documents (is_doc = 1, dealt over the parts) as
(part, is_doc, id, embedding, label). A part first meets its queries, then streams its documents past them a buffer at a
time and returns the best k of each query; the caller ranks the parts' answers. A query with a label meets documents of
that label only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

BUFFER = 2048


@udtf(returnType="query_id bigint, doc_id bigint, similarity double")
class NearestVectors:
    def __init__(self):
        self.queries, self.docs, self.k = [], [], 0
        self.best = None

    def eval(self, k, row):
        self.k = k
        if row["embedding"] is not None:
            (self.docs if row["is_doc"] else self.queries).append((row["id"], row["embedding"], row["label"]))
        if len(self.docs) >= BUFFER:
            self._score()

    def _score(self):
        if self.best is None:
            self.best = [[] for _ in self.queries]
        if self.queries and self.docs:
            similar = self._unit(self.docs) @ self._unit(self.queries).T
            ids, labels = np.array([d[0] for d in self.docs]), np.array([d[2] for d in self.docs], dtype=object)
            for j, (_, _, label) in enumerate(self.queries):
                at = np.flatnonzero(~np.isnan(similar[:, j]) & (np.ones(len(ids), bool) if label is None else labels == label))
                found = self._few(similar[at, j], ids[at])
                self.best[j] = sorted([*self.best[j], *found])[: self.k]
        self.docs = []

    def _few(self, scores, ids):
        order = np.lexsort((ids, -np.round(scores, 6)))[: self.k]
        return [(-round(float(scores[i]), 6), int(ids[i]), float(scores[i])) for i in order]

    @staticmethod
    def _unit(rows):
        m = np.array([r[1] for r in rows], dtype=float)
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norm == 0, np.nan, norm)

    def terminate(self):
        self._score()
        for (query, _, _), found in zip(self.queries, self.best, strict=True):
            for _, doc, score in found:
                yield query, doc, score


def register(spark: SparkSession) -> None:
    spark.udtf.register("nearest_vectors", NearestVectors)


def as_input(queries: DataFrame, docs: DataFrame, parts: int) -> DataFrame:
    """Queries (query_id, embedding, label) and documents (doc_id, embedding, label) as the function's input."""
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    vector = F.col("embedding").cast("array<double>").alias("embedding")
    asked = queries.select(part, F.lit(0).alias("is_doc"), F.col("query_id").cast("bigint").alias("id"), vector, F.col("label").cast("bigint").alias("label"))
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part")
    return asked.unionByName(docs.select(dealt, F.lit(1).alias("is_doc"), F.col("doc_id").cast("bigint").alias("id"), vector, F.col("label").cast("bigint").alias("label")))
