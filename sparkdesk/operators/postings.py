"""BM25 over a stored postings table (V5).

A posting is (term, document, weight); the weight holds everything that doesn't depend on a query, so a score is a sum of
products. Documents are dealt into blocks, and the largest weight of each term in a block bounds what any of its
documents can reach. A query first scores the blocks that promise most, which gives it a score to beat, and then only the
blocks whose bound reaches that score. Blocks are skipped, documents of a block never, so the best k are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.functions.text import tokens
from sparkdesk.session import materialize

BLOCK_DOCS = 16
FIRST_BLOCKS = 4  # of a query, scored before any bound is drawn


@dataclass(frozen=True)
class Postings:
    """postings (term, block, doc, weight), tops (term, block, top) and idf (term, idf) of all words."""

    postings: DataFrame
    tops: DataFrame
    idf: DataFrame

    @classmethod
    def build(cls, docs: DataFrame, doc_id: str, text: str, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25, block_docs: int = BLOCK_DOCS,
              terms: DataFrame | None = None) -> Postings:
        """Postings of all words, or of ``terms`` (term) only, which gives the same scores to queries made of them.

        Words more frequent than in half of the documents get ``epsilon`` times the mean idf. Null texts have no postings.

        Blocks are of like length: documents near in length share one, which keeps the bounds of short ones low.
        """
        words = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc"), tokens(text).alias("words"))
        words = materialize(words.withColumn("dl", F.size("words")), "doc-words")
        size = words.agg(F.struct(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).alias("s")).scalar()
        frequent = words.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        raw = frequent.select("term", (F.log(size["n"] - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("idf"))
        raw = materialize(raw, "idf")
        mean = raw.agg(F.avg("idf")).scalar()
        idf = raw.select("term", F.when(F.col("idf") < 0, epsilon * mean).otherwise(F.col("idf")).alias("idf"))
        length_class = F.floor(F.log2(F.col("dl") + 1) * 2)
        many = words.groupBy(length_class.alias("c")).agg(F.ceil(F.count("*") / block_docs).alias("blocks"))  # one row per class of lengths
        weight = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / size["avgdl"]))
        each = words.select("doc", "dl", F.explode("words").alias("term"))
        each = each if terms is None else each.join(terms, "term", "left_semi")
        placed = each.groupBy("doc", "dl", "term").agg(F.count("*").alias("tf")).withColumn("c", length_class).join(F.broadcast(many), "c")
        block = F.struct("c", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("i")).alias("block")
        postings = materialize(placed.select("term", block, "doc", weight.alias("weight")), "postings")
        return cls(postings, postings.groupBy("term", "block").agg(F.max("weight").alias("top")), idf)

    def top_k(self, queries: DataFrame, query_id: str, text: str, k: int) -> DataFrame:
        """(query_id, doc, score, rank) of the k best documents that share a word with the query; ties go to the smaller document."""
        asked = queries.select(query_id, F.explode(tokens(text)).alias("term")).groupBy(query_id, "term").agg(F.count("*").alias("qtf"))
        asked = materialize(asked.join(self.idf, "term").select(query_id, "term", (F.col("qtf") * F.col("idf")).alias("w")), "query-terms")
        # a weight below zero (a mean idf may be) can only lower a score
        bounds = materialize(asked.join(self.tops, "term").groupBy(query_id, "block").agg(F.sum(F.greatest(F.col("w"), F.lit(0.0)) * F.col("top")).alias("bound")), "query-bounds")
        first = bounds.withColumn("_r", F.row_number().over(W.partitionBy(query_id).orderBy(F.desc("bound"), "block"))).where(F.col("_r") <= FIRST_BLOCKS)
        best = materialize(self._scored(asked, first.select(query_id, "block"), query_id, k), "query-first")
        to_beat = best.where(F.col("rank") == k).select(query_id, F.col("score").alias("_beat"))
        rest = bounds.join(to_beat, query_id, "left").where(F.col("_beat").isNull() | (F.col("bound") >= F.col("_beat") - 1e-6))
        rest = rest.select(query_id, "block").join(first.select(query_id, "block"), [query_id, "block"], "left_anti")
        return self._ranked(best.drop("rank").unionByName(self._scored(asked, rest, query_id, k).drop("rank")), query_id, k)

    def _scored(self, asked: DataFrame, pairs: DataFrame, query_id: str, k: int) -> DataFrame:
        hits = pairs.join(asked, query_id).join(self.postings, ["term", "block"])
        scores = hits.groupBy(query_id, "doc").agg(F.sum(F.col("w") * F.col("weight")).alias("score"))
        return self._ranked(scores, query_id, k)

    def _ranked(self, scores: DataFrame, query_id: str, k: int) -> DataFrame:
        w = W.partitionBy(query_id).orderBy(F.round("score", 6).desc(), "doc")
        return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
