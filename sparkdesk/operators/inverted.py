"""Approximate vector search over inverted lists with product-quantised residuals and exact re-ranking (V4).

Coarse centroids and codebooks are fitted on a bounded sample (``SAMPLE``); every vector is indexed: its list is its
nearest centroid, its code the nearest codeword of each stretch of the residual. A query looks into the lists nearest to
it, estimates distances from codes alone, and ranks the best of them by their exact similarity. Lists are read until
they hold enough vectors, so a query never gets fewer than k while there are k.

How many lists and candidates that takes depends on the vectors: near-random ones have their neighbours in many lists.
Unless the caller names the numbers, some indexed vectors are asked for their neighbours, and both numbers are doubled
until ``AIM`` of what brute force over all vectors finds is found. At all lists and all rows the search is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.operators.kmeans import started
from sparkdesk.operators.quantiles import seeded_order
from sparkdesk.session import materialize

SAMPLE = 20_000
PARTS = 8  # stretches of a vector with a codebook each
CODES = 64  # codewords per stretch
PROBES, KEEP = 8, 100  # lists and candidates of a query to begin with
ASKED = 200  # indexed vectors that the numbers are measured on
AIM = 0.98  # a larger share than the nine tenths asked for, as other queries fare a little worse


def lloyd(points: np.ndarray, k: int, seed: int, rounds: int = 15) -> np.ndarray:
    """Centres of a sample that fits one machine."""
    centres = started(points, k, seed)
    for _ in range(rounds):
        at = nearest(points, centres)
        centres = np.array([points[at == c].mean(axis=0) if (at == c).any() else centres[c] for c in range(len(centres))])
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None, :] - 2 * points @ centres.T).argmin(axis=1)


def unit_rows(column: pa.Array) -> np.ndarray:
    m = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


class InvertedLists:
    """``lists`` holds (list, doc, code, embedding) of every usable vector, stored by list."""

    def __init__(self, docs: DataFrame, doc_id: str, vector: str, lists: int | None = None, seed: int = 42):
        v = F.col(vector)
        usable = docs.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)).select(F.col(doc_id).alias("doc"), v.alias("v"))
        rows = usable.count()
        share = min(1.0, 1.2 * SAMPLE / max(rows, 1))
        picked = usable.where(seeded_order(F.col("doc"), seed) < F.lit(int(share * 2**52))).orderBy(seeded_order(F.col("doc"), seed)).limit(SAMPLE).select("v").toArrow()
        sample = unit_rows(picked["v"].combine_chunks()) if len(picked) else np.empty((0, 1))
        self.rows, self.seed, self.efforts = rows, seed, {}
        self.centres = lloyd(sample, lists or max(1, min(1024, int(rows**0.5) // 2)), seed) if len(sample) else sample
        left = sample - self.centres[nearest(sample, self.centres)] if len(sample) else sample
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(PARTS, sample.shape[1]))
        self.books = [lloyd(left[:, c], CODES, seed + i) for i, c in enumerate(self.cuts)] if len(sample) else []
        centres, cuts, books = self.centres, self.cuts, self.books

        def index(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = unit_rows(batch.column("v"))
                at = nearest(x, centres)
                rest = x - centres[at]
                code = np.column_stack([nearest(rest[:, c], b) for c, b in zip(cuts, books, strict=True)]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(at, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary()), batch.column("v")], ["doc", "list", "code", "v"])

        types = dict(usable.dtypes)
        self.doc_type = types["doc"]
        self.lists = materialize(usable.mapInArrow(index, f"doc {types['doc']}, list int, code binary, v {types['v']}").repartition("list").sortWithinPartitions("list"), "inverted-lists")

    def effort(self, k: int) -> tuple[int, int]:
        """(probes, keep) that find ``AIM`` of the k nearest others of ``ASKED`` indexed vectors, measured against brute force."""
        from sparkdesk.operators.retrieval import cosine_top_k

        probes, keep = PROBES, max(KEEP, k)
        if k in self.efforts or (probes >= len(self.centres) and keep >= self.rows):
            return self.efforts.get(k, (probes, keep))
        vectors = self.lists.select(F.col("doc").alias("query_id"), F.col("v").alias("q"))
        asked = materialize(vectors.orderBy(seeded_order(F.col("query_id"), self.seed + 1)).limit(ASKED), "inverted-asked")
        others = F.col("doc") != F.col("query_id")
        exact = materialize(cosine_top_k(asked.withColumnRenamed("q", "v"), self.lists.select("doc", "v"), k + 1, doc_id="doc", vector="v").where(others), "inverted-exact")
        while probes < len(self.centres) or keep < self.rows:
            found = self.top_k(asked, "query_id", "q", k + 1, probes, keep).where(others)
            if recall(found, exact, ["query_id", "doc"]).first()["recall"] >= AIM:
                break
            probes, keep = 2 * probes, 2 * keep
        self.efforts[k] = probes, keep
        return probes, keep

    def top_k(self, queries: DataFrame, query_id: str, vector: str, k: int, probes: int | None = None, keep: int | None = None) -> DataFrame:
        """(query_id, doc, similarity, rank): exact cosine order of the ``keep`` best candidates by code of each query.

        Numbers that aren't given are those of :meth:`effort`.
        """
        if probes is None or keep is None:
            measured = self.effort(k)
            probes, keep = probes or measured[0], keep or measured[1]
        centres, cuts, books = self.centres, self.cuts, self.books
        sizes = {r["list"]: r["count"] for r in self.lists.groupBy("list").count().collect()}  # as many rows as centroids
        qtype = dict(queries.dtypes)[query_id]

        def probe(batches):
            for batch in batches:
                if not batch.num_rows or not len(centres):
                    continue
                x = unit_rows(batch.column(vector))
                order = (-(x @ centres.T) + (centres * centres).sum(axis=1) / 2).argsort(axis=1)
                who, where = [], []
                for i, row in enumerate(order):
                    held = 0
                    for n, c in enumerate(row.tolist()):  # on past the asked number while too few vectors were met
                        if n >= probes and held >= max(keep, k):
                            break
                        held += sizes.get(c, 0)
                        who.append(i)
                        where.append(c)
                yield pa.RecordBatch.from_arrays([batch.column(query_id).take(pa.array(who)), pa.array(where, pa.int32()), batch.column(vector).take(pa.array(who))], [query_id, "list", "q"])

        known = queries.where(F.col(vector).isNotNull() & F.exists(vector, lambda x: x != 0)).select(query_id, F.col(vector))
        asked = known.mapInArrow(probe, f"{query_id} {qtype}, list int, q {dict(known.dtypes)[vector]}")

        def estimate(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                q = unit_rows(batch.column("q"))
                at = batch.column("list").to_numpy()
                code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                near = (q * centres[at]).sum(axis=1)
                for i, (c, b) in enumerate(zip(cuts, books, strict=True)):
                    near += (q[:, c] * b[code[:, i]]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(query_id), batch.column("doc"), pa.array(near)], [query_id, "doc", "near"])

        met = asked.join(self.lists.select("list", "doc", "code"), "list").select(query_id, "q", "list", "doc", "code")
        near = met.mapInArrow(estimate, f"{query_id} {qtype}, doc {self.doc_type}, near double")
        best = near.withColumn("_r", F.row_number().over(W.partitionBy(query_id).orderBy(F.desc("near"), "doc"))).where(F.col("_r") <= keep).select(query_id, "doc")
        exact = best.join(self.lists.select("doc", "v"), "doc").join(known.select(query_id, F.col(vector).alias("q")), query_id)
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
        scored = exact.select(query_id, "doc", (dot("q", "v") / F.sqrt(dot("q", "q") * dot("v", "v"))).alias("similarity"))
        w = W.partitionBy(query_id).orderBy(F.round("similarity", 6).desc(), "doc")
        return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame, on: Sequence[str]) -> DataFrame:
    """(wanted, met, recall): the share of exact hits that were found, in one row."""
    hit = exact.select(*on).join(found.select(*on).withColumn("_met", F.lit(1)), list(on), "left")
    return hit.agg(F.count("*").alias("wanted"), F.count("_met").alias("met"), (F.count("_met") / F.count("*")).alias("recall"))
