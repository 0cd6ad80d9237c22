"""Toxicity with a factorization machine over hashed terms.

A text's score is a bias, a weight per distinct term, and for each pair of terms the product of two short vectors, so that
a pair can weigh more than its parts. Terms are runs of letters in lower case, hashed into ``BUCKETS``. The model is fitted
on a bounded sample of labelled rows (``SAMPLE_ROWS`` of each class, by hash of the id, equal texts once); of the terms
in it those are kept that differ most between the classes (``TERMS``). Scoring is a map over all rows.

Rows: a null or empty text has no term and gets the score of the bias. Rows without a label, or labelled null, are not
learned from; labels that contradict each other are all learned from. Without rows of both classes every score is the
share of the class there is (0.5 without any). An empty table gives an empty result. Other columns travel along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.llm.textbytes import letter_words, slices
from sparkdesk.session import materialize

BUCKETS = 1 << 20
SAMPLE_ROWS = 20_000
TERMS = 10_000
LEAST_ROWS = 5
FACTORS = 6
EPOCHS = 12


def _terms(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    words, first = letter_words(column)
    return (words % np.uint64(buckets)).astype(np.int64), first


class Machine:
    """``bias + sum w + sum over pairs <v, v>`` over the distinct known terms, through the logistic function."""

    def __init__(self, terms: np.ndarray, factors: int, rate: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.terms = terms
        self.bias = float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6)))
        self.weights = np.zeros(len(terms))
        self.vectors = rng.normal(0, 0.02, (len(terms), factors))

    def margins(self, row: np.ndarray, term: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """The margin of each row and its sum of vectors, from (row, term) pairs."""
        sums = np.stack([np.bincount(row, v, rows) for v in self.vectors[term].T], axis=1)
        squares = np.bincount(row, (self.vectors[term] ** 2).sum(axis=1), rows)
        return self.bias + np.bincount(row, self.weights[term], rows) + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def fit(self, lists: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, step: float = 0.15, shrink: float = 2e-3, batch: int = 256, seed: int = 5) -> None:
        """Logistic loss by AdaGrad over seeded batches; ``weights`` restores the shares of the classes."""
        rng = np.random.default_rng(seed)
        seen_w, seen_v, seen_b = np.full(len(self.terms), 1e-2), np.full(self.vectors.shape, 1e-2), 1e-2
        for _ in range(epochs):
            order = rng.permutation(len(lists))
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                term = np.concatenate([lists[i] for i in part])
                row = np.repeat(np.arange(len(part)), [len(lists[i]) for i in part])
                margin, sums = self.margins(row, term, len(part))
                error = (1 / (1 + np.exp(-margin)) - labels[part]) * weights[part]
                used, place = np.unique(term, return_inverse=True)
                slope = np.bincount(place, error[row], len(used)) + shrink * len(part) * self.weights[used]
                cross = error[row, None] * (sums[row] - self.vectors[term])
                bend = np.stack([np.bincount(place, c, len(used)) for c in cross.T], axis=1) + shrink * len(part) * self.vectors[used]
                seen_w[used] += slope**2
                seen_v[used] += bend**2
                seen_b += error.sum() ** 2
                self.weights[used] -= step * slope / np.sqrt(seen_w[used])
                self.vectors[used] -= 0.5 * step * bend / np.sqrt(seen_v[used])
                self.bias -= step * error.sum() / np.sqrt(seen_b)

    def scores(self, column: pa.Array, buckets: int) -> np.ndarray:
        term, first = _terms(column, buckets)
        rows = len(first) - 1
        row = np.repeat(np.arange(rows), np.diff(first))
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
            known = self.terms[at] == term
            pairs = np.unique(row[known] * len(self.terms) + at[known])  # a term counts once in a text
            row, term = np.divmod(pairs, len(self.terms))
        else:
            row = term = np.empty(0, np.int64)
        return 1 / (1 + np.exp(-self.margins(row, term, rows)[0]))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, terms: int = TERMS, buckets: int = BUCKETS) -> Machine:
    """A machine fitted on labelled documents: ``labels`` (doc_id, toxic), at most ``sample_rows`` of each class."""
    labels = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").alias("y"))
    totals = {r["y"]: r["count"] for r in labels.groupBy("y").count().collect()}
    order = F.xxhash64("doc_id", F.lit(3))
    parts = [labels.where(F.col("y") == y).orderBy(order, "doc_id").limit(sample_rows) for y in (0, 1)]

    def distinct(batches):
        for batch in slices(batches):
            term, first = _terms(batch.column("text"), buckets)
            lists = [np.unique(term[a:b]).astype(np.int32) for a, b in zip(first[:-1], first[1:], strict=True)]
            at = np.cumsum([0, *map(len, lists)])
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("h"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(lists)))], ["y", "h", "terms"])

    sample = F.broadcast(parts[0].union(parts[1]))  # at most twice sample_rows small rows
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("y", F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.mapInArrow(distinct, "y int, h long, terms array<int>").dropDuplicates(["y", "h"])
    rows = materialize(rows, "toxic-sample")

    drawn = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n0, n1 = drawn.get(0, 0), drawn.get(1, 0)
    rate = totals.get(1, 0) / max(1, sum(totals.values())) if totals else 0.5
    if not n0 or not n1:
        return Machine(np.empty(0, np.int64), 1, rate)
    counted = rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("ones"), F.count("*").alias("n"))
    gap = F.abs(F.col("ones") / n1 - (F.col("n") - F.col("ones")) / n0)  # against what chance would give
    spread = F.sqrt(F.col("n") / (n0 + n1) * (1.0 / n0 + 1.0 / n1))
    best = counted.where(F.col("n") >= LEAST_ROWS).orderBy(F.desc(gap / spread), "term").limit(terms)
    known = np.sort(np.array([r["term"] for r in best.collect()], np.int64))

    def restricted(batches):
        for batch in batches:
            lists = [known.searchsorted(t[np.isin(t, known)]).astype(np.int32) for t in (np.asarray(x.values) for x in batch.column("terms"))]
            at = np.cumsum([0, *map(len, lists)])
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([*lists, np.empty(0, np.int32)]))), batch.column("h")], ["y", "known", "h"])

    got = rows.mapInArrow(restricted, "y int, known array<int>, h long").toPandas().sort_values("h")  # the bounded sample, known terms only
    labels_ = got["y"].to_numpy(float)
    weights = np.where(labels_ > 0, rate / (n1 / (n0 + n1)), (1 - rate) / (n0 / (n0 + n1)))
    machine = Machine(known, FACTORS, rate)
    machine.fit([np.asarray(x, np.int64) for x in got["known"]], labels_, weights)
    return machine


def scored(docs: DataFrame, machine: Machine, buckets: int = BUCKETS, column: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with ``column`` (0 to 1), which replaces one of that name.

    Only texts go to the Python workers and only numbers come back; the other columns stay with Spark.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)  # some hundred kB: TERMS rows of weights

    @F.arrow_udf(T.DoubleType())
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            parts = slices([pa.RecordBatch.from_arrays([text], ["text"])])
            yield pa.array(np.concatenate([np.empty(0), *(model.value.scores(part.column(0), buckets) for part in parts)]))

    return docs.drop(column).withColumn(column, score("text"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents scored under ``threshold``; all columns and rows."""
    column = "score"
    while column in docs.columns:
        column += "_"
    return scored(docs, fit(docs, labels), column=column).where(F.col(column) < threshold).drop(column)
