"""A training corpus from raw documents: five operators one after another, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkdesk.llm import decontaminate, jaccard, pieces, pseudonyms, toxicity
from sparkdesk.llm.common import fold, table
from sparkdesk.llm.queries import PSEUDONYM_KEY, TOKENIZER
from sparkdesk.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under one half by the factorization machine; the held-out fold of the labels isn't learned from."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.without_toxic(docs, labels.where(fold(labels["doc_id"], 5) != 0))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of smallest id."""
    return jaccard.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms; n_chars follows the text."""
    return pseudonyms.pseudonymised(docs, PSEUDONYM_KEY).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document (as little-endian unsigned 32-bit numbers), their number, and the text they decode to."""
    return pieces.encoded(docs.select("doc_id", "lang", "source", "text"), TOKENIZER).select("doc_id", "lang", "source", "n_tokens", "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("pseudonyms", hide_private),
    ("encoding", encode),
]

ORACLE_SQL = None  # a fitted model and an encoder can't be said in SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
