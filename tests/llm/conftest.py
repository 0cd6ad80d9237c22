import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

EDGES = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(texts, start=0):
    return [(start + i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def frame(spark):
    """Makes a documents table of texts; ids count from 0."""

    def make(texts, extra=()):
        return spark.createDataFrame([*rows_of(texts), *extra], EDGES)

    return make


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
