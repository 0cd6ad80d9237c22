import numpy as np
from pyspark.sql import functions as F

from sparkdesk.llm import queries, toxicity


def area(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op4_toxicity(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert area(rows["score"].to_numpy(), rows["toxic"].to_numpy()) > 0.75
    assert rows["score"].between(0, 1).all() and ((rows["score"] >= 0.5) == (rows["predicted"] == 1)).all()


def test_pairs_beat_single_terms():
    """A class that only pairs of terms decide: a machine without vectors can't learn it."""
    rng = np.random.default_rng(0)
    lists, labels = [], []
    for _ in range(4000):
        a, b = rng.integers(0, 2, 2)
        lists.append(np.array(sorted({*([0] if a else [2]), *([1] if b else [3]), 4 + rng.integers(0, 4)})))
        labels.append(float(a == b))
    machine = toxicity.Machine(np.arange(8), 4, 0.5)
    machine.fit(lists, np.array(labels), np.ones(4000), epochs=20)
    term, row = np.concatenate(lists), np.repeat(np.arange(4000), [len(x) for x in lists])
    assert (((machine.margins(row, term, 4000)[0] > 0) == np.array(labels)).mean()) > 0.97


def test_margin_is_the_sum_over_pairs():
    machine = toxicity.Machine(np.arange(6), 3, 0.3)
    machine.weights = np.arange(6) / 10
    terms = [0, 2, 5]
    want = machine.bias + sum(machine.weights[t] for t in terms) + sum(machine.vectors[a] @ machine.vectors[b] for a in terms for b in terms if a < b)
    assert abs(machine.margins(np.zeros(3, int), np.array(terms), 1)[0][0] - want) < 1e-9


def test_edge_rows(spark, frame):
    labels = "doc_id long, toxic int"
    texts = ["you awful fool"] * 1 + [f"kind words {i}" for i in range(20)] + [f"awful fool number {i} xx" for i in range(20)]
    df = frame([*texts, None, ""], [(None, "awful fool", None, None, None), (1, "kind words 0", None, None, None)]).selectExpr("*", "1 as y", "2 as score", "3 as h")
    marks = spark.createDataFrame([(i, 0) for i in range(1, 21)] + [(i, 1) for i in range(21, 41)] + [(None, 1), (2, None)], labels)
    machine = toxicity.fit(df, marks)
    got = toxicity.scored(df, machine)
    assert got.count() == df.count() and got.columns == [*[c for c in df.columns if c != "score"], "score"]
    scores = {r["text"]: r["score"] for r in got.collect()}
    assert scores["awful fool"] > 0.5 > scores["kind words 0"] and scores[None] == scores[""]
    kept = toxicity.without_toxic(df, marks)
    assert kept.columns == df.columns and kept.where(F.col("text") == "awful fool").count() == 0 and kept.where(F.col("text") == "kind words 0").count() == 2
    none = toxicity.fit(df, marks.limit(0))
    assert {round(r["score"], 6) for r in toxicity.scored(df, none).collect()} == {0.5}
    assert toxicity.scored(frame([]), machine).collect() == []
