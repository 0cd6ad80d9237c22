"""Running totals over sorted ranges: sparse places, one key over many tasks, key types, nulls."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators.ordered import SUM, XOR, carry_forward, number_rows, running, sorted_ranges

GAP = 1_000_000


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    hot = [("hot", i * GAP - 7, "H" + str(i) if rng.random() < 0.01 else None, rng.randrange(1 << 40)) for i in range(4000)]
    return hot + [("b", i, None, i) for i in range(3)] + [(None, 5, "n", 1), (None, -5, None, 2)] + [(f"k{i}", 0, "x", 3) for i in range(50)]


@pytest.fixture
def frame(spark, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.createDataFrame(rows, "k string, i long, h string, v long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def by_key(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return {k: sorted(v, key=lambda r: r[1]) for k, v in out.items()}


def test_a_key_stretches_over_tasks(frame):
    parts = sorted_ranges(frame, ["k"], ["i"]).where("k = 'hot'").select("_range").distinct().count()
    assert parts >= 6


def test_numbers_and_carries(frame, rows):
    got = {(r.k, r.i): r.s for r in carry_forward(frame, ["k"], "i", F.col("h"), "General", "s").collect()}
    seq = {(r.k, r.i): r.n for r in number_rows(frame, ["k"], "i", "n").collect()}
    assert len(got) == len(seq) == len(rows)
    for k, mine in by_key(rows).items():
        last = "General"
        for n, (_, i, h, _) in enumerate(mine, 1):
            last = h or last
            assert got[k, i] == last and seq[k, i] == n


def test_totals_before_each_row(frame, rows):
    out = running(frame, ["k"], ["i"], {"s": (SUM, F.col("v")), "x": (XOR, F.col("v"))}, keep=["k", "i", "v"], before=True)
    assert out.columns == ["k", "i", "v", "s", "x"]
    got = {(r.k, r.i): (r.s, r.x) for r in out.collect()}
    for k, mine in by_key(rows).items():
        s = x = 0
        for _, i, _, v in mine:
            assert got[k, i] == (s, x)
            s, x = s + v, x ^ v


def test_orders_of_any_type_and_empty_tables(spark):
    df = spark.createDataFrame([("a", "2024-03-01", 1), ("a", "2023-01-05", 2), ("a", None, 3)], "k string, d string, v long").withColumn("d", F.to_date("d"))
    assert sorted((r.v, r.n) for r in number_rows(df, ["k"], "d", "n").collect()) == [(1, 3), (2, 2), (3, 1)]
    assert number_rows(df.limit(0), ["k"], "d", "n").collect() == []
