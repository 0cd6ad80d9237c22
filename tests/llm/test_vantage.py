import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdesk.llm import queries, vantage

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, asked, k):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, x in rows:
        if asked(q):
            near = sorted((-float((v * x).sum()), i) for i, v in rows if i != q and len(v) == len(x))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def same(got, want):
    assert set(got) == {q for q, near in want.items() if near}
    for q, near in got.items():
        assert [i for i, _ in near] == [i for i, _ in want[q]]
        assert [s for _, s in near] == pytest.approx([s for _, s in want[q]], rel=1e-12, abs=1e-12)


@pytest.fixture(scope="module")
def rows():
    """Clusters of very different lengths, one vector held by a third of the rows, whole numbers that tie."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((6, 8)) * [[0.1], [1], [1], [3], [10], [0.5]]
    rows = [(i, (centres[i % 6] + rng.standard_normal(8) * 0.3).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, -1.0]) for i in range(300)]
    return rows + [(2000 + i, [float(c) for c in rng.integers(-1, 2, 8)] + []) for i in range(200)]


@pytest.mark.parametrize("factor_one", [True, False])
def test_exact_and_relaxed(spark, monkeypatch, rows, factor_one):
    monkeypatch.setattr(vantage, "SHARD_ROWS", 90)
    monkeypatch.setattr(vantage, "QUERY_BLOCK", 7)
    monkeypatch.setattr(vantage, "LEAF_ROWS", 8)
    rows = [(i, v) for i, v in rows if any(v)]
    index = vantage.Index(spark.createDataFrame(rows, VECTORS).repartition(3), "vec_id", "embedding")
    assert len(index.parts) > 4 and max(index.parts.values()) > 1
    want = brute(rows, lambda i: i % 5 == 0, 6)
    if factor_one:
        same(found(index.nearest(F.col("id") % 5 == 0, 6, 1.0)), want)
    else:
        got = found(index.nearest(F.col("id") % 5 == 0, 6))  # the factor that the sample allows
        assert np.mean([sum(a >= b - 1e-9 for (_, a), (_, b) in zip(got[q], want[q])) / 6 for q in want]) > 0.8


def test_tree_prunes(monkeypatch, rows):
    ids, points = np.array([i for i, _ in rows[:400]]), np.array([v for _, v in rows[:400]], float)
    most = float(np.sqrt((points**2).sum(axis=1)).max())
    tree = vantage.Tree.build(ids, points, most, 8)
    assert sorted(tree.ids) == sorted(ids)
    seen = []
    leaf = vantage.Tree._leaf
    monkeypatch.setattr(vantage.Tree, "_leaf", lambda self, span, at, *rest: (seen.append(len(at)), leaf(self, span, at, *rest))[1])
    tree.search(ids, points, np.full(400, -np.inf), 3, 1.0)
    exact = sum(seen)
    seen.clear()
    tree.search(ids, points, np.full(400, -np.inf), 3, 3.0)
    leaves = (tree.nodes[:, 4] < 0).sum()
    assert sum(seen) < exact < 400 * leaves


def test_query_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect() if r.embedding is not None]
    want = brute([(i, v) for i, v in rows if len(v) and any(v) and np.isfinite(v).all()], lambda i: i % 20 == 0, 20)
    got = found(queries.op12_vantage_trees(spark, sf_dir))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.95


def test_edge_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [2.0, 1.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [9.0, 9.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [float("inf"), 1.0]), (7, [1.0, None]), (40, [1.0, 2.0, 3.0]), (-60, [1.0, 1.0])]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as id", "2 as v", "3 as dim", "4 as part", "5 as score")
    got = found(vantage.Index(df, "vec_id", "embedding").nearest(F.col("id") % 20 == 0, 3, 1.0))
    held = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (40, [1.0, 2.0, 3.0]), (-60, [1.0, 1.0])]
    same(got, brute(held, lambda i: i % 20 == 0, 3))
    assert found(vantage.Index(df.limit(0), "vec_id", "embedding").nearest(F.col("id") % 20 == 0, 3)) == {}
