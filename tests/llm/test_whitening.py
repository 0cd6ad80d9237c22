import math

import numpy as np
import pytest

from sparkdesk.llm import queries, whitening
from sparkdesk.llm.whitening import below, leading

VECTORS = "vec_id long, embedding array<double>"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.asarray(values, float)) @ q.T


@pytest.mark.parametrize("values", [
    [9, 4, 2, 1, 0.5], [5, 5, 5, 1], [1e9, 1e3, 1, 1e-3, 0], [3, 3 * (1 - 1e-9), 2, 1], [7], [2, 2], [1, 0, 0, 0, 0], list(np.linspace(1, 2, 40)), [1 + 1e-13, 1, 0.5]])
def test_slicing_finds_what_eigh_finds(values):
    m = symmetric(values)
    want = np.sort(np.linalg.eigvalsh(m))[::-1]
    got, vectors = leading(m, 4)
    real = [v for v in want[:4] if v > 1e-14 * max(want) * len(want)]
    assert len(got) == len(real) and np.allclose(got, real, rtol=1e-11, atol=1e-13 * max(want))
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-9
    assert np.abs(m @ vectors - vectors * got).max() < 1e-10 * max(want)


def test_counts_of_pivots():
    m = symmetric([5, 2, -1, -3, 0.5, 0.5])
    for shift in (-4, -2, 0, 0.4, 0.6, 3, 6):
        assert below(m, shift) == (np.linalg.eigvalsh(m) < shift).sum()
    swap = np.array([[0.0, 1.0], [1.0, 0.0]])  # needs a pivot of two rows
    assert below(swap, 0) == 1 and below(np.zeros((3, 3)), 0) == 0 and below(np.zeros((3, 3)), 1) == 3


def brute(rows, k=4):
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: [math.floor(256 * float(c)) for c in v] for i, v in fine}
    fit = sorted(set(map(tuple, x.values())))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, float) - np.array(s) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for i, mine in x.items():
        dev = sum((n * a - b) ** 2 for a, b in zip(mine, s))
        for c in range(k):
            out[i, c + 1] = (n, dev, float((np.array(mine) - np.array(s) / n) @ u[:, c] / e[c] ** 0.5), e[c] / np.trace(v))
    return out


def close(got, want):
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    flips = {}
    for r in got:
        n, dev, white, explained = want[r.vec_id, r.component]
        assert r.n == n and r.deviation == dev and r.explained == pytest.approx(explained, rel=1e-9) and r.identity_error < 1e-8
        if abs(white) > 1e-3:
            assert flips.setdefault(r.component, r.whitened * white > 0) == (r.whitened * white > 0)
        assert abs(r.whitened) == pytest.approx(abs(white), abs=1e-7)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    close(queries.op13_whitening(spark, sf_dir).collect(), brute(rows))


def test_edge_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.standard_normal(6) * [9, 5, 3, 2, 1, 1]]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (102, [float("nan")] * 6), (103, [float("inf")] * 6)]
    copies = [(200 + i, rows[0][1]) for i in range(30)]  # one fit row
    df = spark.createDataFrame([*rows, *bad, *copies, (300, [1.0, 2.0]), (301, [])], VECTORS).selectExpr("*", "1 as n", "2 as x", "3 as component", "4 as whitened").repartition(5)
    close(whitening.whitened(df).collect(), brute([*rows, *bad, *copies]))


def test_few_rows_and_flat_tables(spark):
    make = lambda rows: whitening.whitened(spark.createDataFrame(rows, VECTORS))
    assert make([]).collect() == [] and make([(1, [1.0, 2.0])]).collect() == [] and make([(1, None)]).collect() == []
    line = make([(None, [0.0, 0.0, 1.0]), (2, [1.0, 1.0, 1.0]), (2, [1.0, 1.0, 1.0])]).collect()  # rank one
    assert [r.component for r in line] == [1, 1, 1] and sorted(round(abs(r.whitened), 9) for r in line) == [1.0, 1.0, 1.0]
    assert all(r.n == 2 and r.explained == pytest.approx(1) for r in line)
    huge = make([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.0])]).collect()  # beyond long: the largest whole numbers, no deviation
    assert {r.deviation for r in huge if r.vec_id != 3} == {None}
