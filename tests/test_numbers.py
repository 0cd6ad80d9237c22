"""Statistics, order statistics, retrieval blocks, clustering, scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdesk.functions import scoring as S
from sparkdesk.functions import tails
from sparkdesk.functions.cleaning import clean_number, fixed, parse_money
from sparkdesk.operators import clusters as K
from sparkdesk.operators import hypotheses as H
from sparkdesk.operators import quantiles as Q
from sparkdesk.operators import retrieval as V
from sparkdesk.operators.companies import resolve_names


def test_tail_golden_values():
    assert tails.t_two_sided(1.894, 23) == pytest.approx(0.07087, abs=2e-5)
    r2 = 0.736
    assert tails.t_two_sided((r2 * 4 / (1 - r2)) ** 0.5, 4) == pytest.approx(0.02885, abs=2e-4)
    assert tails.f_upper(4.26, 2, 9) == pytest.approx(0.05, abs=5e-4)
    assert tails.studentized_range_upper(3.877, 3, 10) == pytest.approx(0.05, abs=5e-4)
    assert tails.studentized_range_upper(3.633, 4, 1e6) == pytest.approx(0.05, abs=5e-4)


def test_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([np.full(4000, 7.0), rng.lognormal(1, 2, 3000), -rng.lognormal(1, 2, 3001)])
    df = spark.createDataFrame([(("hot" if i % 3 else "b"), float(v)) for i, v in enumerate(vals)], "g string, v double")
    for groups in ([], ["g"]):
        got = Q.exact_quantiles(df, groups, "v", [0.01, 0.25, 0.5, 0.9, 1.0], list("abcde")).collect()
        for r in got:
            mine = [float(v) for i, v in enumerate(vals) if not groups or ("hot" if i % 3 else "b") == r.g]
            assert [r[c] for c in "abcde"] == pytest.approx(list(np.quantile(mine, [0.01, 0.25, 0.5, 0.9, 1.0])))


def test_query_blocks_equal_one_pass(spark, tables):
    docs = tables.embeddings.select(F.col("vec_id").alias("doc_id"), "label", "embedding")
    queries = docs.select(F.col("doc_id").alias("query_id"), "embedding")
    rows = lambda df: sorted((r.query_id, r.doc_id, r.rank) for r in df.collect())
    assert rows(V.cosine_top_k(queries, docs, 3)) == rows(V.cosine_top_k(queries, docs, 3, query_limit=60, block_docs=100))


def test_approximate_search_recall(spark, tables):
    docs = tables.embeddings.select(F.col("vec_id").alias("doc_id"), "label", "embedding")
    queries = V.centroids(docs, "label").select(F.col("label").cast("bigint").alias("query_id"), "embedding")
    exact = {(r.query_id, r.doc_id) for r in V.cosine_top_k(queries, docs, 5).collect()}
    near = {(r.query_id, r.doc_id) for r in V.approximate_top_k(queries, docs, 5).collect()}
    assert len(exact & near) >= 0.6 * len(exact)


def test_resolution_tiers(spark):
    reg = spark.createDataFrame(
        [("3", "Alpha", None), ("2", "Alpha", "000002"), ("1", "Beta", None), ("5", "Gamma Holdings", "000005"), ("4", "Gamma Works", None)],
        "corp_code string, corp_name string, stock_code string")
    asked = spark.createDataFrame([("Alpha",), ("Beta",), ("gamma",), ("works",), ("zzz",)], "name string")
    assert {r.name: (r.tier, r.corp_code) for r in resolve_names(asked, reg).collect()} == {
        "Alpha": (1, "2"), "Beta": (2, "1"), "gamma": (3, "5"), "works": (4, "4")}


def blobs(spark, n=60):
    rng = np.random.default_rng(3)
    pts = np.concatenate([rng.normal(c, 0.3, (n // 3, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    return spark.createDataFrame([(str(i), i // (n // 3), float(x), float(y)) for i, (x, y) in enumerate(pts)], "id string, truth int, x double, y double")


def test_kmeans_finds_blobs_and_silhouette_blocks_agree(spark):
    df = blobs(spark)
    out, cost = K.kmeans(K.scale(df, ["x", "y"]), ["x", "y"], 3, restarts=4)
    both = df.select("id", "truth").join(out.select("id", "cluster"), "id")
    assert K.adjusted_rand(both, "truth", "cluster").first().ari == pytest.approx(1.0)
    scores = [K.silhouette_score(K.silhouette_rows(out, "id", ["x", "y"], blocks=b)).first().silhouette for b in (1, 4)]
    assert scores[0] == pytest.approx(scores[1]) and scores[0] > 0.7
    report = K.seed_consistency(K.scale(df, ["x", "y"]), "id", ["x", "y"], 3, seeds=range(2), restarts=2).first()
    assert report.max == pytest.approx(1.0) and report.runs == 2
    report = K.subsample_stability(K.scale(df, ["x", "y"]), "id", ["x", "y"], 3, repeats=12, restarts=3).first()
    assert report.runs == 12 and report.mean > 0.95 and report.grade == "very stable"
    by_k = {r.k: r for r in K.elbow(K.scale(df, ["x", "y"]), ["x", "y"], range(2, 6), 4).collect()}
    assert [by_k[k].inertia for k in range(2, 6)] == sorted((by_k[k].inertia for k in range(2, 6)), reverse=True)
    assert max(by_k, key=lambda k: by_k[k].fast_silhouette) == 3
    assert K.best_k(K.silhouette_by_k(K.scale(df, ["x", "y"]), "id", ["x", "y"], range(2, 6), 4)).first().best_k == 3


def test_joint_runs_equal_lloyd_by_hand(spark):
    from sparkdesk.operators import kmeans as J

    rng = np.random.default_rng(4)
    x = rng.standard_normal((240, 2)) + rng.integers(0, 3, 240)[:, None] * 4
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, x double, y double").repartition(4)
    runs = [J.Run(3, 0), J.Run(4, 1), J.Run(2, 2)]
    part = F.when(F.col("id") % 2 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = J.with_runs(df, part).cache()
    fits = J.fit_runs(rows, ["x", "y"], runs, "id")
    for i, (run, fit) in enumerate(zip(runs, fits)):
        mine = x[::2] if i != 1 else x
        at = ((mine[:, None] - fit.centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert len(fit.centres) == run.k and np.allclose(fit.centres, [mine[at == c].mean(axis=0) for c in range(run.k)])  # a fixed point
        assert fit.cost == pytest.approx(((mine - fit.centres[at]) ** 2).sum()) and fit.sizes.tolist() == np.bincount(at).tolist()
        labels = {r.id: r.cluster for r in J.labelled(rows, ["x", "y"], fits, [i]).collect()}
        assert [labels[k] for k in sorted(labels)] == at.tolist()


def test_number_of_jobs_does_not_follow_the_years(spark):
    rng = np.random.default_rng(2)
    make = lambda years: spark.createDataFrame([(y, float(rng.normal(c * 9)), float(rng.normal())) for y in range(years) for c in range(3) for _ in range(8)], "year int, x double, y double")
    seen = []
    for years in (2, 9):
        spark.sparkContext.setJobGroup(f"years{years}", "")
        out = K.kmeans_by_slice(make(years), ["x", "y"], "year", 3, 2)
        assert out.count() == years * 24 and out.groupBy("year").agg(F.countDistinct("cluster").alias("k")).where("k <> 3").count() == 0
        seen.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"years{years}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen[1] < 2 * seen[0]


def test_a_narrow_range_of_values_stays_spread(spark, monkeypatch):
    from sparkdesk.operators import ordered

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    seen = []
    whole = ordered.sorted_ranges
    monkeypatch.setattr(ordered, "sorted_ranges", lambda *a, **k: (seen.append(whole(*a, **k)), seen[-1])[1])
    df = spark.range(20000).selectExpr("CASE WHEN id < 2 THEN 1e12 * (id * 2 - 1) ELSE id * 1e-9 END AS v")
    got = Q.exact_quantiles(df, [], "v", [0.5, 1.0], ["m", "top"]).first()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got.m == pytest.approx(float(np.median([-1e12, 1e12, *[i * 1e-9 for i in range(2, 20000)]])), rel=1e-12) and got.top == 1e12
    sizes = [r["count"] for r in seen[0].groupBy("_range").count().collect()]
    assert max(sizes) < 20000 / 3


def test_shapiro_wilk_published_examples(spark):
    import statistics

    from sparkdesk.functions.tails import normal_quantile

    ps = [1e-300, 1e-12, 0.001, 0.07, 0.0751, 0.3, 0.5, 0.7, 0.93, 0.999]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p"))).collect()]
    assert got[1:] == pytest.approx([statistics.NormalDist().inv_cdf(p) for p in ps[1:]], rel=1e-13, abs=1e-15) and got[0] == pytest.approx(-37.0471, abs=1e-3)
    examples = {"men": [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], "ten": range(1, 11), "same": [3, 3, 3, 3], "two": [1, 2], "line": [1, 2, 3]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in examples.items() for v in vs] + [("ten", None)], "g string, v double")
    got = {r.g: (r.w, r.p) for r in H.shapiro_wilk(df, "g", "v").collect()}
    assert set(got) == {"men", "ten", "same", "line"} and got["same"] == (None, None)
    assert got["men"][0] == pytest.approx(0.7888, abs=5e-5) and got["men"][1] == pytest.approx(0.0067, abs=5e-5)
    assert got["ten"][0] == pytest.approx(0.9702, abs=5e-5) and got["ten"][1] == pytest.approx(0.8924, abs=5e-4)
    assert got["line"][0] == pytest.approx(1.0)


def test_anova_and_t_test(spark):
    rows = [("a", v) for v in (6.0, 8.0, 4.0, 5.0, 3.0, 4.0)] + [("b", v) for v in (8.0, 12.0, 9.0, 11.0, 6.0, 8.0)] + [("c", v) for v in (13.0, 9.0, 11.0, 8.0, 7.0, 12.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    r = H.anova(df, "g", "v").first()
    assert r.f == pytest.approx(9.2647, abs=1e-3) and r.p == pytest.approx(0.0024, abs=2e-4)
    t = H.t_test(df.where("g <> 'c'"), "g", "v", "a", "b").first()
    assert t.equal_var and t.t == pytest.approx(-3.5967, abs=0.2) and t.df == 10


def test_dirty_numbers(spark):
    df = spark.createDataFrame([("1,234",), ("-",), ("-5",), ("abc",), (" 7 ",), ("(1,500)",), ("N/A",), ("3,000원",), (None,)], "t string")
    got = [tuple(r) for r in df.select(clean_number("t"), clean_number("t", every_dash=True), parse_money("t")).collect()]
    assert got == [(1234.0, 1234.0, 1234.0), (0.0, 0.0, None), (-5.0, 5.0, -5.0), (None, None, None), (7.0, 7.0, 7.0), (None, None, -1500.0),
                   (None, None, None), (None, None, 3000.0), (None, None, None)]


def test_fixed_decimals_keep_the_sign(spark):
    df = spark.createDataFrame([(-0.04,), (0.04,), (2.25,), (-2.35,), (None,)], "v double")
    assert [r[0] for r in df.select(fixed("v", 1)).collect()] == ["-0.0", "0.0", "2.2", "-2.4", None]


def test_score_edges(spark):
    df = spark.createDataFrame([(8.0, 1.0, 20.0, 5.0), (25.1, 3.6, -1.0, -5.0), (None, None, None, None)], "per double, pbr double, roe double, ni double")
    c = F.col
    got = [tuple(r) for r in df.select(S.value_block(c("per"), c("pbr"))["score"], S.profit_block(c("roe"), c("ni"), c("ni"))["score"],
                                       S.stability_block(c("ni"), c("pbr"), c("roe"), c("ni"), c("ni"))["score"]).collect()]
    assert got == [(25, 25, 25), (3, 0, 1), (0, 0, 0)]


def test_classifier_learns(spark):
    from sparkdesk.operators import datasets as Z

    rows = [(i, "en", "the of and there " * 3) for i in range(20)] + [(100 + i, "de", "der und nicht ist " * 3) for i in range(10)]
    df = spark.createDataFrame(rows, "rcept_no long, label string, text string")
    model = Z.train_classifier(df, features=256, max_iter=5)
    assert Z.evaluation_summary(Z.score_texts(model, df)).first().accuracy == 1.0


def test_names_are_dealt_over_tasks(spark, monkeypatch):
    """Names of one small file are exploded in tasks of a bounded number of names."""
    from sparkdesk.operators import companies as B

    monkeypatch.setattr(B, "NAMES_PER_TASK", 10, raising=False)
    names = spark.createDataFrame([(f"alpha{i:03d}", i) for i in range(45)], "text string, row int").coalesce(1)
    needles = spark.createDataFrame([("alpha",), ("a044",)], "needle string")
    found = B._best_by_substring(names, needles, F.col("row"))
    assert sorted(map(tuple, found.collect())) == [("a044", 44), ("alpha", 0)]
    assert "RoundRobinPartitioning(5)" in found._jdf.queryExecution().toString()


def test_deliveries_are_not_written_by_one_task(spark, sf_dir, monkeypatch):
    from sparkdesk.plans import load_all
    from sparkdesk.plans.registry import QUERIES

    def alone(self, n):
        raise AssertionError("a whole delivery in one task")

    load_all()
    monkeypatch.setattr(type(spark.range(1)), "coalesce", alone)
    assert QUERIES["r01_stream_to_silver"](spark, sf_dir).count() > 0
