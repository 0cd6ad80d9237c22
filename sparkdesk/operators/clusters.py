"""Scaling, K-means with restarts, silhouettes, agreement of labelings, profiles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.operators import kmeans as J
from sparkdesk.operators.quantiles import seeded_order
from sparkdesk.session import materialize

BLOCK_ROWS = 2000

# --- preparation ------------------------------------------------------------------------------------
def feature_rows(df: DataFrame, ids: list[str], features: Sequence[str]) -> DataFrame:
    """Numeric features; rows with an unreadable one are dropped (K1)."""
    return df.select(*ids, *[F.col(f).cast("string").try_cast("double").alias(f) for f in features]).dropna(subset=list(features))


def scale(df: DataFrame, features: Sequence[str], slices: Sequence[str] = ()) -> DataFrame:
    """Centre and divide by the population deviation (K2), of the table or of each slice; constant features become 0."""
    stats = df.groupBy(*slices).agg(F.struct(*[F.struct(F.avg(f).alias("m"), F.stddev_pop(f).alias("s")).alias(f) for f in features]).alias("_stats"))
    known = df.join(stats, list(slices)) if slices else df.withColumn("_stats", stats.scalar())
    of = lambda f, what: F.col("_stats")[f][what]
    z = lambda f: (F.col(f) - of(f, "m")) / F.when(of(f, "s") == 0, 1.0).otherwise(of(f, "s"))
    return known.select(*[c for c in df.columns if c not in features], *[z(f).alias(f) for f in features])


# --- K-means ------------------------------------------------------------------------------------------
def _key(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with a column that names them in the draw of starting centres: what they hold."""
    return df.withColumn("_key", F.concat_ws("|", *[F.col(c).cast("string") for c in features]))


def kmeans(scaled: DataFrame, features: Sequence[str], k: int, restarts: int = 10, seed: int = 42) -> tuple[DataFrame, float]:
    """Best of several K-means runs: rows with ``cluster``, and the cost of the solution (K3)."""
    runs = [J.Run(k, seed + i) for i in range(restarts)]
    rows = materialize(J.with_runs(_key(scaled, features), F.lit(list(range(restarts)))), "kmeans")
    fits = J.fit_runs(rows, features, runs, "_key")
    best = J.best_of(fits, range(restarts))
    return J.labelled(rows.drop("_key"), features, fits, [best]).drop("run"), fits[best].cost


def kmeans_by_slice(df: DataFrame, features: Sequence[str], column: str, k: int = 4, restarts: int = 10, seed: int = 42) -> DataFrame:
    """K-means of every slice on its own scale, all slices and restarts in one iteration (K3): rows with ``cluster`` and ``inertia``."""
    scaled = materialize(_key(scale(df, features, [column]), features), "kmeans-slices")
    slices = [r[0] for r in scaled.select(column).distinct().orderBy(column).collect()]
    runs = [J.Run(k, seed + i) for _ in slices for i in range(restarts)]
    first = F.array_position(F.lit(slices), F.col(column)) - 1
    rows = materialize(J.with_runs(scaled, F.sequence(first * restarts, (first + 1) * restarts - 1), first), "kmeans-slices")
    fits = J.fit_runs(rows, features, runs, "_key")
    best = [J.best_of(fits, range(s * restarts, (s + 1) * restarts)) for s in range(len(slices))]
    out = J.labelled(rows.drop("_key"), features, fits, best)
    cost = F.element_at(F.lit([f.cost for f in fits]), F.col("run") + 1)
    return out.withColumn("inertia", cost).drop("run")


def _by_k(scaled: DataFrame, features: Sequence[str], ks: Sequence[int], restarts: int, seed: int):
    ks = list(ks)
    runs = [J.Run(k, seed + i) for k in ks for i in range(restarts)]
    rows = materialize(J.with_runs(_key(scaled, features), F.lit(list(range(len(runs))))), "kmeans-by-k")
    fits = J.fit_runs(rows, features, runs, "_key")
    best = {J.best_of(fits, range(i * restarts, (i + 1) * restarts)): k for i, k in enumerate(ks)}
    return rows.drop("_key"), fits, best


def _named(runs: dict[int, int], name: str, spark) -> DataFrame:
    return spark.createDataFrame([(int(r), int(k)) for r, k in runs.items()], f"run int, {name} int")


def elbow(scaled: DataFrame, features: Sequence[str], ks: Sequence[int] = range(2, 11), restarts: int = 10, seed: int = 42) -> DataFrame:
    """Cost and squared-Euclidean silhouette per number of clusters (K5)."""
    rows, fits, best = _by_k(scaled, features, ks, restarts, seed)
    cost = F.element_at(F.lit([f.cost for f in fits]), F.col("run") + 1)
    scores = J.squared_silhouettes(rows, features, fits, list(best)).withColumn("inertia", cost)
    return scores.join(_named(best, "k", scaled.sparkSession), "run").select("k", "inertia", F.col("silhouette").alias("fast_silhouette"))


# --- silhouettes -------------------------------------------------------------------------------------
def silhouette_rows(df: DataFrame, row_id: str, features: Sequence[str], cluster: str = "cluster", slices: Sequence[str] = (),
                    blocks: int | None = None) -> DataFrame:
    """Exact Euclidean silhouette of each row within its slice (K7).

    Rows are cut into blocks (of some BLOCK_ROWS of the largest slice, unless their number is given); every pair of
    blocks meets once and yields one sum per row and cluster, so no pair of rows is ever materialised and no group
    grows with the table. The arithmetic stays quadratic by definition; :func:`elbow` has the linear variant.
    """
    keys = list(slices)
    if blocks is None:
        sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
        blocks = max(1, -(-(sizes.agg(F.max("n")).first()[0] or 1) // BLOCK_ROWS))
    base = df.select(*keys, F.col(row_id).alias("id"), F.col(cluster).alias("c"), F.array(*features).alias("v"))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = base.withColumn("_a", own).withColumn("_b", every)
    right = base.withColumn("_b", own).withColumn("_a", every).select(*[F.col(c).alias(f"r{c}") for c in [*keys, "id", "c", "v", "_a", "_b"]])
    types = dict(df.select(*keys, F.col(row_id).alias("id"), F.col(cluster).alias("c")).dtypes)
    schema = ", ".join(f"`{n}` {t}" for n, t in types.items()) + ", `oc` " + types["c"] + ", `s` double, `n` long"

    def distances(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        cols = [*keys, "id", "c", "oc", "s", "n"]
        if a.empty or b.empty:
            return pd.DataFrame({c: [] for c in cols})
        m, o = np.stack(a["v"].to_numpy()), np.stack(b["rv"].to_numpy())
        d = np.sqrt(((m[:, None, :] - o[None, :, :]) ** 2).sum(axis=2))
        parts = []
        for oc, at in b.groupby("rc").indices.items():
            parts.append(a[[*keys, "id", "c"]].assign(oc=oc, s=d[:, at].sum(axis=1), n=len(at)))
        return pd.concat(parts)[cols]

    by = [*keys, "_a", "_b"]
    sums = left.groupBy(*by).cogroup(right.groupBy(*[f"r{c}" for c in by])).applyInPandas(distances, schema)
    per = sums.groupBy(*keys, "id", "c", "oc").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    mine = F.col("oc") == F.col("c")
    agg = per.groupBy(*keys, "id", "c").agg(
        F.max(F.when(mine, F.col("n"))).alias("size"), F.max(F.when(mine, F.col("s") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~mine, F.col("s") / F.col("n"))).alias("b"))
    value = F.when(F.col("size") == 1, 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return agg.select(*keys, F.col("id").alias(row_id), F.col("c").alias(cluster), value.alias("silhouette"))


def silhouette_score(rows: DataFrame, slices: Sequence[str] = ()) -> DataFrame:
    """Mean silhouette and rows below zero, per slice (K6, K7)."""
    return rows.groupBy(*slices).agg(
        F.avg("silhouette").alias("silhouette"), F.count_if(F.col("silhouette") < 0).alias("negative"), F.count("*").alias("n"))


def best_k(scores: DataFrame) -> DataFrame:
    """Number of clusters with the largest silhouette; the smallest wins a tie (K6)."""
    return scores.agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("best_k"), F.max("silhouette").alias("best_score"))


def silhouette_by_k(scaled: DataFrame, row_id: str, features: Sequence[str], ks: Sequence[int] = range(2, 11), restarts: int = 10, seed: int = 42) -> DataFrame:
    """Exact silhouette for each number of clusters (K6)."""
    rows, fits, best = _by_k(scaled, features, ks, restarts, seed)
    labels = J.labelled(rows, features, fits, list(best)).join(_named(best, "k", scaled.sparkSession), "run")
    labels = materialize(labels.drop("run"), "silhouette")
    return silhouette_score(silhouette_rows(labels, row_id, features, slices=["k"]), ["k"]).select("k", "silhouette")


# --- profiles ------------------------------------------------------------------------------------------
def cluster_profile(assigned: DataFrame, features: Sequence[str], member: str = "district") -> DataFrame:
    """Means (four decimals), rows and distinct members per cluster (K4)."""
    names = assigned.select("cluster", member).distinct().groupBy("cluster").agg(
        F.array_join(F.array_sort(F.collect_set(member)), ",").alias("members"))  # names of the panel's districts
    means = assigned.groupBy("cluster").agg(*[F.round(F.avg(f), 4).alias(f) for f in features], F.count("*").alias("record_count"))
    return means.join(names, "cluster")


def cluster_of(assigned: DataFrame, district: str | None = None, year: int | None = None) -> DataFrame:
    """Cluster of each (district, year) with its members that year and the cluster's means (K9)."""
    members = assigned.groupBy("year", "cluster").agg(
        F.array_join(F.array_sort(F.collect_set("district")), ",").alias("members"))
    rows = assigned.select("district", "year", "cluster")
    if district is not None:
        rows = rows.where(F.col("district") == district)
    if year is not None:
        rows = rows.where(F.col("year") == year)
    return rows.join(members, ["year", "cluster"])


def mean_zscores(assigned: DataFrame, features: Sequence[str]) -> DataFrame:
    """Cluster means as z-scores across clusters, sample deviation."""
    means = assigned.groupBy("cluster").agg(*[F.avg(f).alias(f) for f in features])
    stats = means.agg(F.struct(*[
        F.struct(F.avg(f).alias("m"), F.stddev_samp(f).alias("s")).alias(f) for f in features]).alias("stats")).scalar()
    return means.select("cluster", *[((F.col(f) - stats[f]["m"]) / F.nullif(stats[f]["s"], F.lit(0.0))).alias(f) for f in features])


def correlation_matrix(df: DataFrame, features: Sequence[str], digits: int = 4) -> DataFrame:
    """Correlation of every pair of features, in one aggregation (K8). Rows that lack one of a pair are left out of that pair."""
    names = list(features)
    cells = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in cells])
    rows = F.array(*[
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.round(F.col(f"`{x}|{y}`"), digits).alias("corr"))
        for x, y in cells for a, b in {(x, y), (y, x)}])
    return one.select(F.inline(rows))


# --- agreement -----------------------------------------------------------------------------------------
def adjusted_rand(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Adjusted Rand index of two labelings of the same rows, from the contingency counts (K10); one per group of ``by``."""
    by = list(by)
    cells = df.groupBy(*by, a, b).agg(F.count("*").alias("n"))
    pairs = lambda n: n * (n - 1) / 2.0
    part = lambda src, tag: src.select(*by, F.lit(tag).alias("t"), pairs(F.col("n")).alias("p"), F.col("n"))
    rows = part(cells, "ab").unionByName(part(cells.groupBy(*by, a).agg(F.sum("n").alias("n")), "a")).unionByName(
        part(cells.groupBy(*by, b).agg(F.sum("n").alias("n")), "b"))
    s = rows.groupBy(*by).agg(*[F.sum(F.when(F.col("t") == t, F.col("p"))).alias(t) for t in ("ab", "a", "b")],
                              F.sum(F.when(F.col("t") == "ab", F.col("n"))).alias("n"))
    expected = F.col("a") * F.col("b") / pairs(F.col("n"))
    top = (F.col("a") + F.col("b")) / 2
    return s.select(*by, F.when(top == expected, 1.0).otherwise((F.col("ab") - expected) / (top - expected)).alias("ari"))


# Grades of a mean agreement (fixed values): least mean, word.
GRADES = ((0.8, "very stable"), (0.6, "stable"), (0.4, "fair"))


def _agreement(labels: DataFrame, row_id: str, base: int, graded: bool) -> DataFrame:
    """Agreement of every other run with the base run, summed up in one row."""
    labels = materialize(labels.select(row_id, "run", "cluster"), "agreement")
    of = labels.where(F.col("run") == base).select(row_id, F.col("cluster").alias("x"))
    both = labels.where(F.col("run") != base).select(row_id, "run", F.col("cluster").alias("y")).join(of, row_id)
    word = F.lit("unstable")
    for least, name in reversed(GRADES):
        word = F.when(F.avg("ari") >= least, name).otherwise(word)
    return adjusted_rand(both, "x", "y", ["run"]).agg(
        F.count("*").cast("int").alias("runs"), F.avg("ari").alias("mean"), F.stddev_pop("ari").alias("std"), F.min("ari").alias("min"), F.max("ari").alias("max"),
        (word if graded else F.lit(None).cast("string")).alias("grade"))


def subsample_stability(scaled: DataFrame, row_id: str, features: Sequence[str], k: int, repeats: int = 100, share: float = 0.8,
                        restarts: int = 5, seed: int = 42, base_restarts: int = 10) -> DataFrame:
    """Agreement of clusterings of random subsamples with the full one (K11): all subsamples in one iteration."""
    starts = [base_restarts + i * restarts for i in range(repeats)]
    taken = F.array(*[F.when(seeded_order(F.col(row_id), seed + i) < F.lit(int(share * 2**52)), F.lit(list(range(s, s + restarts)))).otherwise(F.array().cast("array<int>"))
                      for i, s in enumerate(starts)])
    rows = materialize(J.with_runs(scaled, F.concat(F.lit(list(range(base_restarts))), F.flatten(taken))), "stability")
    runs = [J.Run(k, seed + i) for i in range(base_restarts)] + [J.Run(k, seed + i + j) for i in range(repeats) for j in range(restarts)]
    fits = J.fit_runs(rows, features, runs, row_id)
    base = J.best_of(fits, range(base_restarts))
    best = [J.best_of(fits, range(s, s + restarts)) for s in starts]
    return _agreement(J.labelled(rows, features, fits, [base, *best]), row_id, base, True)


def seed_consistency(scaled: DataFrame, row_id: str, features: Sequence[str], k: int, seeds: Sequence[int] = range(10), seed: int = 42,
                     restarts: int = 10) -> DataFrame:
    """Agreement of single-seed clusterings with the baseline (K12), in one iteration."""
    runs = [J.Run(k, seed + i) for i in range(restarts)] + [J.Run(k, s) for s in seeds]
    rows = materialize(J.with_runs(scaled, F.lit(list(range(len(runs))))), "consistency")
    fits = J.fit_runs(rows, features, runs, row_id)
    base = J.best_of(fits, range(restarts))
    return _agreement(J.labelled(rows, features, fits, [base, *range(restarts, len(runs))]), row_id, base, False)


def principal_components(scaled: DataFrame, features: Sequence[str], n: int = 2) -> tuple[DataFrame, list[float]]:
    """Coordinates on the first components and the variance each explains."""
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(scaled)
    model = PCA(k=n, inputCol="features", outputCol="pc").fit(vectors)
    arr = vector_to_array("pc")
    out = model.transform(vectors).select(
        *[c for c in scaled.columns if c not in features], *[arr[i].alias(f"pc{i + 1}") for i in range(n)])
    return out, [float(x) for x in model.explainedVariance]
