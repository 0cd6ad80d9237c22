"""Cluster queries on the district x year panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.operators import clusters as K
from sparkdesk.operators import panel as P
from sparkdesk.plans.demand import r
from sparkdesk.plans.panels import ASSIGNED, SUPPLY, assigned, gas, income, people
from sparkdesk.plans.registry import query
from sparkdesk.plans.tables import PANEL_FULL

FEATS = P.FEATURES
CELL = "district || '/' || year"


def features(t):
    cell = F.concat_ws("/", "district", F.col("year").cast("string"))
    return K.feature_rows(t.panel_full.withColumn("cell", cell), ["cell", "district", "year"], FEATS)


def scaled(t):
    return K.scale(features(t), FEATS)


def given(t):
    """Scaled rows with the rule-made clusters."""
    return scaled(t).join(assigned(t).select("district", "year", "cluster"), ["district", "year"])


SCALED = f"""{ASSIGNED}, scaled AS (SELECT district, year, cluster, {", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS {f}" for f in FEATS)} FROM assigned)"""
_DIST = "sqrt(" + " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in FEATS) + ")"


def _sil(slice_join):
    return f"""{SCALED}, pr AS (SELECT a.district, a.year, a.cluster, b.cluster AS oc, sum({_DIST}) AS s, count(*) AS n FROM scaled a JOIN scaled b ON {slice_join} GROUP BY 1, 2, 3, 4),
    ab AS (SELECT district, year, cluster, max(CASE WHEN oc = cluster THEN n END) AS size, max(CASE WHEN oc = cluster THEN s / nullif(n - 1, 0) END) AS a,
      min(CASE WHEN oc <> cluster THEN s / n END) AS b FROM pr GROUP BY 1, 2, 3),
    sil AS (SELECT *, CASE WHEN size = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab)"""


@query("k01_feature_rows", f"WITH {PANEL_FULL} SELECT district, year, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in FEATS)} FROM panel_full WHERE home_ratio IS NOT NULL ORDER BY year, district")
def _(t):
    return features(t).drop("cell").orderBy("year", "district")


@query("k02_scaled", f"WITH {SCALED} SELECT district, year, {', '.join(f'round({f}, 6) AS {f}' for f in FEATS)} FROM scaled")
def _(t):
    return r(scaled(t).drop("cell"))


@query("k03_kmeans")
def _(t):
    labelled, cost = K.kmeans(scaled(t), FEATS, 6)
    return r(labelled.select("district", "year", "cluster").withColumn("inertia", F.lit(cost)))


@query("k03_kmeans_by_year")
def _(t):
    return r(K.kmeans_by_slice(features(t), ["gas_supply_ratio", "total_households", "home_ratio", "total_resident_population"], "year").select(
        "district", "year", "cluster", "inertia"))


@query("k04_cluster_profile", f"""WITH {ASSIGNED} SELECT cluster, {', '.join(f'round(avg({f}), 4) AS {f}' for f in FEATS)}, count(*) AS record_count,
  (SELECT string_agg(d, ',' ORDER BY d) FROM (SELECT DISTINCT district AS d FROM assigned x WHERE x.cluster = a.cluster)) AS members FROM assigned a GROUP BY 1""")
def _(t):
    return K.cluster_profile(assigned(t), FEATS)


@query("k05_elbow")
def _(t):
    return r(K.elbow(scaled(t), FEATS), 4)


@query("k06_silhouette", f"WITH {_sil('true')} SELECT round(avg(silhouette), 6) AS silhouette, count(*) FILTER (WHERE silhouette < 0) AS negative, count(*) AS n FROM sil")
def _(t):
    return r(K.silhouette_score(K.silhouette_rows(given(t), "cell", FEATS, blocks=3)))


@query("k06_best_k")
def _(t):
    return r(K.best_k(K.silhouette_by_k(scaled(t), "cell", FEATS)), 4)


@query("k07_silhouette_rows", f"WITH {_sil('a.year = b.year')} SELECT year, {CELL} AS cell, cluster, round(silhouette, 6) AS silhouette FROM sil WHERE silhouette IS NOT NULL")
def _(t):
    return r(K.silhouette_rows(given(t), "cell", FEATS, slices=["year"], blocks=2).where("silhouette IS NOT NULL"))


@query("k07_negative_by_year", f"WITH {_sil('a.year = b.year')} SELECT year, round(avg(silhouette), 6) AS silhouette, count(*) FILTER (WHERE silhouette < 0) AS negative, count(*) AS n FROM sil GROUP BY 1")
def _(t):
    return r(K.silhouette_score(K.silhouette_rows(given(t), "cell", FEATS, slices=["year"]), ["year"]))


_CORR = " UNION ALL ".join(f"SELECT '{a}' AS row, '{b}' AS col, round(corr({a}, {b}), 4) AS corr FROM panel_full" for a in FEATS for b in FEATS)


@query("k08_correlation", f"WITH {PANEL_FULL} {_CORR}")
def _(t):
    return K.correlation_matrix(t.panel_full, FEATS)


_RAW = ("gas_supply", "avg_income", "total_pop", "total_households")
_DERIVED = ("gas_supply_per_pop", "gas_supply_ratio", "pop_per_household", "income_per_household")


def _sets(features, name):
    return " UNION ALL ".join(f"SELECT '{name}' AS features, '{a}' AS row, '{b}' AS col, round(corr({a}, {b}), 3) AS corr FROM m" for a in features for b in features)


@query("k08_correlation_sets", f"""WITH {SUPPLY}, m AS (SELECT *, gas_supply / CAST(total_pop AS DOUBLE) AS gas_supply_per_pop, gas_supply / CAST(total_households AS DOUBLE) AS gas_supply_ratio,
    total_pop / CAST(total_households AS DOUBLE) AS pop_per_household, avg_income / CAST(total_households AS DOUBLE) AS income_per_household
    FROM gas JOIN income USING (district, year) JOIN people USING (district, year)
    WHERE total_pop > 0 AND total_households > 0 AND avg_income > 0 AND gas_supply >= 0) {_sets(_RAW, "raw")} UNION ALL {_sets(_DERIVED, "derived")}""")
def _(t):
    every = P.add_supply_features(P.valid_supply(P.merge_supply(gas(t), income(t), people(t))))
    one = lambda features, name: K.correlation_matrix(every, features, 3).withColumn("features", F.lit(name))
    return one(_RAW, "raw").unionByName(one(_DERIVED, "derived"))


@query("k09_cluster_members", f"""WITH {ASSIGNED} SELECT a.district, a.year, a.cluster, m.members FROM assigned a JOIN
  (SELECT year, cluster, string_agg(district, ',' ORDER BY district) AS members FROM assigned GROUP BY 1, 2) m ON m.year = a.year AND m.cluster = a.cluster""")
def _(t):
    return K.cluster_of(assigned(t))


@query("k10_adjusted_rand", f"""WITH {ASSIGNED}, r AS (SELECT cluster AS x, n_regionkey AS y FROM assigned JOIN nation ON n_name = district),
  c AS (SELECT x, y, count(*) AS n FROM r GROUP BY 1, 2), s AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM c) AS ab, (SELECT sum(n * (n - 1) / 2.0) FROM (SELECT sum(n) AS n FROM c GROUP BY x)) AS a,
    (SELECT sum(n * (n - 1) / 2.0) FROM (SELECT sum(n) AS n FROM c GROUP BY y)) AS b, (SELECT sum(n) FROM c) AS n)
  SELECT round((ab - a * b / (n * (n - 1) / 2.0)) / ((a + b) / 2 - a * b / (n * (n - 1) / 2.0)), 6) AS ari FROM s""")
def _(t):
    region = t.nation.select(F.col("n_name").alias("district"), F.col("n_regionkey").alias("y"))
    both = assigned(t).select("district", F.col("cluster").alias("x")).join(region, "district")
    return r(K.adjusted_rand(both, "x", "y"))


@query("k11_subsample_stability")
def _(t):
    return r(K.subsample_stability(scaled(t), "cell", FEATS, 6))


@query("k12_seed_consistency")
def _(t):
    return r(K.seed_consistency(scaled(t), "cell", FEATS, 6))


@query("k13_principal_components")
def _(t):
    out, explained = K.principal_components(scaled(t), FEATS)
    return r(out.select("district", "year", "pc1", "pc2").withColumn("explained", F.lit(sum(explained))))


@query("k14_mean_zscores", f"""WITH {ASSIGNED}, m AS (SELECT cluster, {', '.join(f'avg({f}) AS {f}' for f in FEATS)} FROM assigned GROUP BY 1)
  SELECT cluster, {', '.join(f'round(({f} - avg({f}) OVER ()) / nullif(stddev_samp({f}) OVER (), 0), 5) AS {f}' for f in FEATS)} FROM m""")
def _(t):
    return r(K.mean_zscores(assigned(t), FEATS), 5)
