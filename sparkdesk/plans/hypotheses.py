"""Hypothesis queries on the monthly measure and the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions.calendar import season
from sparkdesk.functions import tails as L
from sparkdesk.operators import hypotheses as H
from sparkdesk.plans.demand import r
from sparkdesk.plans.panels import ANNUAL, SEASON, annual
from sparkdesk.plans.registry import query
from sparkdesk.plans.tables import MEASURE, PANEL_FULL
from sparkdesk.session import materialize


def seasonal(t):
    return t.measure.select(season("month").alias("season"), "value")


SEASONAL = f"{MEASURE}, seasonal AS (SELECT {SEASON} AS season, value FROM measure)"


def districts(t):
    """Mean measure and mean share per district, split at the median share."""
    means = annual(t).groupBy("district").agg(F.avg("value").alias("value"))
    share = t.panel_full.groupBy("district").agg(F.avg("home_ratio").alias("green"))
    return H.split_by_median(materialize(means.join(share, "district"), "districts"), "green")


DISTRICTS = f"""{MEASURE}, {ANNUAL}, {PANEL_FULL}, dm AS (SELECT district, avg(value) AS value FROM annual GROUP BY 1),
  dg AS (SELECT district, avg(home_ratio) AS green FROM panel_full GROUP BY 1),
  districts AS (SELECT *, CASE WHEN green >= median(green) OVER () THEN 'high' ELSE 'low' END AS side FROM dm JOIN dg USING (district))"""


def _anova(rows, group, value, name):
    return f"""{name}_g AS (SELECT {group}, count(*) AS n, avg({value}) AS mean, var_samp({value}) AS v FROM {rows} GROUP BY 1),
    {name} AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * mean * mean) - sum(n * mean) * sum(n * mean) / sum(n) AS ss_between, sum((n - 1) * v) AS ss_within FROM {name}_g)"""


F_OUT = "round(ss_between, 4) AS ss_between, round(ss_within, 4) AS ss_within, round((ss_between / (k - 1)) / (ss_within / (n - k)), 4) AS f, k, n"


@query("k15_median_groups", f"WITH {DISTRICTS} SELECT side, count(*) AS n, round(avg(value), 6) AS mean FROM districts GROUP BY 1")
def _(t):
    return r(districts(t).groupBy("side").agg(F.count("*").alias("n"), F.avg("value").alias("mean")))


@query("k16_levene", f"""WITH {SEASONAL}, med AS (SELECT season, median(value) AS m FROM seasonal GROUP BY 1), dev AS (SELECT s.season, abs(value - m) AS d FROM seasonal s JOIN med USING (season)),
  {_anova('dev', 'season', 'd', 'lv')} SELECT {F_OUT} FROM lv""")
def _(t):
    return r(H.levene(seasonal(t), "season", "value", with_p=False), 4).select("ss_between", "ss_within", "f", "k", "n")


@query("k17_t_statistics", f"""WITH {DISTRICTS}, g AS (SELECT side, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM districts GROUP BY 1),
  x AS (SELECT a.n AS n1, b.n AS n2, a.m AS mean1, b.m AS mean2, a.v AS v1, b.v AS v2 FROM g a, g b WHERE a.side = 'high' AND b.side = 'low')
  SELECT n1, n2, round(mean1, 6) AS mean1, round(mean2, 6) AS mean2, round((mean1 - mean2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 5) AS t_pooled,
    CAST(n1 + n2 - 2 AS DOUBLE) AS df_pooled, round((mean1 - mean2) / sqrt(v1 / n1 + v2 / n2), 5) AS t_welch,
    round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 5) AS df_welch FROM x""")
def _(t):
    out = H.t_statistics(districts(t), "side", "value", "high", "low")
    return r(r(out, 6, "mean1", "mean2"), 5, "t_pooled", "t_welch", "df_welch")


@query("k17_t_test")
def _(t):
    return r(H.t_test(districts(t), "side", "value", "high", "low"))


@query("k18_anova", f"WITH {SEASONAL}, {_anova('seasonal', 'season', 'value', 'av')} SELECT {F_OUT} FROM av")
def _(t):
    return r(H.anova(seasonal(t), "season", "value", with_p=False), 4).select("ss_between", "ss_within", "f", "k", "n")


@query("k18_anova_p")
def _(t):
    return r(H.anova(seasonal(t), "season", "value"))


@query("k19_tukey", f"""WITH {SEASONAL}, g AS (SELECT season, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM seasonal GROUP BY 1),
  w AS (SELECT sum((n - 1) * v) / (sum(n) - count(*)) AS msw FROM g) SELECT a.season AS group1, b.season AS group2, round(b.m - a.m, 6) AS diff,
    round(abs(b.m - a.m) / sqrt(msw / 2 * (1.0 / a.n + 1.0 / b.n)), 5) AS q FROM g a JOIN g b ON a.season < b.season, w""")
def _(t):
    return r(r(H.tukey(seasonal(t), "season", "value", with_p=False).select("group1", "group2", "diff", "q"), 6, "diff"), 5, "q")


@query("k19_tukey_p")
def _(t):
    return r(H.tukey(seasonal(t), "season", "value"))


@query("k20_normality", f"""WITH {SEASONAL}, c AS (SELECT season, value - avg(value) OVER (PARTITION BY season) AS d FROM seasonal),
  s AS (SELECT season, count(*) AS n, avg(d * d * d) / pow(avg(d * d), 1.5) AS skew, avg(d * d * d * d) / pow(avg(d * d), 2) - 3 AS kurt FROM c GROUP BY 1)
  SELECT season, n, round(skew, 5) AS skew, round(kurt, 5) AS kurt, round(n / 6.0 * (skew * skew + kurt * kurt / 4), 4) AS jb, round(exp(-n / 12.0 * (skew * skew + kurt * kurt / 4)), 5) AS p FROM s""")
def _(t):
    return r(r(H.normality(seasonal(t), "season", "value"), 5, "skew", "kurt", "p"), 4, "jb")


def _horner(x, factors):
    out = repr(factors[-1])
    for f in reversed(factors[:-1]):
        out = f"({out} * {x} + {f!r})"
    return out


def _quantile_sql(p):
    ratio = lambda x, of: f"({_horner(x, of[0])} / {_horner(x, of[1])})"
    root = f"sqrt(-ln(least({p}, 1 - {p})))"
    tail = f"CASE WHEN {root} <= 5.0 THEN {ratio(f'({root} - 1.6)', L.QUANTILE_TAIL)} ELSE {ratio(f'({root} - 5.0)', L.QUANTILE_FAR)} END"
    return f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))', L.QUANTILE_MIDDLE)} ELSE sign({p} - 0.5) * {tail} END"


@query("k20_shapiro_w", f"""WITH {SEASONAL}, i AS (SELECT season, value, row_number() OVER (PARTITION BY season ORDER BY value) AS i, count(*) OVER (PARTITION BY season) AS n,
    avg(value) OVER (PARTITION BY season) AS mean FROM seasonal WHERE value IS NOT NULL),
  q AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM i), m AS (SELECT season, n, i, value - mean AS x, {_quantile_sql("p")} AS m FROM q),
  s AS (SELECT season, n, sum(m * m) AS mm, sum(x * x) AS ss, sum(CASE WHEN i > 2 AND i <= n - 2 THEN m * x ELSE 0 END) AS mid, max(m) AS m1, max(CASE WHEN i = n - 1 THEN m END) AS m2,
    max(CASE WHEN i = n THEN x END) - max(CASE WHEN i = 1 THEN x END) AS wide, max(CASE WHEN i = n - 1 THEN x END) - max(CASE WHEN i = 2 THEN x END) AS inside FROM m GROUP BY 1, 2),
  a AS (SELECT *, {_horner("(1 / sqrt(n))", H.SW_LAST)} + m1 / sqrt(mm) AS a1, {_horner("(1 / sqrt(n))", H.SW_NEXT)} + m2 / sqrt(mm) AS a2 FROM s)
  SELECT season, n, round(pow(a1 * wide + a2 * inside + mid / sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)), 2) / ss, 6) AS w FROM a""")
def _(t):
    return r(H.shapiro_wilk(seasonal(t), "season", "value", with_p=False))


@query("k20_shapiro_p")
def _(t):
    return r(H.shapiro_wilk(seasonal(t), "season", "value"))


YEARLY = f"{MEASURE}, {ANNUAL}, yearly AS (SELECT year, avg(value) AS value FROM annual GROUP BY 1)"


def yearly(t):
    return annual(t).groupBy("year").agg(F.avg("value").alias("value"))


@query("k21_trend", f"""WITH {YEARLY} SELECT round(regr_slope(value, year), 6) AS slope, round(regr_intercept(value, year), 4) AS intercept, round(regr_r2(value, year), 6) AS r2, count(*) AS n,
  round(corr(year, value), 6) AS r, round(sqrt((1 - regr_r2(value, year)) * regr_syy(value, year) / regr_sxx(value, year) / (count(*) - 2)), 6) AS std_err FROM yearly""")
def _(t):
    out = H.linear_trend(yearly(t), "year", "value").select("slope", "intercept", "r2", "n", "r", "std_err")
    return r(r(out, 6, "slope", "r2", "r", "std_err"), 4, "intercept")


@query("k21_trend_p")
def _(t):
    return r(H.linear_trend(yearly(t), "year", "value"))


def regression_rows(t):
    share = t.panel_full.select("district", "year", F.col("home_ratio").alias("green"), F.col("service_ratio").alias("park"))
    return annual(t).join(share, ["district", "year"])


REG = f"""{MEASURE}, {ANNUAL}, {PANEL_FULL}, rg AS (SELECT a.value AS y, home_ratio AS x1, service_ratio AS x2 FROM annual a JOIN panel_full USING (district, year) WHERE home_ratio IS NOT NULL),
  m AS (SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2 FROM rg),
  b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM m)"""


@query("k22_regression", f"WITH {REG} SELECT 'green' AS term, round(b1, 4) AS coef FROM b UNION ALL SELECT 'park', round(b2, 4) FROM b UNION ALL SELECT 'intercept', round(my - b1 * m1 - b2 * m2, 4) FROM b")
def _(t):
    return r(H.regression(regression_rows(t), "value", ["green", "park"]).select("term", "coef"), 4)


@query("k22_regression_summary")
def _(t):
    return r(H.regression(regression_rows(t), "value", ["green", "park"]))
