"""Hypothesis tests and regressions. Data is reduced to moments per group in one aggregation;
only the few result rows meet the tail functions."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.functions.tails import f_pvalue, normal_quantile, normal_upper, polynomial, range_pvalue, t_pvalue
from sparkdesk.operators.ordered import number_rows
from sparkdesk.operators.quantiles import exact_median
from sparkdesk.session import materialize


def moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """Size, mean and sample variance per group."""
    return df.where(F.col(value).isNotNull()).groupBy(group).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("var"))


def split_by_median(df: DataFrame, by: str, name: str = "side", high: str = "high", low: str = "low") -> DataFrame:
    """Rows at or above the overall median are 'high', the others 'low' (K15)."""
    middle = exact_median(df, [], by).select("median").scalar()
    return df.withColumn(name, F.when(F.col(by) >= middle, high).otherwise(low))


def anova(df: DataFrame, group: str, value: str, with_p: bool = True) -> DataFrame:
    """One-way analysis of variance in one row: sums of squares, F, degrees of freedom, p."""
    g = moments(df, group, value)
    sums = g.agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("s1"),
        F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("s2"), F.sum((F.col("n") - 1) * F.col("var")).alias("ss_within"))
    out = sums.select(
        "k", "n", (F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")).alias("ss_between"), "ss_within",
        (F.col("k") - 1).alias("df1"), (F.col("n") - F.col("k")).alias("df2"))
    out = out.withColumn("f", (F.col("ss_between") / F.col("df1")) / (F.col("ss_within") / F.col("df2")))
    return out.withColumn("p", f_pvalue(F.col("f"), F.col("df1").cast("double"), F.col("df2").cast("double"))) if with_p else out


def levene(df: DataFrame, group: str, value: str, with_p: bool = True) -> DataFrame:
    """Equality of variances: analysis of variance of the distances from the group medians."""
    middles = materialize(exact_median(df, [group], value).select(group, "median"), "medians")  # one row per group
    spread = df.join(middles, group).select(group, F.abs(F.col(value) - F.col("median")).alias("spread"))
    return anova(spread, group, "spread", with_p)


def t_statistics(df: DataFrame, group: str, value: str, first: str, second: str) -> DataFrame:
    """Pooled and Welch t with their degrees of freedom, in one row."""
    g = moments(df, group, value)
    pick = lambda side, c: F.max(F.when(F.col(group) == side, F.col(c)))
    r = g.agg(*[pick(s, c).alias(f"{c}{i}") for i, s in ((1, first), (2, second)) for c in ("n", "mean", "var")])
    n1, n2, v1, v2 = F.col("n1"), F.col("n2"), F.col("var1"), F.col("var2")
    gap = F.col("mean1") - F.col("mean2")
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    e1, e2 = v1 / n1, v2 / n2
    return r.select(
        "n1", "n2", "mean1", "mean2",
        (gap / F.sqrt(pooled * (1 / n1 + 1 / n2))).alias("t_pooled"), (n1 + n2 - 2).cast("double").alias("df_pooled"),
        (gap / F.sqrt(e1 + e2)).alias("t_welch"),
        ((e1 + e2) * (e1 + e2) / (e1 * e1 / (n1 - 1) + e2 * e2 / (n2 - 1))).alias("df_welch"))


def t_test(df: DataFrame, group: str, value: str, first: str, second: str, alpha: float = 0.05) -> DataFrame:
    """Two-sample t test: pooled where Levene sees equal variances, otherwise Welch."""
    equal = levene(df, group, value).select((F.col("p") > alpha).alias("e")).scalar()
    rows = t_statistics(df, group, value, first, second).withColumn("equal_var", equal)
    chosen = rows.withColumn("t", F.when(F.col("equal_var"), F.col("t_pooled")).otherwise(F.col("t_welch"))).withColumn(
        "df", F.when(F.col("equal_var"), F.col("df_pooled")).otherwise(F.col("df_welch")))
    return chosen.withColumn("p", t_pvalue("t", "df")).withColumn("significant", F.col("p") < alpha).select(
        "mean1", "mean2", "equal_var", "t", "df", "p", "significant")


def tukey(df: DataFrame, group: str, value: str, alpha: float = 0.05, with_p: bool = True) -> DataFrame:
    """Pairwise differences after analysis of variance (K19). One row per pair of groups, from group moments only."""
    g = moments(df, group, value)
    table = g.agg(
        F.array_sort(F.collect_list(F.struct(F.col(group).alias("g"), "n", "mean"))).alias("all"), F.count("*").alias("k"),
        (F.sum("n") - F.count("*")).alias("df"), (F.sum((F.col("n") - 1) * F.col("var")) / (F.sum("n") - F.count("*"))).alias("msw"))
    pairs = table.select("k", "df", "msw", "all", F.explode("all").alias("a")).select("k", "df", "msw", "a", F.explode("all").alias("b"))
    gap = F.col("b.mean") - F.col("a.mean")
    out = pairs.where("a.g < b.g").select(
        F.col("a.g").alias("group1"), F.col("b.g").alias("group2"), gap.alias("diff"),
        (F.abs(gap) / F.sqrt(F.col("msw") / 2 * (1 / F.col("a.n") + 1 / F.col("b.n")))).alias("q"), "k", "df")
    if not with_p:
        return out
    return out.withColumn("p", range_pvalue(F.col("q"), F.col("k").cast("double"), F.col("df").cast("double"))).withColumn(
        "reject", F.col("p") < alpha)


def normality(df: DataFrame, group: str, value: str) -> DataFrame:
    """Jarque-Bera statistic and p per group."""
    g = df.groupBy(group).agg(F.count(value).alias("n"), F.skewness(value).alias("skew"), F.kurtosis(value).alias("kurt"))
    jb = F.col("n") / 6 * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / 4)
    return g.withColumn("jb", jb).withColumn("p", F.exp(-jb / 2))


# Polynomials of the Shapiro-Wilk test (Royston 1995, algorithm AS R94; fixed values), in rising powers: weights of the
# largest and of the next value in 1/sqrt(n); mean and log deviation of the transformed statistic in n and in log n.
SW_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
SW_NEXT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SW_SMALL_SHIFT = (-2.273, 0.459)
SW_SMALL_MEAN = (0.5440, -0.39978, 0.025054, -0.0006714)
SW_SMALL_DEV = (1.3822, -0.77857, 0.062767, -0.0020322)
SW_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
SW_DEV = (-0.4803, -0.082676, 0.0030302)


def shapiro_wilk(df: DataFrame, group: str, value: str, with_p: bool = True) -> DataFrame:
    """Shapiro-Wilk W per group, and p (K20). Groups of fewer than three values, or of equal ones, have none.

    Ranks come from an ordered scan, so a group of any size stays spread over the tasks; the weights are normal scores of
    the ranks, worked out row by row, and all sums are one aggregation per group.
    """
    known = df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")).dropna()
    sizes = known.groupBy("_g").agg(F.count("*").alias("n"), F.avg("_v").alias("_mean"))
    ranked = number_rows(known, ["_g"], "_v", "_i").join(sizes, "_g").withColumn("_x", F.col("_v") - F.col("_mean"))
    n, i, score = F.col("n"), F.col("_i"), lambda at: normal_quantile((at - 0.375) / (F.col("n") + 0.25))
    ranked = ranked.withColumn("_m", score(i))
    ends = F.when(n > 5, 2).otherwise(1)  # values on each side that have a weight of their own
    at = lambda place: F.max(F.when(i == place, F.col("_x")))
    s = ranked.groupBy("_g", "n").agg(
        F.sum(F.col("_m") * F.col("_m")).alias("_mm"), F.sum(F.col("_x") * F.col("_x")).alias("_ss"),
        F.sum(F.when((i > ends) & (i <= n - ends), F.col("_m") * F.col("_x")).otherwise(0.0)).alias("_mid"),
        (at(n) - at(F.lit(1))).alias("_wide"), (at(n - 1) - at(F.lit(2))).alias("_inner")).where("n >= 3")
    u, poly = 1 / F.sqrt("n"), lambda x, factors: polynomial(x, [F.lit(f) for f in factors])
    last, second = score(n), score(n - 1)
    a1 = poly(u, SW_LAST) + last / F.sqrt("_mm")
    a2 = poly(u, SW_NEXT) + second / F.sqrt("_mm")
    s = s.withColumns({"_a1": F.when(n == 3, F.sqrt(F.lit(0.5))).otherwise(a1), "_a2": a2})
    left = F.when(n > 5, (F.col("_mm") - 2 * last * last - 2 * second * second) / (1 - 2 * F.col("_a1") ** 2 - 2 * F.col("_a2") ** 2)).otherwise(
        (F.col("_mm") - 2 * last * last) / (1 - 2 * F.col("_a1") ** 2))
    top = F.col("_a1") * F.col("_wide") + F.when(n > 5, F.col("_a2") * F.col("_inner")).otherwise(0.0) + F.when(n > 3, F.col("_mid") / F.sqrt(left)).otherwise(0.0)
    out = s.select(F.col("_g").alias(group), "n", F.when(F.col("_ss") > 0, F.least(top * top / F.col("_ss"), F.lit(1.0))).alias("w"))
    if not with_p:
        return out
    w, size = F.col("w"), n.cast("double")
    small = (-F.log(poly(size, SW_SMALL_SHIFT) - F.log1p(-w)) - poly(size, SW_SMALL_MEAN)) / F.exp(poly(size, SW_SMALL_DEV))
    large = (F.log1p(-w) - poly(F.log(size), SW_MEAN)) / F.exp(poly(F.log(size), SW_DEV))
    p3 = F.greatest(6 / F.pi() * (F.asin(F.sqrt(w)) - F.asin(F.sqrt(F.lit(0.75)))), F.lit(0.0))
    z = normal_upper(F.when(size <= 11, small).otherwise(large))
    return out.withColumn("p", F.when(w.isNull(), None).when(w == 1, 1.0).when(size == 3, p3).otherwise(z))


def linear_trend(df: DataFrame, x: str, y: str, alpha: float = 0.05) -> DataFrame:
    """Slope, intercept, R2, standard error, p and whether there is a significant fall."""
    r = df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"), F.corr(x, y).alias("r"), (F.regr_syy(y, x) / F.regr_sxx(y, x)).alias("_ratio"))
    r = r.withColumn("std_err", F.sqrt((1 - F.col("r2")) * F.col("_ratio") / (F.col("n") - 2))).drop("_ratio")
    r = r.withColumn("p", t_pvalue(F.col("slope") / F.col("std_err"), (F.col("n") - 2).cast("double")))
    return r.withColumn("falling", (F.col("p") < alpha) & (F.col("slope") < 0))


def regression(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """Least squares with several predictors: a row per term with coefficient, error, t, p, and R2."""
    rows = df.select(F.col(y).cast("double").alias("_y"), *[F.col(x).cast("double").alias(x) for x in xs]).dropna()
    model = LinearRegression(labelCol="_y", featuresCol="_x", solver="normal").fit(
        VectorAssembler(inputCols=xs, outputCol="_x").transform(rows))
    s = model.summary
    coef = [*model.coefficients.toArray().tolist(), model.intercept]
    table = zip([*xs, "intercept"], coef, s.coefficientStandardErrors, s.tValues, s.pValues)
    return df.sparkSession.createDataFrame(
        [(n, float(c), float(e), float(t), float(p), float(s.r2)) for n, c, e, t, p in table],
        "term string, coef double, std_err double, t double, p double, r2 double")
