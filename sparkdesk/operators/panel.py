"""District x year panel: building, reading, trends, comparisons and sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.functions import templates as T
from sparkdesk.functions.cleaning import grouped, ratio_text, safe_ratio, share_pct
from sparkdesk.functions.metrics import PANEL_METRICS, SERIES_LABELS, USAGE_TRENDS, USAGE_TREND_ELSE, metric_table
from sparkdesk.functions.rules import first_match
from sparkdesk.functions.templates import fill

KEY = ["district", "year"]
USAGE = ["home_usage", "public_usage", "service_usage", "industry_usage"]
RATIOS = ["gas_supply_ratio", "home_ratio", "public_ratio", "service_ratio", "industry_ratio"]
FEATURES = ["total_resident_population", "total_households", *RATIOS]


def total_usage() -> Column:
    return sum((F.coalesce(c, F.lit(0)) for c in USAGE), F.lit(0))


def add_panel_ratios(panel: DataFrame) -> DataFrame:
    """Total usage, supply per household and the share of each kind."""
    out = panel.withColumn("total_usage", total_usage())
    out = out.withColumn("gas_supply_ratio", safe_ratio("gas_supply", "total_households"))
    for kind in ("home", "public", "service", "industry"):
        out = out.withColumn(f"{kind}_ratio", safe_ratio(f"{kind}_usage", "total_usage"))
    return out


def add_usage_per_head(panel: DataFrame) -> DataFrame:
    """Usage per person and per household."""
    return panel.withColumn("usage_per_person", safe_ratio("total_usage", "total_resident_population")).withColumn(
        "usage_per_household", safe_ratio("total_usage", "total_households")
    )


def build_panel(population: DataFrame, gas: DataFrame, register: DataFrame, electricity: DataFrame) -> DataFrame:
    """population x gas (must match) + register (may be missing) x electricity (must match)."""
    return (
        population.join(gas, KEY).join(register, KEY, "left").join(electricity, KEY)
        .withColumn("gas_supply_ratio", safe_ratio("gas_supply", "total_households"))
    )


def merge_supply(gas: DataFrame, income: DataFrame, people: DataFrame, year: int | None = None) -> DataFrame:
    """Gas, income and population of the same district and year; the year filter reaches every scan."""
    merged = gas.join(income, KEY).join(people, KEY)
    return merged if year is None else merged.where(F.col("year") == year)


def valid_supply(df: DataFrame) -> DataFrame:
    """Rows with usable numbers: positive income, people and households, supply not negative."""
    cols = ["gas_supply", "avg_income", "total_pop", "total_households"]
    typed = df.select(*[F.col(c).cast("string").try_cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    return typed.dropna(subset=cols).where(
        (F.col("avg_income") > 0) & (F.col("total_pop") > 0) & (F.col("total_households") > 0) & (F.col("gas_supply") >= 0)
    )


def add_supply_features(df: DataFrame) -> DataFrame:
    """Five per-head features."""
    return (
        df.withColumn("gas_supply_per_pop", F.col("gas_supply") / F.col("total_pop"))
        .withColumn("gas_supply_per_income", F.col("gas_supply") / F.col("avg_income"))
        .withColumn("pop_per_household", F.col("total_pop") / F.col("total_households"))
        .withColumn("income_per_household", F.col("avg_income") / F.col("total_households"))
        .withColumn("gas_supply_ratio", F.col("gas_supply") / F.col("total_households"))
    )


def attach_context(annual: DataFrame, *others: DataFrame) -> DataFrame:
    """Left joins of yearly context tables onto the annual means."""
    for other in others:
        annual = annual.join(other, KEY, "left")
    return annual


def trend_with_defaults(gas: DataFrame, people: DataFrame, income: DataFrame) -> DataFrame:
    """Supply series with population and income looked up, 0 where a year is missing."""
    cols = ("total_pop", "avg_income")
    joined = gas.join(people, KEY, "left").join(income, KEY, "left")
    return joined.select(*gas.columns, *[F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(c) for c in cols])


def read_panel(panel: DataFrame, year: int | None = None, district: str | None = None) -> DataFrame:
    """The panel in fixed order: all, one year, one district or one cell."""
    if year is not None:
        panel = panel.where(F.col("year") == year)
    if district is not None:
        panel = panel.where(F.col("district") == district)
    return panel.orderBy("year", "district")


def latest_year(panel: DataFrame) -> DataFrame:
    """Last year present per district."""
    return panel.groupBy("district").agg(F.max("year").alias("latest_year"))


def attach_clusters(features: DataFrame, assignments: DataFrame) -> DataFrame:
    """Features with their cluster, null where unassigned."""
    return features.join(assignments.select("year", "district", "cluster"), ["year", "district"], "left")


# --- city and KPI rows --------------------------------------------------------------------------
def city_totals(panel: DataFrame) -> DataFrame:
    """Sums over all districts per year and the mean per district."""
    sums = [*USAGE, "total_resident_population"]
    out = panel.groupBy("year").agg(*[F.sum(c).alias(c) for c in sums], F.countDistinct("district").alias("districts"))
    return out.withColumn("total_usage", total_usage()).withColumn(
        "usage_per_district", F.col("total_usage") / F.col("districts")
    )


def metric_totals(panel: DataFrame, metric: str) -> DataFrame:
    """Sum and mean of one metric per year."""
    return panel.groupBy("year").agg(F.sum(metric).alias("total"), F.avg(metric).alias("mean"))


def kpi_rows(panel: DataFrame) -> DataFrame:
    """Six KPI rows per record, nulls as 0, with label and unit."""
    cells = F.array(*[
        F.struct(
            F.lit(k).alias("key"), F.lit(lb).alias("label"),
            (total_usage() if k == "total_usage" else F.coalesce(k, F.lit(0))).cast("bigint").alias("value"),
            F.lit(u).alias("unit"),
        )
        for k, lb, u in SERIES_LABELS
    ])
    return panel.select(*KEY, F.inline(cells))


def cluster_kpi(profile: DataFrame) -> DataFrame:
    """Cluster means as (cluster, key, value) rows."""
    return profile.unpivot(["cluster"], FEATURES, "key", "value")


def trend_series(panel: DataFrame) -> DataFrame:
    """Total, four usage kinds and population as long series rows."""
    return kpi_rows(panel).select("district", "key", "label", "unit", "year", "value")


def with_catalogue(rows: DataFrame, metrics=PANEL_METRICS) -> DataFrame:
    """Label and unit of each metric key; unknown keys keep their name."""
    dim = F.broadcast(metric_table(rows.sparkSession, metrics))  # a literal of a dozen rows
    return rows.join(dim, "key", "left").withColumn("label", F.coalesce("label", "key")).withColumn(
        "unit", F.coalesce("unit", F.lit(""))
    )


# --- trends -----------------------------------------------------------------------------------
def first_last(panel: DataFrame, metric: str, population: str = "total_resident_population") -> DataFrame:
    """First and last year of a district: values, difference, percent, direction."""
    ends = panel.groupBy("district").agg(
        F.min("year").alias("start_year"), F.max("year").alias("end_year"),
        F.min_by(metric, "year").cast("double").alias("start_value"),
        F.max_by(metric, "year").cast("double").alias("end_value"),
        F.min_by(population, "year").alias("start_pop"),
        F.max_by(population, "year").alias("end_pop"),
    )
    diff = F.col("end_value") - F.col("start_value")
    return ends.select(
        "*", diff.alias("diff"),
        F.when(F.col("start_value") != 0, diff / F.col("start_value") * 100).otherwise(0.0).alias("diff_pct"),
    ).withColumn(
        "status",
        # fixed values: direction words
        first_match([(F.col("diff_pct") > 0, "증가"), (F.col("diff_pct") < 0, "감소")], "유지"),
    )


def trend_type(ends: DataFrame, names=USAGE_TRENDS, otherwise: str = USAGE_TREND_ELSE) -> DataFrame:
    """Joint direction of population and metric (B14), in the words of the panel at hand."""
    pop, val = F.signum((F.col("end_pop") - F.col("start_pop")).cast("double")), F.signum("diff")
    joint = first_match([((pop == p) & (val == v), name) for p, v, name in names], otherwise)
    pop_only = first_match([(pop > 0, "인구 증가"), (pop < 0, "인구 감소")], "인구 정체")
    return ends.withColumn("trend_type", joint).withColumn("population_trend", pop_only)


def year_over_year(panel: DataFrame, value: str) -> DataFrame:
    """Value with last year's value beside it, joined on the key, so no ordering is needed."""
    prev = panel.select("district", (F.col("year") + 1).alias("year"), F.col(value).alias("previous"))
    cur = panel.select("district", "year", F.col(value).alias("current"))
    return cur.join(prev, KEY, "left").withColumn(
        "yoy", (F.col("current") - F.col("previous")) / F.nullif(F.abs(F.col("previous").cast("double")), F.lit(0.0)) * 100
    )


def lag_correlation(panel: DataFrame, features: list[str]) -> DataFrame:
    """Correlation of each feature with its value one year later, per pair of years."""
    nxt = panel.select("district", (F.col("year") - 1).alias("year"), *[F.col(f).alias(f"n_{f}") for f in features])
    one = panel.select(*KEY, *features).join(nxt, KEY).groupBy("year").agg(
        *[F.corr(f, f"n_{f}").alias(f) for f in features]
    )
    return one.unpivot(["year"], features, "feature", "corr")


def lag_correlation_means(panel: DataFrame, features: list[str]) -> DataFrame:
    return lag_correlation(panel, features).groupBy("feature").agg(F.avg("corr").alias("mean_corr"))


def cluster_moves(assignments: DataFrame) -> DataFrame:
    """How many clusters each district visits, and whether it stays put."""
    return assignments.groupBy("district").agg(
        F.countDistinct("cluster").alias("n_clusters"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("year", "cluster"))), lambda x: x["cluster"].cast("string")), ">").alias("path"),
    ).withColumn("stable", F.col("n_clusters") == 1)


# --- comparisons --------------------------------------------------------------------------------
def compare_pairs(panel: DataFrame, pairs: DataFrame, metrics: list[str]) -> DataFrame:
    """Metric by metric comparison of given (year, district_a, district_b) rows."""
    side = lambda s: panel.select(
        "year", F.col("district").alias(f"district_{s}"), *[F.coalesce(F.col(m), F.lit(0)).cast("double").alias(f"{s}_{m}") for m in metrics]
    )
    wide = pairs.join(side("a"), ["year", "district_a"]).join(side("b"), ["year", "district_b"])
    rows = F.array(*[
        F.struct(F.lit(m).alias("key"), F.col(f"a_{m}").alias("value_a"), F.col(f"b_{m}").alias("value_b")) for m in metrics
    ])
    long = wide.select("year", "district_a", "district_b", F.inline(rows))
    gap = F.col("value_a") - F.col("value_b")
    return long.select(
        "year", "district_a", "district_b", "key",
        F.bround("value_a", 0).cast("bigint").alias("value_a"), F.bround("value_b", 0).cast("bigint").alias("value_b"),
        F.bround(F.abs(gap), 0).cast("bigint").alias("diff"),
        F.bround(F.coalesce(F.abs(gap / F.nullif("value_b", F.lit(0.0)) * 100), F.lit(0.0)), 2).alias("ratio_pct"),
        F.when(gap >= 0, F.col("district_a")).otherwise(F.col("district_b")).alias("higher"),
    )


# --- cluster labels and summaries ---------------------------------------------------------------
def cluster_label(cluster: Column, home: Column, public: Column, service: Column, industry: Column, pop: Column) -> Column:
    """Name of a cluster from its mean profile."""
    # fixed values: ordered thresholds and names
    rules = [
        (industry >= 0.10, "산업·서비스 혼재형"),
        ((industry >= 0.07) & (service >= 0.50), "서비스·산업 복합형"),
        ((home >= 0.40) & (public >= 0.10), "주거·공공 복합형"),
        (home >= 0.38, "주거 밀집형"),
        ((home >= 0.33) & (pop >= 500_000), "광역 주거·서비스형"),
        ((public >= 0.17) & (service >= 0.45), "공공·서비스 혼재형"),
        ((service >= 0.70) & (home < 0.15), "도심 상업 거점형"),
        ((service >= 0.65) & (pop >= 400_000), "광역 서비스 중심형"),
        (service >= 0.55, "서비스 중심형"),
    ]
    return first_match(rules, F.concat(F.lit("군집 "), cluster.cast("string")))


# Feature names used in cluster summaries.
FEATURE_NAMES = {
    "total_resident_population": "상주인구",
    "total_households": "가구수",
    "gas_supply_ratio": "가스 보급률",
    "home_ratio": "가정용 비율",
    "public_ratio": "공공용 비율",
    "service_ratio": "서비스업 비율",
    "industry_ratio": "산업용 비율",
}


def cluster_summary(profile: DataFrame, overall: DataFrame, features: list[str] = FEATURES, high: float = 1.15,
                    low: float = 0.85, keep: int = 3) -> DataFrame:
    """Which features of a cluster lie well above or below the overall mean, as text.

    ``overall`` is one row of means.
    """
    ratios = F.array(*[
        F.struct(F.lit(FEATURE_NAMES.get(f, f)).alias("name"),
                 (F.col(f) / F.nullif(overall.select(f).scalar(), F.lit(0.0))).alias("ratio"))
        for f in features
    ])
    named = lambda cond: F.array_join(F.slice(F.transform(F.filter(F.col("_r"), cond), lambda x: x["name"]), 1, keep), ", ")
    out = profile.withColumn("_r", ratios).withColumn("_hi", named(lambda x: x["ratio"] >= high)).withColumn(
        "_lo", named(lambda x: x["ratio"] <= low)
    )
    part = lambda c, word: F.when(F.col(c) != "", F.concat(F.lit(word), F.col(c)))
    text = F.concat_ws(" / ", part("_hi", "상대적으로 높은 항목: "), part("_lo", "상대적으로 낮은 항목: "))
    return out.withColumn("summary", F.when(text == "", "전체 평균과 유사한 복합형 군집").otherwise(text)).drop("_r", "_hi", "_lo")


# --- sentences ----------------------------------------------------------------------------------
def trend_fact(panel: DataFrame, metric: str, label: str, unit: str, is_ratio: bool = False) -> DataFrame:
    """Start to end sentence with one line per year."""
    show = ratio_text if is_ratio else (lambda c: grouped(c, unit))
    named = F.lit(label)
    line = fill(T.TREND_LINE, total=total_usage(), label=named, value=show(F.col(metric)), people=F.col("total_resident_population"))
    by_year = F.array_sort(F.collect_list(F.struct("year", line.alias("line"))))  # as long as the panel has years
    lines = panel.groupBy("district").agg(F.array_join(F.transform(by_year, lambda x: x["line"]), "\n").alias("detail"))
    fact = fill(T.TREND, label=named, first=show(F.col("start_value")), last=show(F.col("end_value")), percent=F.abs("diff_pct"))
    return first_last(panel, metric).join(lines, "district").select("district", fact.alias("fact"))


def comparison_fact(panel: DataFrame, pairs: DataFrame) -> DataFrame:
    """Two districts side by side, the higher one and the gap (B22). A district's half is written once, however many pairs it is in."""
    kinds = {c.removesuffix("_usage"): share_pct(c, "total_usage") for c in USAGE}
    halves = panel.select("year", "district", F.col("total_usage").alias("total"), fill(T.COMPARISON_SIDE, **kinds).alias("text"))
    half = lambda s: halves.select("year", *[F.col(c).alias(f"{c}_{s}") for c in ("district", "total", "text")])
    wide = pairs.join(half("a"), ["year", "district_a"]).join(half("b"), ["year", "district_b"])
    a, b = F.col("total_a"), F.col("total_b")
    gap, least = F.abs(a - b), F.least(a, b)
    fact = fill(T.COMPARISON, side_a=F.col("text_a"), side_b=F.col("text_b"), gap=gap, higher=F.when(a >= b, F.col("district_a")).otherwise(F.col("district_b")),
                percent=F.when(least > 0, F.bround(gap / least * 100, 1)).otherwise(0.0))
    return wide.select("year", "district_a", "district_b", fact.alias("fact"))


def cluster_fact(panel: DataFrame, labelled: DataFrame) -> DataFrame:
    """A district's cluster, usage and shares in a sentence; ``labelled`` has cluster and label per cell."""
    shares = {kind: F.col(f"{kind}_ratio") * 100 for kind in ("home", "service", "industry")}
    return panel.join(labelled, KEY).select(*KEY, fill(T.CLUSTER, total=total_usage(), **shares).alias("fact"))


def city_fact(panel: DataFrame, city: str = "") -> DataFrame:
    """Whole-city totals of a year in a sentence."""
    people = F.col("total_resident_population") / F.col("districts")
    return city_totals(panel).select("year", fill(T.CITY, city=F.lit(city), people_per_district=people).alias("fact"))
