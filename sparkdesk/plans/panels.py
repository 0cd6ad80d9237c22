"""Panel queries: cleaning, reshaping, joins, trends, comparisons, sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions import calendar as C
from sparkdesk.functions import cleaning as N
from sparkdesk.functions.metrics import CLUSTER_LABELS, PANEL_METRICS, SERIES_LABELS, SUPPLY_METRICS, SUPPLY_TREND_ELSE, SUPPLY_TRENDS, cluster_label_table
from sparkdesk.operators import dedup as U
from sparkdesk.operators import panel as P
from sparkdesk.operators import quantiles as Q
from sparkdesk.operators import reshape as R
from sparkdesk.plans.demand import r
from sparkdesk.plans.registry import query
from sparkdesk.plans.tables import ACCOUNTS, DAILY, FILINGS, MEASURE, PANEL, PANEL_FULL, VISITS, cents

FIRST, LAST = "(SELECT min(year) FROM panel)", "(SELECT max(year) FROM panel)"
KINDS = ("home", "public", "service", "industry")
FEATS = P.FEATURES
GROUPED = "CASE WHEN {0} IS NULL THEN '-' ELSE format('{{:,}}', {0}) END"

# income, people and context tables in SQL
SUPPLY = f"""{PANEL}, income AS (
  SELECT n_name AS district, CAST(year(o_orderdate) AS BIGINT) AS year,
    CAST(floor(sum(CAST(round(o_totalprice * 100) AS BIGINT)) / CAST(count(*) AS DOUBLE)) AS BIGINT) - 20000000 AS avg_income
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE year(o_orderdate) < (SELECT max(year) FROM panel) GROUP BY 1, 2),
  gas AS (SELECT district, year, gas_supply FROM panel),
  people AS (SELECT district, year, total_resident_population AS total_pop, total_households FROM panel WHERE year > {FIRST})"""


def years_of(t):
    """The years of the panel, for the heads of wide tables."""
    return [r[0] for r in t.panel.select("year").distinct().orderBy("year").collect()]


def first_year(t):
    return t.panel.agg(F.min("year")).scalar()


def last_year(t):
    return t.panel.agg(F.max("year")).scalar()


def income(t):
    """Mean order value less a constant, so that some incomes are not positive; none are known for the last year yet."""
    year = F.year("o_orderdate")
    per_customer = (
        t.orders.where(year < last_year(t)).groupBy("o_custkey", year.cast("bigint").alias("year"))
        .agg(F.sum(cents("o_totalprice")).alias("c"), F.count("*").alias("n"))
    )
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    return (
        per_customer.join(cust, "o_custkey").join(t.nation.select("n_nationkey", F.col("n_name").alias("district")), "n_nationkey")
        .groupBy("district", "year").agg((F.floor(F.sum("c") / F.sum("n")) - 20000000).alias("avg_income"))
    )


def gas(t):
    return t.panel.select("district", "year", "gas_supply")


def people(t):
    return t.panel.where(F.col("year") > first_year(t)).select(
        "district", "year", F.col("total_resident_population").alias("total_pop"), "total_households")


def wide_supply(t):
    """Published style: one text column per year, grouped digits, padded names and a subtotal row."""
    years = years_of(t)
    body = R.widen(t.panel, ["district"], "year", years, "gas_supply")
    total = body.agg(*[F.sum(str(y)).alias(str(y)) for y in years]).select(F.lit("소계").alias("district"), *map(str, years))
    rows = body.unionByName(total)
    return rows.select(F.concat(F.lit(" "), "district", F.lit("  ")).alias("district"),
                       *[F.coalesce(F.format_number(F.col(str(y)), 0), F.lit("-")).alias(f"{y}년") for y in years])


def assigned(t):
    """Panel cells with a cluster derived from their shares."""
    return t.panel_full.withColumn(
        "cluster", ((F.col("home_ratio") > F.col("public_ratio")).cast("int")
                    + 2 * (F.col("service_ratio") > F.col("industry_ratio")).cast("int")))


ASSIGNED = PANEL_FULL + """, assigned AS (SELECT *, CAST(home_ratio > public_ratio AS INTEGER)
  + 2 * CAST(service_ratio > industry_ratio AS INTEGER) AS cluster FROM panel_full)"""


def neighbours(t):
    """(year, district_a, district_b): each nation with the next one by key."""
    a = t.nation.select("n_nationkey", F.col("n_name").alias("district_a"))
    b = t.nation.select((F.col("n_nationkey") - 1).alias("n_nationkey"), F.col("n_name").alias("district_b"))
    years = F.explode(F.sequence(first_year(t), last_year(t)))
    return a.join(b, "n_nationkey").select(years.alias("year"), "district_a", "district_b")


PAIRS = """pairs AS (SELECT y AS year, a.n_name AS district_a, b.n_name AS district_b
  FROM nation a JOIN nation b ON b.n_nationkey = a.n_nationkey + 1, (SELECT DISTINCT year AS y FROM panel))"""


# --- reshaping and cleaning ---------------------------------------------------------------------
@query("p05_melt_years", f"""WITH {PANEL} SELECT district, year, CAST(gas_supply AS DOUBLE) AS gas_supply FROM panel UNION ALL
  SELECT d.district, y.year, 0.0 FROM (SELECT DISTINCT district FROM panel) d CROSS JOIN (SELECT DISTINCT year FROM panel) y
  WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.district = d.district AND p.year = y.year)""")
def _(t):
    wide = R.drop_subtotals(wide_supply(t), "district")
    return R.melt_years(wide, "district", [c for c in wide.columns if c.endswith("년")], "gas_supply")  # a dash is a zero


def month_wide(t):
    named = t.measure.withColumn("ym", F.format_string("%d. %02d월", "year", "month"))
    months = [r[0] for r in named.select("ym").distinct().orderBy("ym").collect()]
    return R.widen(named, ["district"], "ym", months, "value")


@query("p06_melt_months", f"WITH {MEASURE} SELECT district, printf('%d. %02d월', year, month) AS ym, round(value, 6) AS value FROM measure")
def _(t):
    return r(R.melt_matching(month_wide(t), "district", "월", "ym", "value").where("value IS NOT NULL"))


@query("p07_melt_blocks", f"""WITH {PANEL} SELECT district, year, CAST(home_usage AS DOUBLE) AS home_usage, CAST(public_usage AS DOUBLE) AS public_usage,
  CAST(service_usage AS DOUBLE) AS service_usage, CAST(industry_usage AS DOUBLE) AS industry_usage FROM panel""")
def _(t):
    years = years_of(t)
    wide = t.panel.groupBy("district").pivot("year", years).agg(
        *[F.format_number(F.first(c), 0).alias(c) for c in P.USAGE])
    blocks = {y: [f"{y}_{c}" for c in P.USAGE] for y in years}
    return R.melt_blocks(wide, "district", blocks, P.USAGE).dropna()


@query("p08_widen_first", f"""WITH {PANEL} SELECT d.district, y.year, p.gas_supply FROM (SELECT DISTINCT district FROM panel) d
  CROSS JOIN (SELECT DISTINCT year FROM panel) y LEFT JOIN panel p ON p.district = d.district AND p.year = y.year""")
def _(t):
    years = years_of(t)
    wide = R.widen(t.panel, ["district"], "year", years, "gas_supply")  # compared cell by cell, empty ones too
    cells = F.array(*[F.struct(F.lit(y).cast("bigint").alias("year"), F.col(str(y)).alias("gas_supply")) for y in years])
    return wide.select("district", F.inline(cells))


@query("p09_clean_number", """SELECT o_orderkey, floor(o_totalprice) AS plain,
  CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE -floor(o_totalprice) END AS dashed,
  CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE floor(o_totalprice) END AS every_dash FROM orders""")
def _(t):
    text = F.concat(F.lit(" "), F.format_number(F.floor("o_totalprice"), 0))
    dashed = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.concat(F.lit("-"), F.format_number(F.floor("o_totalprice"), 0)))
    return t.orders.select("o_orderkey", N.clean_number(text).alias("plain"), N.clean_number(dashed).alias("dashed"),
                           N.clean_number(dashed, every_dash=True).alias("every_dash"))


STATEMENT_CELLS = " UNION ALL ".join(
    f"SELECT a.corp_code, a.year, CAST({i} AS BIGINT) AS pos, CAST(a.{k} AS DOUBLE) AS cur, CAST(p.{k} AS DOUBLE) AS prev "
    f"FROM accounts a LEFT JOIN accounts p ON p.corp_code = a.corp_code AND p.year = a.year - 1"
    for i, k in enumerate(["revenue", "operating_profit", "net_income", "total_assets", "total_liabilities", "total_equity"])
)


@query("p10_parse_money", f"WITH {ACCOUNTS} {STATEMENT_CELLS}")
def _(t):
    return t.statement_lines.select("corp_code", "year", "pos", N.parse_money("thstrm_amount").alias("cur"),
                                    N.parse_money("frmtrm_amount").alias("prev"))


@query("p11_safe_ratio", f"""WITH {ACCOUNTS} SELECT corp_code, year, round(net_income / CAST(nullif(total_equity, 0) AS DOUBLE), 6) AS roe,
  round(revenue / CAST(nullif(total_liabilities, 0) AS DOUBLE), 6) AS turnover FROM accounts""")
def _(t):
    return t.accounts_wide.select("corp_code", "year", N.safe_ratio("net_income", "total_equity").alias("roe"),
                                  N.safe_ratio("revenue", "total_liabilities").alias("turnover"))


@query("p12_drop_subtotals", f"WITH {PANEL} SELECT DISTINCT district FROM panel")
def _(t):
    return R.drop_subtotals(wide_supply(t), "district").select("district")


@query("p12_keep_suffix", f"WITH {PANEL} SELECT DISTINCT district FROM panel WHERE district LIKE '%1'")
def _(t):
    return R.drop_subtotals(wide_supply(t), "district", suffix="1").select("district")


@query("p13_quarter_code", """SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(quarter(o_orderdate) AS BIGINT) AS quarter, count(*) AS n
  FROM orders WHERE quarter(o_orderdate) = 4 GROUP BY 1, 2""")
def _(t):
    code = F.concat(F.year("o_orderdate").cast("string"), F.quarter("o_orderdate").cast("string")).alias("code")
    year, quarter = C.quarter_code("code")
    rows = t.orders.select(code).select(year.alias("year"), quarter.alias("quarter"))
    return rows.where("quarter = 4").groupBy("year", "quarter").agg(F.count("*").alias("n"))


@query("p14_period_text", f"WITH {MEASURE} SELECT district, year, month FROM measure")
def _(t):
    long = R.melt_matching(month_wide(t), "district", "월", "ym", "value").where("value IS NOT NULL")
    year, month = C.period_from_text("ym")
    return long.select("district", year.alias("year"), month.alias("month"))


SEASON = "CASE WHEN month BETWEEN 3 AND 5 THEN 'spring' WHEN month BETWEEN 6 AND 8 THEN 'summer' WHEN month BETWEEN 9 AND 11 THEN 'autumn' ELSE 'winter' END"


@query("p15_season", f"WITH {MEASURE} SELECT {SEASON} AS season, count(*) AS n, round(avg(value), 6) AS mean FROM measure GROUP BY 1")
def _(t):
    return r(t.measure.groupBy(C.season("month").alias("season")).agg(F.count("*").alias("n"), F.avg("value").alias("mean")))


@query("p21_valid_supply", f"""WITH {SUPPLY} SELECT district, year, CAST(gas_supply AS DOUBLE) AS gas_supply, CAST(avg_income AS DOUBLE) AS avg_income,
  CAST(total_pop AS DOUBLE) AS total_pop, CAST(total_households AS DOUBLE) AS total_households
  FROM gas JOIN income USING (district, year) JOIN people USING (district, year) WHERE avg_income > 0""")
def _(t):
    return P.valid_supply(P.merge_supply(gas(t), income(t), people(t)))


@query("p22_supply_features", f"""WITH {SUPPLY} SELECT district, year, round(gas_supply / CAST(total_pop AS DOUBLE), 6) AS gas_supply_per_pop,
  round(gas_supply / CAST(avg_income AS DOUBLE), 9) AS gas_supply_per_income, round(total_pop / CAST(total_households AS DOUBLE), 6) AS pop_per_household,
  round(avg_income / CAST(total_households AS DOUBLE), 4) AS income_per_household, round(gas_supply / CAST(total_households AS DOUBLE), 6) AS gas_supply_ratio
  FROM gas JOIN income USING (district, year) JOIN people USING (district, year) WHERE avg_income > 0""")
def _(t):
    df = P.add_supply_features(P.valid_supply(P.merge_supply(gas(t), income(t), people(t))))
    df = r(df, 6, "gas_supply_per_pop", "pop_per_household", "gas_supply_ratio")
    return r(r(df, 9, "gas_supply_per_income"), 4, "income_per_household").select(
        "district", "year", "gas_supply_per_pop", "gas_supply_per_income", "pop_per_household", "income_per_household", "gas_supply_ratio")


@query("p23_usage_shares", f"""WITH {PANEL_FULL} SELECT district, year, total_usage, home_ratio, public_ratio, service_ratio, industry_ratio, gas_supply_ratio,
  round(total_usage / CAST(total_resident_population AS DOUBLE), 6) AS usage_per_person,
  round(total_usage / CAST(total_households AS DOUBLE), 6) AS usage_per_household FROM panel_full""")
def _(t):
    return P.add_usage_per_head(t.panel_full).select(
        "district", "year", "total_usage", *[f"{k}_ratio" for k in KINDS], "gas_supply_ratio", "usage_per_person", "usage_per_household")


@query("p24_share_pct", f"""WITH {PANEL_FULL} SELECT district, year, {", ".join(f"CASE WHEN total_usage > 0 THEN round_even({k}_usage / CAST(total_usage AS DOUBLE) * 100, 1) ELSE 0.0 END AS {k}_pct" for k in KINDS)} FROM panel_full""")
def _(t):
    return t.panel_full.select("district", "year", *[N.share_pct(f"{k}_usage", "total_usage").alias(f"{k}_pct") for k in KINDS])


@query("p25_amount_text", f"""WITH {ACCOUNTS}, v AS (SELECT corp_code, year, operating_profit * 1000 AS x FROM accounts)
  SELECT corp_code, year, CASE WHEN x < 0 THEN '-' ELSE '' END || CASE WHEN abs(x) >= 1000000000000 THEN printf('%.2f', round_even(abs(x) / 1e12, 2)) || '조원'
    WHEN abs(x) >= 100000000 THEN printf('%.2f', round_even(abs(x) / 1e8, 2)) || '억원' ELSE format('{{:,}}', abs(x)) || '원' END AS amount FROM v""")
def _(t):
    return t.accounts_wide.select("corp_code", "year", N.amount_text(F.col("operating_profit") * 1000).alias("amount"))


@query("p26_number_text", f"""WITH {PANEL_FULL} SELECT district, year, format('{{:,}}', total_usage) || 'MWh' AS usage_text,
  printf('%.4f', round_even(home_ratio, 4)) AS ratio_text, {GROUPED.format("CASE WHEN year = (SELECT min(year) FROM panel) THEN NULL ELSE gas_supply END")} AS gap_text FROM panel_full""")
def _(t):
    return t.panel_full.select("district", "year", N.grouped("total_usage", "MWh").alias("usage_text"), N.ratio_text("home_ratio").alias("ratio_text"),
                               N.grouped(F.when(F.col("year") != first_year(t), F.col("gas_supply"))).alias("gap_text"))


_CAT = ", ".join(f"('{k}', '{l}', '{u}')" for k, l, u in PANEL_METRICS)


@query("p27_metric_catalogue", f"""WITH {PANEL_FULL}, cat(key, label, unit) AS (VALUES {_CAT}),
  long AS ({" UNION ALL ".join(f"SELECT district, year, '{k}' AS key, round(CAST({k} AS DOUBLE), 6) AS value FROM panel_full" for k in (*FEATS, "total_usage"))})
  SELECT l.key, l.district, l.year, l.value, coalesce(c.label, l.key) AS label, coalesce(c.unit, '') AS unit FROM long l LEFT JOIN cat c USING (key)""")
def _(t):
    cols = [*FEATS, "total_usage"]
    long = t.panel_full.select("district", "year", *[F.col(c).cast("double") for c in cols]).unpivot(["district", "year"], cols, "key", "value")
    return r(P.with_catalogue(long))


@query("p31_panel_read", f"WITH {PANEL_FULL} SELECT district, year, total_usage, gas_supply, home_ratio FROM panel_full ORDER BY year, district")
def _(t):
    return P.read_panel(t.panel_full).select("district", "year", "total_usage", "gas_supply", "home_ratio")


@query("p31_panel_read_year", f"WITH {PANEL_FULL} SELECT district, year, total_usage, gas_supply, home_ratio FROM panel_full WHERE year = 1999 ORDER BY district")
def _(t):
    return P.read_panel(t.panel_full, year=1999).select("district", "year", "total_usage", "gas_supply", "home_ratio")


# --- joins and set operations ---------------------------------------------------------------------
@query("j01_build_panel", f"""WITH {PANEL} SELECT p.district, p.year, p.total_resident_population, p.total_households, p.gas_supply,
  CASE WHEN p.year > {FIRST} THEN p.gas_supply END AS register_total, p.home_usage, p.public_usage, p.service_usage, p.industry_usage,
  round(p.gas_supply / CAST(p.total_households AS DOUBLE), 6) AS gas_supply_ratio FROM panel p WHERE p.year <> {LAST}""")
def _(t):
    pop = t.panel.select("district", "year", "total_resident_population", "total_households")
    register = t.panel.where(F.col("year") > first_year(t)).select("district", "year", F.col("gas_supply").alias("register_total"))
    electricity = t.panel.where(F.col("year") != last_year(t)).select("district", "year", *P.USAGE)
    return P.build_panel(pop, gas(t), register, electricity)


@query("j02_merge_supply", f"""WITH {SUPPLY} SELECT district, year, gas_supply, avg_income, total_pop, total_households
  FROM gas JOIN income USING (district, year) JOIN people USING (district, year) WHERE year = 1999""")
def _(t):
    return P.merge_supply(gas(t), income(t), people(t), 1999)


ANNUAL = """annual AS (SELECT district, year, avg(value) AS value FROM measure GROUP BY 1, 2)"""


def annual(t):
    return t.measure.groupBy("district", "year").agg(F.avg("value").alias("value"))


@query("j03_attach_context", f"""WITH {MEASURE}, {ANNUAL}, {PANEL_FULL} SELECT a.district, a.year, round(a.value, 6) AS value, g.home_usage / 1000000.0 AS green,
  k.service_ratio AS park FROM annual a LEFT JOIN (SELECT * FROM panel_full WHERE year > {FIRST}) g USING (district, year)
  LEFT JOIN (SELECT * FROM panel_full WHERE year < {LAST}) k USING (district, year)""")
def _(t):
    green = t.panel_full.where(F.col("year") > first_year(t)).select("district", "year", (F.col("home_usage") / 1e6).alias("green"))
    park = t.panel_full.where(F.col("year") < last_year(t)).select("district", "year", F.col("service_ratio").alias("park"))
    return r(P.attach_context(annual(t), green, park), 6, "value")


@query("j04_trend_defaults", f"""WITH {SUPPLY} SELECT g.district, g.year, g.gas_supply, coalesce(total_pop, 0) AS total_pop, coalesce(avg_income, 0) AS avg_income
  FROM gas g LEFT JOIN people USING (district, year) LEFT JOIN income USING (district, year)""")
def _(t):
    return P.trend_with_defaults(gas(t), people(t), income(t))


@query("j07_missing_days", f"""WITH {DAILY}, b AS (SELECT station, min(use_ymd) AS lo, max(use_ymd) AS hi FROM daily GROUP BY 1)
  SELECT station, strftime(d, '%Y-%m-%d') AS day FROM (SELECT station, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM b)
  WHERE (station, CAST(d AS DATE)) NOT IN (SELECT station, use_ymd FROM daily)""")
def _(t):
    bounds = t.daily.groupBy("station").agg(F.min("use_ymd").alias("lo"), F.max("use_ymd").alias("hi"))
    missing = R.missing_periods(R.date_spine(bounds, "lo", "hi", name="use_ymd"), t.daily, ["station", "use_ymd"])
    return missing.select("station", F.date_format("use_ymd", "yyyy-MM-dd").alias("day"))


@query("j07_missing_months", f"""WITH {DAILY}, b AS (SELECT station, line, date_trunc('month', min(use_ymd)) AS lo, max(use_ymd) AS hi FROM daily GROUP BY 1, 2)
  SELECT station, line, m AS use_mm FROM (SELECT station, line, strftime(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)), '%Y%m') AS m FROM b)
  WHERE (station, line, m) NOT IN (SELECT station, line, strftime(use_ymd, '%Y%m') FROM daily)""")
def _(t):
    bounds = t.daily.groupBy("station", "line").agg(F.trunc(F.min("use_ymd"), "month").alias("lo"), F.max("use_ymd").alias("hi"))
    spine = R.date_spine(bounds, "lo", "hi", "1 month").select("station", "line", F.date_format("day", "yyyyMM").alias("use_mm"))
    stored = t.daily.select("station", "line", F.date_format("use_ymd", "yyyyMM").alias("use_mm"))
    return R.missing_periods(spine, stored, ["station", "line", "use_mm"])


@query("j08_date_spine", """SELECT strftime(d, '%Y-%m-%d') AS day FROM (SELECT unnest(generate_series(date_trunc('day', min(o_orderdate)),
  max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def _(t):
    ends = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return R.date_spine(ends, "lo", "hi").select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("j08_month_spine", """SELECT strftime(d, '%Y-%m') AS month FROM (SELECT unnest(generate_series(date_trunc('month', CAST(min(o_orderdate) AS TIMESTAMP)),
  max(o_orderdate), INTERVAL 1 MONTH)) AS d FROM orders)""")
def _(t):
    ends = t.orders.agg(F.trunc(F.min("o_orderdate"), "month").alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return R.date_spine(ends, "lo", "hi", "1 month").select(F.date_format("day", "yyyy-MM").alias("month"))


@query("j09_missing_cells", f"""WITH {VISITS}, c AS (SELECT DISTINCT station, CAST(year(use_ymd) AS BIGINT) AS year FROM visits)
  SELECT s.station, y.year FROM (SELECT DISTINCT station FROM c) s CROSS JOIN (SELECT DISTINCT year FROM c) y
  WHERE (s.station, y.year) NOT IN (SELECT station, year FROM c)""")
def _(t):
    return R.missing_combinations(t.visits.select("station", F.year("use_ymd").cast("bigint").alias("year")), "station", "year")


@query("j09_district_days", """WITH c AS (SELECT DISTINCT n_name AS district, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
  SELECT s.district, strftime(y.day, '%Y-%m-%d') AS day FROM (SELECT DISTINCT district FROM c) s CROSS JOIN (SELECT DISTINCT day FROM c) y
  WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.district = s.district AND c.day = y.day)""")
def _(t):
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")).join(
        t.nation.select("n_nationkey", F.col("n_name").alias("district")), "n_nationkey")
    days = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day")).join(cust, "o_custkey")
    return R.missing_combinations(days, "district", "day").select("district", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("j16_union_frames", f"""WITH {PANEL} SELECT 'home' AS kind, district, year, home_usage AS usage FROM panel
  UNION ALL SELECT 'public', district, year, public_usage FROM panel UNION ALL SELECT 'service', district, year, service_usage FROM panel
  UNION ALL SELECT 'industry', district, year, industry_usage FROM panel""")
def _(t):
    frames = [t.panel.select(F.lit(k).alias("kind"), "district", "year", F.col(f"{k}_usage").alias("usage")) for k in KINDS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("j18_dedup_first", f"""WITH {FILINGS} SELECT md5(text) AS text_key, min(rcept_no) AS rcept_no FROM filings GROUP BY md5(text)""")
def _(t):
    rows = t.filings.select(F.md5("text").alias("text_key"), "rcept_no")
    return U.dedup_by_source([rows.where("rcept_no >= 0"), rows], ["text_key"], "rcept_no")


@query("j19_dedup_trimmed", "SELECT DISTINCT trim(source) AS title, trim(text, ' ') AS content FROM documents")
def _(t):
    padded = t.documents.select("doc_id", F.concat(F.lit(" "), "source").alias("title"), F.concat("text", F.lit("  ")).alias("content"))
    return U.dedup_trimmed(padded.unionByName(padded), ["title", "content"])


@query("j20_duplicate_report", "SELECT count(*) AS n_rows, count(DISTINCT text) AS n_keys, count(*) - count(DISTINCT text) AS n_duplicates FROM documents")
def _(t):
    return U.duplicate_report(t.documents.select(F.sha2("text", 256).alias("k")), ["k"])


@query("j21_distinct_in_order", r"""SELECT conv_id, turn, array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
  lambda p: list_position(w, p[1]) = p[2]), lambda p: p[1]), ' ') AS words
  FROM (SELECT conv_id, turn, regexp_split_to_array(lower(text), '\s+') AS w FROM conversations)""")
def _(t):
    return t.conversations.select("conv_id", "turn", F.array_join(F.array_distinct(F.split(F.lower("text"), r"\s+")), " ").alias("words"))


@query("j22_common_keys", f"""WITH {PANEL_FULL}, {MEASURE} SELECT district FROM measure GROUP BY 1 HAVING avg(value) > 25.5 INTERSECT
  SELECT district FROM panel_full GROUP BY 1 HAVING avg(home_ratio) > 0.32""")
def _(t):
    a = t.measure.groupBy("district").agg(F.avg("value").alias("v")).where("v > 25.5")
    b = t.panel_full.groupBy("district").agg(F.avg("home_ratio").alias("v")).where("v > 0.32")
    return R.common_keys(a, b, "district")


@query("j23_attach_clusters", f"""WITH {ASSIGNED} SELECT p.district, p.year, p.home_ratio, a.cluster FROM panel_full p
  LEFT JOIN (SELECT * FROM assigned WHERE year < {LAST}) a USING (district, year)""")
def _(t):
    return P.attach_clusters(t.panel_full, assigned(t).where(F.col("year") < last_year(t))).select("district", "year", "home_ratio", "cluster")


# --- aggregates -----------------------------------------------------------------------------------
@query("a17_city_totals", f"""WITH {PANEL_FULL} SELECT year, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in (*P.USAGE, "total_resident_population", "total_usage"))},
  count(DISTINCT district) AS districts, round(sum(total_usage) / CAST(count(DISTINCT district) AS DOUBLE), 4) AS usage_per_district FROM panel_full GROUP BY 1""")
def _(t):
    return r(P.city_totals(t.panel), 4)


@query("a17_metric_totals", f"WITH {PANEL} SELECT year, CAST(sum(gas_supply) AS BIGINT) AS total, round(avg(gas_supply), 6) AS mean FROM panel GROUP BY 1")
def _(t):
    return r(P.metric_totals(t.panel, "gas_supply"))


_KPI = " UNION ALL ".join(
    f"SELECT district, year, '{k}' AS key, '{lb}' AS label, CAST({k} AS BIGINT) AS value, '{u}' AS unit FROM panel_full" for k, lb, u in SERIES_LABELS)


@query("a18_kpi_rows", f"WITH {PANEL_FULL} {_KPI}")
def _(t):
    return P.kpi_rows(t.panel)


@query("a19_annual_means", f"""WITH {MEASURE}, {ANNUAL} SELECT 'district' AS level, district, year, CAST(NULL AS BIGINT) AS month, round(value, 6) AS value FROM annual
  UNION ALL SELECT 'month', NULL, year, month, round(avg(value), 6) FROM measure GROUP BY year, month
  UNION ALL SELECT 'year', NULL, year, NULL, round(avg(m), 6) FROM (SELECT year, month, avg(value) AS m FROM measure GROUP BY 1, 2) GROUP BY year""")
def _(t):
    months = t.measure.groupBy("year", "month").agg(F.avg("value").alias("value"))
    empty = F.lit(None)
    city_month = months.select(F.lit("month").alias("level"), empty.cast("string").alias("district"), "year", "month", "value")
    city_year = months.groupBy("year").agg(F.avg("value").alias("value")).select(
        F.lit("year").alias("level"), empty.cast("string").alias("district"), "year", empty.cast("bigint").alias("month"), "value")
    by_district = annual(t).select(F.lit("district").alias("level"), "district", "year", empty.cast("bigint").alias("month"), "value")
    return r(by_district.unionByName(city_month).unionByName(city_year))


@query("a20_above_median", f"""WITH {MEASURE}, {ANNUAL}, m AS (SELECT district, avg(value) AS mean FROM annual GROUP BY 1)
  SELECT district, round(mean, 6) AS mean, mean > (SELECT median(mean) FROM m) AS above FROM m""")
def _(t):
    means = annual(t).groupBy("district").agg(F.avg("value").alias("mean"))
    middle = Q.exact_median(means, [], "mean").select("median").scalar()
    return r(means.select("district", "mean", (F.col("mean") > middle).alias("above")))


@query("a21_value_counts", "SELECT lang, count(*) AS n FROM documents GROUP BY 1")
def _(t):
    return R.value_counts(t.documents, "lang")


@query("a21_imbalance", "SELECT max(n) AS largest, min(n) AS smallest, round(max(n) / CAST(min(n) AS DOUBLE), 6) AS ratio FROM (SELECT count(*) AS n FROM documents GROUP BY lang)")
def _(t):
    return r(R.imbalance(t.documents, "lang"))


def _describe_sql(group, value, table):
    return f"""SELECT {group}, count({value}) AS count, round(avg({value}), 4) AS mean, round(stddev_samp({value}), 4) AS std,
      round(CAST(min({value}) AS DOUBLE), 4) AS min, round(CAST(max({value}) AS DOUBLE), 4) AS max, round(quantile_cont(CAST({value} AS DOUBLE), 0.25), 4) AS q25,
      round(quantile_cont(CAST({value} AS DOUBLE), 0.5), 4) AS q50, round(quantile_cont(CAST({value} AS DOUBLE), 0.75), 4) AS q75 FROM {table} GROUP BY {group}"""


@query("a22_describe_by_label", _describe_sql("lang", "n_chars", "documents"))
def _(t):
    return r(Q.describe(t.documents, ["lang"], "n_chars"), 4)


@query("a22_describe_amounts", _describe_sql("l_returnflag", "l_extendedprice", "lineitem"))
def _(t):
    return r(Q.describe(t.lineitem, ["l_returnflag"], "l_extendedprice"), 4)


@query("a22_season_quartiles", f"""WITH {MEASURE}, s AS (SELECT {SEASON} AS season, value FROM measure) {_describe_sql("season", "value", "s")}""")
def _(t):
    return r(Q.describe(t.measure.select(C.season("month").alias("season"), "value"), ["season"], "value"), 4)


@query("a23_null_counts", """WITH j AS (SELECT d.doc_id, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
  SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS nulls FROM j UNION ALL SELECT 'text', count(*) - count(text) FROM j
  UNION ALL SELECT 'quality', count(*) - count(quality) FROM j UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM j""")
def _(t):
    return R.null_counts(t.documents.select("doc_id", "text").join(t.labels, "doc_id", "left"))


@query("a24_histogram", """WITH e AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents)
  SELECT CAST(least(floor((n_chars - lo) / ((hi - lo) / 20.0)) + 1, 20) AS BIGINT) AS bin, count(*) AS n FROM documents, e GROUP BY 1""")
def _(t):
    return R.histogram(t.documents, "n_chars", 20)


@query("a25_success_rate", """SELECT lang, count(*) AS n, count(*) FILTER (WHERE length(text) > 500) AS passed,
  round(avg(CASE WHEN length(text) > 500 THEN 1.0 ELSE 0.0 END), 6) AS rate FROM documents GROUP BY 1""")
def _(t):
    return r(R.success_rate(t.documents, "lang", F.length("text") > 500))


@query("a30_reconcile", f"""WITH {PANEL_FULL} SELECT count(*) AS n_rows, CAST(max(abs(home_usage + public_usage + service_usage - total_usage)) AS DOUBLE) AS max_gap,
  max(abs(home_usage + public_usage + service_usage - total_usage)) < 100 AS passed FROM panel_full""")
def _(t):
    return R.reconcile(t.panel, t.panel_full, P.KEY, ["home_usage", "public_usage", "service_usage"], "total_usage")


@query("a31_latest_year", f"WITH {PANEL} SELECT district, max(year) AS latest_year FROM panel GROUP BY 1")
def _(t):
    return P.latest_year(t.panel)


def profile(t):
    return assigned(t).groupBy("cluster").agg(*[F.avg(f).alias(f) for f in FEATS])


PROFILE = f"profile AS (SELECT cluster, {', '.join(f'avg({f}) AS {f}' for f in FEATS)} FROM assigned GROUP BY 1)"


@query("a33_cluster_kpi", f"""WITH {ASSIGNED}, {PROFILE} {" UNION ALL ".join(f"SELECT cluster, '{f}' AS key, round({f}, 4) AS value FROM profile" for f in FEATS)}""")
def _(t):
    return r(P.cluster_kpi(profile(t)), 4)


# --- trends ---------------------------------------------------------------------------------------
ENDS = """ends AS (SELECT *, end_value - start_value AS diff, CASE WHEN start_value <> 0 THEN (end_value - start_value) / start_value * 100 ELSE 0.0 END AS diff_pct FROM (
  SELECT district, min(year) AS start_year, max(year) AS end_year, CAST(arg_min(total_usage, year) AS DOUBLE) AS start_value,
  CAST(arg_max(total_usage, year) AS DOUBLE) AS end_value, arg_min(total_resident_population, year) AS start_pop,
  arg_max(total_resident_population, year) AS end_pop FROM panel_full GROUP BY 1))"""
STATUS = "CASE WHEN diff_pct > 0 THEN '증가' WHEN diff_pct < 0 THEN '감소' ELSE '유지' END"


@query("w07_first_last", f"""WITH {PANEL_FULL}, {ENDS} SELECT district, start_year, end_year, start_value, end_value, start_pop, end_pop, diff,
  round(diff_pct, 6) AS diff_pct, {STATUS} AS status FROM ends""")
def _(t):
    return r(P.first_last(t.panel_full, "total_usage"), 6, "diff_pct")


@query("b14_trend_type", f"""WITH {PANEL_FULL}, {ENDS} SELECT district,
  CASE WHEN end_pop < start_pop AND diff > 0 THEN '인구 감소와 사용량 증가' WHEN end_pop > start_pop AND diff < 0 THEN '인구 증가와 사용량 감소'
       WHEN end_pop < start_pop AND diff < 0 THEN '동반 감소' WHEN end_pop > start_pop AND diff > 0 THEN '동반 증가' ELSE '정체' END AS trend_type,
  CASE WHEN end_pop > start_pop THEN '인구 증가' WHEN end_pop < start_pop THEN '인구 감소' ELSE '인구 정체' END AS population_trend FROM ends""")
def _(t):
    return P.trend_type(P.first_last(t.panel_full, "total_usage")).select("district", "trend_type", "population_trend")


_MERGED = f"""{SUPPLY}, supply AS (SELECT district, year, gas_supply, avg_income, total_pop, total_households FROM gas JOIN income USING (district, year) JOIN people USING (district, year))"""


@query("b14_supply_trend", f"""WITH {_MERGED}, e AS (SELECT district, arg_max(total_pop, year) - arg_min(total_pop, year) AS pop, arg_max(gas_supply, year) - arg_min(gas_supply, year) AS gas FROM supply GROUP BY 1)
  SELECT district, CASE WHEN pop < 0 AND gas > 0 THEN '인구 감소와 수급 증가' WHEN pop > 0 AND gas < 0 THEN '인구 증가와 수급 감소' WHEN pop < 0 AND gas < 0 THEN '동반 감소'
    WHEN pop > 0 AND gas > 0 THEN '동반 증가' ELSE '정체와 수급 증가' END AS trend_type FROM e""")
def _(t):
    ends = P.first_last(P.merge_supply(gas(t), income(t), people(t)), "gas_supply", "total_pop")
    return P.trend_type(ends, SUPPLY_TRENDS, SUPPLY_TREND_ELSE).select("district", "trend_type")


_SUPPLY_CAT = ", ".join(f"('{k}', '{label}', '{unit}')" for k, label, unit in SUPPLY_METRICS)
_SUPPLY_KEYS = ("gas_supply", "avg_income", "total_pop", "total_households")


@query("p27_supply_catalogue", f"""WITH {_MERGED}, cat(key, label, unit) AS (VALUES {_SUPPLY_CAT}),
  long AS ({" UNION ALL ".join(f"SELECT district, year, '{k}' AS key, CAST({k} AS DOUBLE) AS value FROM supply" for k in _SUPPLY_KEYS)}
    UNION ALL SELECT district, year, 'gas_per_pop', round(gas_supply / CAST(total_pop AS DOUBLE), 6) FROM supply)
  SELECT district, year, key, value, coalesce(label, key) AS label, coalesce(unit, '') AS unit FROM long LEFT JOIN cat USING (key)""")
def _(t):
    cols = [*_SUPPLY_KEYS, "gas_per_pop"]
    wide = P.merge_supply(gas(t), income(t), people(t)).withColumn("gas_per_pop", F.round(F.col("gas_supply") / F.col("total_pop"), 6))
    long = wide.select("district", "year", *[F.col(c).cast("double") for c in cols]).unpivot(["district", "year"], cols, "key", "value")
    return P.with_catalogue(long, SUPPLY_METRICS)


@query("w08_year_over_year", f"""WITH {PANEL_FULL} SELECT c.district, c.year, c.total_usage AS current, p.total_usage AS previous,
  round((c.total_usage - p.total_usage) / CAST(nullif(abs(p.total_usage), 0) AS DOUBLE) * 100, 6) AS yoy
  FROM panel_full c LEFT JOIN panel_full p ON p.district = c.district AND p.year = c.year - 1""")
def _(t):
    return r(P.year_over_year(t.panel_full, "total_usage"), 6, "yoy")


LAG_FEATS = ["home_ratio", "service_ratio", "industry_ratio", "total_resident_population"]
_LAG = " UNION ALL ".join(
    f"SELECT a.year, '{f}' AS feature, corr(a.{f}, b.{f}) AS corr FROM panel_full a JOIN panel_full b ON a.district = b.district AND b.year = a.year + 1 GROUP BY 1"
    for f in LAG_FEATS)


@query("w09_lag_correlation", f"WITH {PANEL_FULL}, lag AS ({_LAG}) SELECT year, feature, round(corr, 6) AS corr FROM lag")
def _(t):
    return r(P.lag_correlation(t.panel_full, LAG_FEATS))


@query("w09_lag_means", f"WITH {PANEL_FULL}, lag AS ({_LAG}) SELECT feature, round(avg(corr), 6) AS mean_corr FROM lag GROUP BY 1")
def _(t):
    return r(P.lag_correlation_means(t.panel_full, LAG_FEATS))


@query("w10_cluster_moves", f"""WITH {ASSIGNED} SELECT district, count(DISTINCT cluster) AS n_clusters, string_agg(CAST(cluster AS VARCHAR), '>' ORDER BY year) AS path,
  count(DISTINCT cluster) = 1 AS stable FROM assigned GROUP BY 1""")
def _(t):
    return P.cluster_moves(assigned(t))


# --- comparisons, labels, sentences ---------------------------------------------------------------
CMP = ["total_usage", *P.USAGE, "total_resident_population"]
_CMP = " UNION ALL ".join(f"""SELECT year, district_a, district_b, '{m}' AS key, a.{m} AS va, b.{m} AS vb FROM pairs
  JOIN panel_full a ON a.district = district_a AND a.year = pairs.year JOIN panel_full b ON b.district = district_b AND b.year = pairs.year"""
                         .replace("SELECT year", "SELECT pairs.year") for m in CMP)


@query("b13_compare_districts", f"""WITH {PANEL_FULL}, {PAIRS}, c AS ({_CMP}) SELECT year, district_a, district_b, key, va AS value_a, vb AS value_b, abs(va - vb) AS diff,
  round_even(coalesce(abs((va - vb) / CAST(nullif(vb, 0) AS DOUBLE) * 100), 0.0), 2) AS ratio_pct, CASE WHEN va >= vb THEN district_a ELSE district_b END AS higher FROM c""")
def _(t):
    return P.compare_pairs(t.panel_full, neighbours(t), CMP)


@query("b15_trend_series", f"WITH {PANEL_FULL} SELECT district, key, label, unit, year, value FROM ({_KPI})")
def _(t):
    return P.trend_series(t.panel)


LABEL_CASE = """CASE WHEN industry_ratio >= 0.10 THEN '산업·서비스 혼재형' WHEN industry_ratio >= 0.07 AND service_ratio >= 0.50 THEN '서비스·산업 복합형'
  WHEN home_ratio >= 0.40 AND public_ratio >= 0.10 THEN '주거·공공 복합형' WHEN home_ratio >= 0.38 THEN '주거 밀집형'
  WHEN home_ratio >= 0.33 AND total_resident_population >= 500000 THEN '광역 주거·서비스형' WHEN public_ratio >= 0.17 AND service_ratio >= 0.45 THEN '공공·서비스 혼재형'
  WHEN service_ratio >= 0.70 AND home_ratio < 0.15 THEN '도심 상업 거점형' WHEN service_ratio >= 0.65 AND total_resident_population >= 400000 THEN '광역 서비스 중심형'
  WHEN service_ratio >= 0.55 THEN '서비스 중심형' ELSE '군집 ' || CAST(cluster AS VARCHAR) END"""


def shifted(t):
    """Shares moved so that every naming rule is reached by some cell."""
    k = F.col("year") % 7 / 6.0
    return assigned(t).select(
        "district", "year", "cluster", (F.col("home_ratio") + 0.1 * k).alias("home_ratio"), "public_ratio",
        (F.col("service_ratio") + 0.6 * k).alias("service_ratio"), F.greatest(F.col("industry_ratio") - 0.1, F.lit(0.0)).alias("industry_ratio"),
        (F.col("total_resident_population") * 10000).alias("total_resident_population"))


SHIFTED = """shifted AS (SELECT district, year, cluster, home_ratio + 0.1 * (year % 7 / 6.0) AS home_ratio, public_ratio,
  service_ratio + 0.6 * (year % 7 / 6.0) AS service_ratio, greatest(industry_ratio - 0.1, 0.0) AS industry_ratio,
  total_resident_population * 10000 AS total_resident_population FROM assigned)"""


@query("b16_cluster_label", f"WITH {ASSIGNED}, {SHIFTED} SELECT district, year, {LABEL_CASE} AS label FROM shifted")
def _(t):
    c = F.col
    return shifted(t).select("district", "year", P.cluster_label(
        c("cluster"), c("home_ratio"), c("public_ratio"), c("service_ratio"), c("industry_ratio"), c("total_resident_population")).alias("label"))


_RAT = ", ".join(f"{f} / (SELECT avg({f}) FROM panel_full) AS r_{f}" for f in FEATS)
_HI = "list_filter([" + ", ".join(f"CASE WHEN r_{f} >= 1.02 THEN '{P.FEATURE_NAMES[f]}' END" for f in FEATS) + "], lambda x: x IS NOT NULL)"
_LO = "list_filter([" + ", ".join(f"CASE WHEN r_{f} <= 0.98 THEN '{P.FEATURE_NAMES[f]}' END" for f in FEATS) + "], lambda x: x IS NOT NULL)"


@query("b17_cluster_summary", f"""WITH {ASSIGNED}, {PROFILE}, q AS (SELECT cluster, {_RAT} FROM profile), h AS (SELECT cluster, {_HI}[1:3] AS hi, {_LO}[1:3] AS lo FROM q)
  SELECT cluster, CASE WHEN len(hi) = 0 AND len(lo) = 0 THEN '전체 평균과 유사한 복합형 군집' ELSE
    CASE WHEN len(hi) > 0 THEN '상대적으로 높은 항목: ' || array_to_string(hi, ', ') ELSE '' END || CASE WHEN len(hi) > 0 AND len(lo) > 0 THEN ' / ' ELSE '' END
    || CASE WHEN len(lo) > 0 THEN '상대적으로 낮은 항목: ' || array_to_string(lo, ', ') ELSE '' END END AS summary FROM h""")
def _(t):
    overall = t.panel_full.agg(*[F.avg(f).alias(f) for f in FEATS])
    return P.cluster_summary(profile(t), overall, high=1.02, low=0.98).select("cluster", "summary")


@query("b23_cluster_names", f"""WITH {ASSIGNED}, names(cluster, cluster_label) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in CLUSTER_LABELS)})
  SELECT district, year, cluster, cluster_label FROM assigned LEFT JOIN names USING (cluster)""")
def _(t):
    names = F.broadcast(cluster_label_table(t.spark))  # a literal of 4 rows
    return assigned(t).join(names, "cluster", "left").select("district", "year", "cluster", "cluster_label")


G = lambda x, u="": f"format('{{:,}}', CAST({x} AS BIGINT)) || '{u}'"


@query("b22_trend_fact", f"""WITH {PANEL_FULL}, {ENDS}, y AS (SELECT district, string_agg('  ' || year || '년: 전체 ' || {G("total_usage", "MWh")} || ', 전체 전력사용량 ' || {G("total_usage", "MWh")}
    || ', 인구 ' || {G("total_resident_population", "명")}, chr(10) ORDER BY year) AS detail FROM panel_full GROUP BY 1)
  SELECT district, district || ' 전체 전력사용량 추세 (' || start_year || '→' || end_year || '):' || chr(10) || '  ' || start_year || '년 ' || {G("start_value", "MWh")} || ' → '
    || end_year || '년 ' || {G("end_value", "MWh")} || ' (' || printf('%.1f', round_even(abs(diff_pct), 1)) || '% ' || {STATUS} || ')' || chr(10) || '연도별 상세:' || chr(10) || detail AS fact
  FROM ends JOIN y USING (district)""")
def _(t):
    return P.trend_fact(t.panel_full, "total_usage", "전체 전력사용량", "MWh")


def _pct(s, c):
    return f"{G(f'{s}.{c}', 'MWh')} || '(' || printf('%.1f', round_even({s}.{c} / CAST({s}.total_usage AS DOUBLE) * 100, 1)) || '%)'"


def _side(s):
    return f"""district_{s} || ': 전체 ' || {G(f"{s}.total_usage", "MWh")} || ', 가정용 ' || {_pct(s, "home_usage")} || ', 서비스업 ' || {_pct(s, "service_usage")}
      || ', 산업용 ' || {_pct(s, "industry_usage")} || ', 공공용 ' || {_pct(s, "public_usage")} || '. 상주인구 ' || {G(f"{s}.total_resident_population", "명")} || '.'"""


@query("b22_comparison_fact", f"""WITH {PANEL_FULL}, {PAIRS} SELECT pairs.year, district_a, district_b, pairs.year || '년 기준.' || chr(10) || {_side("a")} || chr(10) || {_side("b")} || chr(10)
    || '전체 전력사용량은 ' || CASE WHEN a.total_usage >= b.total_usage THEN district_a ELSE district_b END || '가 더 높으며, 차이는 ' || {G("abs(a.total_usage - b.total_usage)", "MWh")}
    || '(' || printf('%.1f', round_even(abs(a.total_usage - b.total_usage) / CAST(least(a.total_usage, b.total_usage) AS DOUBLE) * 100, 1)) || '%).' AS fact
  FROM pairs JOIN panel_full a ON a.district = district_a AND a.year = pairs.year JOIN panel_full b ON b.district = district_b AND b.year = pairs.year
  WHERE a.total_usage > 0 AND b.total_usage > 0""")
def _(t):
    return P.comparison_fact(t.panel_full.where("total_usage > 0"), neighbours(t))


_P1 = lambda c: f"printf('%.1f', round_even({c} * 100, 1))"


@query("b22_cluster_fact", f"""WITH {ASSIGNED} SELECT district, year, year || '년 ' || district || '는 Cluster ' || {LABEL_CASE} || '(' || cluster || ')에 속한다. 전체 전력사용량 ' || {G("total_usage", "MWh")}
    || ', 가정용 ' || {G("home_usage", "MWh")} || '(' || {_P1("home_ratio")} || '%), 서비스업 ' || {G("service_usage", "MWh")} || '(' || {_P1("service_ratio")} || '%), 산업용 '
    || {G("industry_usage", "MWh")} || '(' || {_P1("industry_ratio")} || '%). 상주인구 ' || {G("total_resident_population", "명")} || '.' AS fact FROM assigned""")
def _(t):
    c = F.col
    label = P.cluster_label(c("cluster"), c("home_ratio"), c("public_ratio"), c("service_ratio"), c("industry_ratio"), c("total_resident_population"))
    return P.cluster_fact(t.panel_full, assigned(t).select("district", "year", "cluster", label.alias("cluster_label")))


@query("b22_city_fact", f"""WITH {PANEL_FULL}, c AS (SELECT year, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in (*P.USAGE, "total_usage", "total_resident_population"))},
  count(DISTINCT district) AS n FROM panel_full GROUP BY 1)
  SELECT year, year || '년 전체 전력사용량: ' || {G("total_usage", "MWh")} || ' (가정용 ' || {G("home_usage", "MWh")} || ', 공공용 ' || {G("public_usage", "MWh")} || ', 서비스업 ' || {G("service_usage", "MWh")}
    || ', 산업용 ' || {G("industry_usage", "MWh")} || '). 자치구별 평균 ' || {G("round_even(total_usage / CAST(n AS DOUBLE), 0)", "MWh")} || '. 총 상주인구 ' || {G("total_resident_population", "명")}
    || ' (자치구별 평균 ' || {G("round_even(total_resident_population / CAST(n AS DOUBLE), 0)", "명")} || ').' AS fact FROM c""")
def _(t):
    return P.city_fact(t.panel)


# --- ordered slices ---------------------------------------------------------------------------------
@query("w15_worst_rows", f"WITH {PANEL_FULL} SELECT district, year, home_ratio FROM panel_full ORDER BY home_ratio, district, year LIMIT 5")
def _(t):
    return t.panel_full.orderBy("home_ratio", "district", "year").limit(5).select("district", "year", "home_ratio")
