"""The given tables, and the working tables every query is built from.

Each working table exists twice: as a DataFrame property and as the SQL text of a CTE
(module constants), so that a query and its SQL check start from the same definition.
Money is summed as whole cents, which makes sums independent of row order.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.session import materialize, spread

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Tables whose rows are long texts: per-row work, not reading, is what takes the time.
TEXT_TABLES = ("documents", "pages", "conversations")

# Statement account names and ids, in display order (fixed values).
STATEMENT_ACCOUNTS = (
    ("revenue", "매출액", "ifrs-full_Revenue"),
    ("operating_profit", "영업이익", "dart_OperatingIncomeLoss"),
    ("net_income", "당기순이익", "ifrs-full_ProfitLoss"),
    ("total_assets", "자산총계", "ifrs-full_Assets"),
    ("total_liabilities", "부채총계", "ifrs-full_Liabilities"),
    ("total_equity", "자본총계", "ifrs-full_Equity"),
)


def cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


class Tables:
    """Lazy access to the parquet tables of one folder plus the working tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TEXT_TABLES:
            return spread(self.read(name))
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)

    # --- demand tables -------------------------------------------------------------------
    @cached_property
    def daily(self) -> DataFrame:
        """(use_ymd, line, station) with boardings and alightings, from shipments."""
        return (
            self.lineitem.groupBy(
                F.to_date("l_shipdate").alias("use_ymd"),
                F.col("l_returnflag").alias("line"),
                F.col("l_suppkey").cast("string").alias("station"),
            )
            .agg(F.sum("l_quantity").cast("bigint").alias("ride_num"), F.count("*").alias("alight_num"))
        )

    @cached_property
    def visits(self) -> DataFrame:
        """Same shape from orders; here a station need not be on every line."""
        return (
            self.orders.groupBy(
                F.to_date("o_orderdate").alias("use_ymd"),
                F.col("o_orderpriority").alias("line"),
                F.col("o_custkey").cast("string").alias("station"),
            )
            .agg(F.sum(cents("o_totalprice")).alias("ride_num"), F.count("*").alias("alight_num"))
        )

    @cached_property
    def hourly(self) -> DataFrame:
        """(use_mm, line, station, hour) monthly totals."""
        return (
            self.lineitem.groupBy(
                F.date_format("l_shipdate", "yyyyMM").alias("use_mm"),
                F.col("l_returnflag").alias("line"),
                F.col("l_suppkey").cast("string").alias("station"),
                (F.lit(4) + F.col("l_orderkey") % 20).cast("int").alias("hour"),
            )
            .agg(F.sum("l_quantity").cast("bigint").alias("ride_num"), F.count("*").alias("alight_num"))
        )

    # --- region x year panel -------------------------------------------------------------
    @cached_property
    def order_lines(self) -> DataFrame:
        """One row per order: line sums first, so the join to orders is one to one on the key."""
        amount = cents("l_extendedprice")
        kind = lambda returned, status: F.sum(
            F.when((F.col("l_returnflag") == "R").eqNullSafe(returned) & (F.col("l_linestatus") == status), amount)
            .otherwise(0)
        )
        lines = self.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            kind(False, "F").alias("home_usage"),
            kind(False, "O").alias("public_usage"),
            kind(True, "F").alias("service_usage"),
            kind(True, "O").alias("industry_usage"),
            F.count("*").alias("gas_supply"),
            F.sum("l_quantity").alias("qty"),
        )
        return self.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(lines, "o_orderkey", "left")

    @cached_property
    def panel(self) -> DataFrame:
        """The panel as a stored table: one pass over the facts, however often a query uses it."""
        return materialize(self.panel_plan, "panel")

    @cached_property
    def panel_plan(self) -> DataFrame:
        """(district, year): usage by kind, supply, population, households; all years."""
        year = F.year("o_orderdate")
        sums = ["home_usage", "public_usage", "service_usage", "industry_usage", "gas_supply"]
        per_customer = (
            self.order_lines
            .groupBy("o_custkey", year.alias("year"))
            .agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums], F.count("*").alias("orders"))
        )
        return (
            per_customer.join(
                self.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")),
                "o_custkey",
            )
            .join(self.nation.select("n_nationkey", F.col("n_name").alias("district")), "n_nationkey")
            .groupBy("district", "year")
            .agg(
                *[F.sum(c).alias(c) for c in sums],
                F.count("*").alias("total_resident_population"),
                F.sum("orders").alias("total_households"),
            )
            .select("district", F.col("year").cast("bigint").alias("year"), *sums,
                    "total_resident_population", "total_households")
        )

    @cached_property
    def panel_full(self) -> DataFrame:
        from sparkdesk.operators.panel import add_panel_ratios

        return add_panel_ratios(self.panel)

    @cached_property
    def measure(self) -> DataFrame:
        """The monthly measure as a stored table."""
        return materialize(self.measure_plan, "measure")

    @cached_property
    def measure_plan(self) -> DataFrame:
        """(district, year, month, value): mean line quantity, the long monthly measure."""
        return (
            self.order_lines.where(F.col("gas_supply").isNotNull())
            .groupBy("o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
            .agg(F.sum("qty").alias("qty"), F.sum("gas_supply").alias("n"))
            .join(
                self.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")),
                "o_custkey",
            )
            .join(self.nation.select("n_nationkey", F.col("n_name").alias("district")), "n_nationkey")
            .groupBy("district", F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))
            .agg((F.sum("qty") / F.sum("n")).alias("value"))
        )

    # --- company statements, prices --------------------------------------------------------
    @cached_property
    def accounts_wide(self) -> DataFrame:
        """(corp_code, year) with six account amounts in cents, from a supplier's lines."""
        amount = cents("l_extendedprice")
        flag = F.col("l_returnflag")
        return (
            self.lineitem.groupBy(
                F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias("corp_code"),
                F.year("l_shipdate").cast("bigint").alias("year"),
            )
            .agg(
                F.sum(amount).alias("revenue"),
                F.sum(F.when(flag == "A", amount).when(flag == "R", -amount).otherwise(0)).alias("operating_profit"),
                F.sum(F.when(flag == "N", amount).when(flag == "R", -amount).otherwise(0)).alias("net_income"),
                F.sum(amount * 2).alias("total_assets"),
                F.sum(F.when(flag == "N", amount * 4).otherwise(0)).alias("total_liabilities"),
            )
            .withColumn("total_equity", F.col("total_assets") - F.col("total_liabilities"))
        )

    @cached_property
    def statement_lines(self) -> DataFrame:
        """Long dirty statement rows: grouped digits, losses in parentheses, prior year beside it."""
        keys = [k for k, _, _ in STATEMENT_ACCOUNTS]
        # a company has one row per year, so its window is a handful of rows; no second pass over the facts
        by_year = W.partitionBy("corp_code").orderBy("year")
        follows = F.lag("year").over(by_year) == F.col("year") - 1
        cur = self.accounts_wide.select("*", *[F.when(follows, F.lag(k).over(by_year)).alias(f"prev_{k}") for k in keys])

        def text(c: str) -> Column:
            v = F.col(c)
            return (
                F.when(v.isNull(), F.lit("-"))
                .when(v < 0, F.concat(F.lit("("), F.format_number(-v, 0), F.lit(")")))
                .otherwise(F.format_number(v, 0))
            )

        rows = F.array(*[
            F.struct(
                F.lit(i).cast("bigint").alias("pos"), F.lit(nm).alias("account_nm"), F.lit(aid).alias("account_id"),
                text(k).alias("thstrm_amount"), text(f"prev_{k}").alias("frmtrm_amount"),
            )
            for i, (k, nm, aid) in enumerate(STATEMENT_ACCOUNTS)
        ])
        return cur.select("corp_code", "year", F.inline(rows))

    @cached_property
    def prices(self) -> DataFrame:
        """(code, date): close, high, low in whole cents."""
        amount = cents("l_extendedprice")
        return (
            self.lineitem.groupBy(
                F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias("code"),
                F.to_date("l_shipdate").alias("date"),
            )
            .agg(
                F.floor(F.sum(amount) / F.count("*")).alias("close"),
                F.max(amount).alias("high"),
                F.min(amount).alias("low"),
            )
        )

    @cached_property
    def listing(self) -> DataFrame:
        """Company listing: name, market, market value, number of shares."""
        return self.supplier.select(
            F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("code"),
            F.col("s_name").alias("name"),
            F.when(F.col("s_nationkey") % 3 == 0, "KOSPI").when(F.col("s_nationkey") % 3 == 1, "KOSDAQ")
            .otherwise("KONEX").alias("market"),
            cents("s_acctbal").alias("marcap"),
            (F.col("s_nationkey") * 10 + 1).cast("bigint").alias("stocks"),
        )

    # --- filings corpus --------------------------------------------------------------------
    @cached_property
    def filings(self) -> DataFrame:
        """(rcept_no, corp_name, label, report_nm, rcept_dt, text) from the documents."""
        return self.documents.select(
            F.col("doc_id").cast("bigint").alias("rcept_no"),
            F.col("source").alias("corp_name"),
            F.col("lang").alias("label"),
            F.concat_ws(" ", "source", "lang", F.element_at(F.split("text", r"\s+"), 1)).alias("report_nm"),
            F.concat(F.lit("20"), F.lpad((F.lit(20) + F.col("doc_id") % 5).cast("string"), 2, "0"),
                     F.lpad((F.lit(1) + F.col("doc_id") % 12).cast("string"), 2, "0"), F.lit("15")).alias("rcept_dt"),
            "text",
        )


# --- the same working tables as SQL text -------------------------------------------------
DAILY = """daily AS (
  SELECT CAST(l_shipdate AS DATE) AS use_ymd, l_returnflag AS line, CAST(l_suppkey AS VARCHAR) AS station,
         CAST(sum(l_quantity) AS BIGINT) AS ride_num, count(*) AS alight_num
  FROM lineitem GROUP BY 1, 2, 3)"""

VISITS = """visits AS (
  SELECT CAST(o_orderdate AS DATE) AS use_ymd, o_orderpriority AS line, CAST(o_custkey AS VARCHAR) AS station,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS ride_num, count(*) AS alight_num
  FROM orders GROUP BY 1, 2, 3)"""

HOURLY = """hourly AS (
  SELECT strftime(l_shipdate, '%Y%m') AS use_mm, l_returnflag AS line, CAST(l_suppkey AS VARCHAR) AS station,
         CAST(4 + l_orderkey % 20 AS INTEGER) AS hour,
         CAST(sum(l_quantity) AS BIGINT) AS ride_num, count(*) AS alight_num
  FROM lineitem GROUP BY 1, 2, 3, 4)"""

_AMT = "CAST(round(l_extendedprice * 100) AS BIGINT)"

PANEL = f"""panel AS (
  SELECT n_name AS district, CAST(year(o_orderdate) AS BIGINT) AS year,
    CAST(sum(CASE WHEN l_returnflag <> 'R' AND l_linestatus = 'F' THEN {_AMT} ELSE 0 END) AS BIGINT) AS home_usage,
    CAST(sum(CASE WHEN l_returnflag <> 'R' AND l_linestatus = 'O' THEN {_AMT} ELSE 0 END) AS BIGINT) AS public_usage,
    CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN {_AMT} ELSE 0 END) AS BIGINT) AS service_usage,
    CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN {_AMT} ELSE 0 END) AS BIGINT) AS industry_usage,
    count(l_orderkey) AS gas_supply,
    count(DISTINCT o_custkey) AS total_resident_population,
    count(DISTINCT o_orderkey) AS total_households
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY 1, 2)"""

PANEL_FULL = PANEL + """, panel_full AS (
  SELECT *, home_usage + public_usage + service_usage + industry_usage AS total_usage,
    round(gas_supply / CAST(nullif(total_households, 0) AS DOUBLE), 6) AS gas_supply_ratio,
    round(home_usage / CAST(nullif(home_usage + public_usage + service_usage + industry_usage, 0) AS DOUBLE), 6) AS home_ratio,
    round(public_usage / CAST(nullif(home_usage + public_usage + service_usage + industry_usage, 0) AS DOUBLE), 6) AS public_ratio,
    round(service_usage / CAST(nullif(home_usage + public_usage + service_usage + industry_usage, 0) AS DOUBLE), 6) AS service_ratio,
    round(industry_usage / CAST(nullif(home_usage + public_usage + service_usage + industry_usage, 0) AS DOUBLE), 6) AS industry_ratio
  FROM panel)"""

MEASURE = """measure AS (
  SELECT n_name AS district, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
         sum(l_quantity) / count(*) AS value
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3)"""

ACCOUNTS = f"""accounts AS (
  SELECT *, total_assets - total_liabilities AS total_equity FROM (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS corp_code, CAST(year(l_shipdate) AS BIGINT) AS year,
    CAST(sum({_AMT}) AS BIGINT) AS revenue,
    CAST(sum(CASE l_returnflag WHEN 'A' THEN {_AMT} WHEN 'R' THEN -{_AMT} ELSE 0 END) AS BIGINT) AS operating_profit,
    CAST(sum(CASE l_returnflag WHEN 'N' THEN {_AMT} WHEN 'R' THEN -{_AMT} ELSE 0 END) AS BIGINT) AS net_income,
    CAST(sum(2 * {_AMT}) AS BIGINT) AS total_assets,
    CAST(sum(CASE l_returnflag WHEN 'N' THEN 4 * {_AMT} ELSE 0 END) AS BIGINT) AS total_liabilities
  FROM lineitem GROUP BY 1, 2))"""

PRICES = f"""prices AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS code, CAST(l_shipdate AS DATE) AS date,
    CAST(floor(sum({_AMT}) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS close,
    max({_AMT}) AS high, min({_AMT}) AS low
  FROM lineitem GROUP BY 1, 2)"""

LISTING = """listing AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS code, s_name AS name,
    CASE s_nationkey % 3 WHEN 0 THEN 'KOSPI' WHEN 1 THEN 'KOSDAQ' ELSE 'KONEX' END AS market,
    CAST(round(s_acctbal * 100) AS BIGINT) AS marcap, CAST(s_nationkey * 10 + 1 AS BIGINT) AS stocks
  FROM supplier)"""

FILINGS = r"""filings AS (
  SELECT doc_id AS rcept_no, source AS corp_name, lang AS label,
    source || ' ' || lang || ' ' || regexp_split_to_array(text, '\s+')[1] AS report_nm,
    '20' || lpad(CAST(20 + doc_id % 5 AS VARCHAR), 2, '0') || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '15' AS rcept_dt,
    text
  FROM documents)"""
