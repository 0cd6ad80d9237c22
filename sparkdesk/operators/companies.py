"""Company jobs: name resolution, statement selection, ratios, scores, prices, sentiment shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.functions import scoring as S
from sparkdesk.functions.cleaning import parse_money, yoy
from sparkdesk.operators.dedup import first_per_key

# Report codes and statement kinds, best first.
REPORT_ORDER = (("11011", "CFS"), ("11011", "OFS"), ("11012", "CFS"), ("11012", "OFS"),
                ("11013", "CFS"), ("11013", "OFS"), ("11014", "CFS"), ("11014", "OFS"))

# Account name -> key, then account id -> key.
ACCOUNT_NAMES = (
    ("매출액", "revenue"), ("수익(매출액)", "revenue"), ("영업수익", "revenue"), ("매출", "revenue"),
    ("영업이익", "operating_profit"), ("영업이익(손실)", "operating_profit"),
    ("당기순이익", "net_income"), ("당기순이익(손실)", "net_income"), ("연결당기순이익", "net_income"), ("당기순손익", "net_income"),
    ("자산총계", "total_assets"), ("자산 합계", "total_assets"),
    ("부채총계", "total_liabilities"), ("부채 합계", "total_liabilities"),
    ("자본총계", "total_equity"), ("자본 합계", "total_equity"),
)
ACCOUNT_IDS = (
    ("ifrs-full_Revenue", "revenue"), ("ifrs_Revenue", "revenue"), ("dart_Revenue", "revenue"),
    ("dart_OperatingIncomeLoss", "operating_profit"),
    ("ifrs-full_ProfitLoss", "net_income"), ("ifrs-full_ProfitLossAttributableToOwnersOfParent", "net_income"),
    ("ifrs-full_Assets", "total_assets"), ("ifrs-full_Liabilities", "total_liabilities"),
    ("ifrs-full_Equity", "total_equity"), ("ifrs-full_EquityAttributableToOwnersOfParent", "total_equity"),
)
ACCOUNT_KEYS = ("revenue", "operating_profit", "net_income", "total_assets", "total_liabilities", "total_equity")

# Anchored account name patterns of the scoring input.
CORE_PATTERNS = (
    ("revenue", r"^매출액$|^수익\(매출액\)$|^영업수익$|^매출총액$"),
    ("operating_income", r"^영업이익$|^영업손익$|^영업이익\(손실\)$"),
    ("net_income", r"^당기순이익$|^연결당기순이익$|^당기순이익\(손실\)$|^반기순이익$|^분기순이익$"),
    ("total_equity", r"^자본총계$|^연결자본총계$"),
)


# --- resolution ---------------------------------------------------------------------------------
NAMES_PER_TASK = 20_000


def _best_by_substring(names: DataFrame, needles: DataFrame, best: Column) -> DataFrame:
    """Best row for each needle contained in some name.

    Every substring of a name whose length is asked for becomes a key; equal substrings are reduced
    to their best row before the shuffle, then matched by equality. The work grows with the number
    of names, not with names x needles, and a substring shared by all names stays one row. A small file
    holds many names and a name many substrings, so a task gets ``NAMES_PER_TASK`` names, however the files are cut.
    """
    names = names.repartition(max(1, -(-names.count() // NAMES_PER_TASK)))
    lengths = needles.agg(F.array_sort(F.collect_set(F.length("needle"))))  # at most one entry per name length
    size = F.length("text")
    keyed = names.select("text", "row", F.explode(lengths.scalar()).alias("_n")).where((F.col("_n") > 0) & (F.col("_n") <= size))
    parts = F.array_distinct(F.transform(
        F.sequence(F.lit(1), size - F.col("_n") + 1), lambda i: F.substring(F.col("text"), i, F.col("_n"))))
    reduced = keyed.select(F.explode(parts).alias("needle"), "row").groupBy("needle").agg(F.min_by("row", best).alias("row"))
    return needles.join(reduced, "needle")


def resolve_names(queries: DataFrame, register: DataFrame) -> DataFrame:
    """Company of each name: exact listed, exact, contained listed, contained; first tier wins.

    ``queries`` has ``name``; ``register`` has corp_code, corp_name and stock_code (null if unlisted).
    """
    listed_first = F.struct(F.col("row.stock_code").isNull(), F.col("row.corp_code"))
    rows = register.select(
        F.col("corp_name").alias("name"), F.struct("corp_code", "corp_name", "stock_code").alias("row"))
    exact = rows.groupBy("name").agg(F.min_by("row", listed_first).alias("row"))
    asked = queries.select("name").distinct()
    found = asked.join(exact, "name").select(
        "name", F.when(F.col("row.stock_code").isNotNull(), 1).otherwise(2).alias("tier"), "row.*")
    open_names = asked.join(exact.select("name"), "name", "left_anti")
    part = _best_by_substring(
        rows.select(F.lower("name").alias("text"), "row"),
        open_names.select(F.lower("name").alias("needle")).distinct(), listed_first)
    partial = open_names.withColumn("needle", F.lower("name")).join(part, "needle").select(
        "name", F.when(F.col("row.stock_code").isNotNull(), 3).otherwise(4).alias("tier"), "row.*")
    return found.unionByName(partial)


def resolve_tickers(queries: DataFrame, listing: DataFrame, markets: tuple[str, ...] = ("KOSPI", "KOSDAQ")) -> DataFrame:
    """Code and name for free text: six digits, else exact name without spaces, else contained name."""
    asked = queries.select(F.trim("text").alias("text")).distinct()
    code = F.lpad(F.col("code"), 6, "0")
    digits = F.col("text").rlike(r"^\d{6}$")
    by_code = asked.where(digits).join(
        listing.groupBy(code.alias("text")).agg(F.min("name").alias("name")), "text", "left"
    ).select("text", F.col("text").alias("ticker"), F.coalesce("name", "text").alias("name"))

    squeezed = lambda c: F.lower(F.replace(c, F.lit(" "), F.lit("")))
    words = asked.where(~digits).select("text", squeezed(F.col("text")).alias("needle"))
    names = listing.select(
        squeezed(F.col("name")).alias("text"), F.struct(code.alias("ticker"), "name", "market").alias("row"))
    tradable = F.col("row.market").isin(*markets)
    by_name = names.groupBy(F.col("text").alias("needle")).agg(
        F.min_by("row", F.when(tradable, F.col("row.ticker"))).alias("row"))
    exact = words.join(by_name, "needle").where("row IS NOT NULL").select("text", "row.ticker", "row.name")
    rest = words.join(by_name.select("needle"), "needle", "left_anti")
    part = _best_by_substring(names.where(tradable), rest.select("needle").distinct(), F.col("row.ticker"))
    partial = rest.join(part, "needle").select("text", "row.ticker", "row.name")
    return by_code.unionByName(exact).unionByName(partial)


# --- statements -----------------------------------------------------------------------------------
def pick_report(available: DataFrame) -> DataFrame:
    """First available of eight (report, statement kind) choices per company and year."""
    rank = F.lit(None).cast("int")
    for i, (code, kind) in reversed(list(enumerate(REPORT_ORDER))):
        rank = F.when((F.col("reprt_code") == code) & (F.col("fs_div") == kind), i).otherwise(rank)
    return first_per_key(available.where(rank.isNotNull()), ["corp_code", "year"], [rank])


def latest_of_two_years(statements: DataFrame, current_year: int) -> DataFrame:
    """Last usable of the two years before ``current_year`` per company."""
    recent = statements.where(F.col("year").isin(current_year - 1, current_year - 2))
    return recent.groupBy("corp_code").agg(F.max("year").alias("year"))


def map_accounts(lines: DataFrame) -> DataFrame:
    """Key of each statement line: by account name, otherwise by account id."""
    spark = lines.sparkSession
    by_name = F.broadcast(spark.createDataFrame(list(ACCOUNT_NAMES), "_nm string, _k1 string"))  # literals of
    by_id = F.broadcast(spark.createDataFrame(list(ACCOUNT_IDS), "_id string, _k2 string"))      # known size
    return (
        lines.join(by_name, F.trim("account_nm") == F.col("_nm"), "left")
        .join(by_id, F.trim("account_id") == F.col("_id"), "left")
        .withColumn("account_key", F.coalesce("_k1", "_k2")).drop("_nm", "_id", "_k1", "_k2")
    )


def statement_row(lines: DataFrame) -> DataFrame:
    """Six accounts of a company and year in one row; the first readable value of a key wins."""
    mapped = map_accounts(lines).where("account_key IS NOT NULL").withColumn(
        "_v", F.trim(F.replace("thstrm_amount", F.lit(","), F.lit(""))).try_cast("bigint"))
    pick = lambda k: F.min_by("_v", F.when((F.col("account_key") == k) & F.col("_v").isNotNull(), F.col("pos"))).alias(k)
    return mapped.groupBy("corp_code", "year").agg(*[pick(k) for k in ACCOUNT_KEYS])


def core_accounts(lines: DataFrame) -> DataFrame:
    """Current and prior amount of four accounts by anchored name pattern, in one pass."""
    typed = lines.select(
        "corp_code", "year", "pos", "account_nm", parse_money("thstrm_amount").alias("cur"),
        parse_money("frmtrm_amount").alias("prev"))
    usable = F.col("cur").isNotNull() | F.col("prev").isNotNull()
    pick = lambda pattern: F.min_by(
        F.struct("cur", "prev"), F.when(F.lower("account_nm").rlike(pattern) & usable, F.col("pos")))
    out = typed.groupBy("corp_code", "year").agg(*[pick(p).alias(f"_{k}") for k, p in CORE_PATTERNS])
    cols = [c for k, _ in CORE_PATTERNS for c in (F.col(f"_{k}.cur").alias(k), F.col(f"_{k}.prev").alias(f"prev_{k}"))]
    return out.select("corp_code", "year", *cols)


def add_ratios(core: DataFrame, price: str = "current_price", shares: str = "stock_count") -> DataFrame:
    """EPS, BPS, PER, PBR and ROE."""
    div = lambda a, b: F.col(a) / F.nullif(F.col(b).cast("double"), F.lit(0.0))
    out = core.withColumn("eps", div("net_income", shares)).withColumn("bps", div("total_equity", shares))
    return (
        out.withColumn("per", F.when(F.col("eps") > 0, F.col(price) / F.col("eps")))
        .withColumn("pbr", F.when(F.col("bps") > 0, F.col(price) / F.col("bps")))
        .withColumn("roe", div("net_income", "total_equity") * 100)
    )


def score_companies(df: DataFrame) -> DataFrame:
    """Four blocks of 25, total, risk, opinion and the leading reasons."""
    c = F.col
    blocks = {
        "value": S.value_block(c("per"), c("pbr")),
        "profit": S.profit_block(c("roe"), c("operating_income"), c("net_income")),
        "growth": S.growth_block(c("revenue"), c("prev_revenue"), c("operating_income"), c("prev_operating_income"),
                                 c("net_income"), c("prev_net_income")),
        "stability": S.stability_block(c("total_equity"), c("pbr"), c("roe"), c("operating_income"), c("net_income")),
    }
    # a generator over one row: each block is evaluated once, however often it is read below
    out = df.select("*", F.inline(F.array(F.struct(*[b.alias(f"_{k}") for k, b in blocks.items()]))))
    total = F.least(F.greatest(sum((c(f"_{k}.score") for k in blocks), F.lit(0)), F.lit(0)), F.lit(100))
    reasons = F.slice(F.concat(*[F.slice(c(f"_{k}.reasons"), 1, 2) for k in blocks]), 1, 6)
    rate = lambda cur: F.bround(yoy(cur, f"prev_{cur}"), 2)
    return out.select(
        *df.columns, *[c(f"_{k}.score").alias(f"{k}_score") for k in blocks], total.alias("total_score"),
        (F.lit(25) - c("_stability.score")).alias("risk_score"), S.opinion(total).alias("investment_opinion"),
        reasons.alias("analysis_summary"), rate("revenue").alias("revenue_yoy"),
        rate("operating_income").alias("operating_income_yoy"), rate("net_income").alias("net_income_yoy"),
        *[c(f"_{k}.reasons").alias(f"{k}_reasons") for k in blocks],
    )


def compare_companies(scores: DataFrame, pairs: DataFrame) -> DataFrame:
    """Score difference and winner of given (company_a, company_b) rows; a tie goes to b."""
    side = lambda s: scores.select("year", F.col("corp_code").alias(f"company_{s}"), F.col("total_score").alias(f"score_{s}"))
    both = pairs.join(side("a"), "company_a").join(side("b"), ["company_b", "year"])
    return both.select(
        "year", "company_a", "company_b", (F.col("score_a") - F.col("score_b")).alias("total_score_diff"),
        F.when(F.col("score_a") > F.col("score_b"), F.col("company_a")).otherwise(F.col("company_b")).alias("winner"),
    )


# --- prices -----------------------------------------------------------------------------------------
def market_snapshot(prices: DataFrame, listing: DataFrame, today: Column, days: int = 365) -> DataFrame:
    """Latest close, high and low of the last year, market value from the listing."""
    recent = prices.where(F.col("date").between(F.date_sub(today, days), today))
    agg = recent.groupBy("code").agg(
        F.max_by("close", "date").alias("close"), F.max("high").alias("high_52w"), F.min("low").alias("low_52w"))
    return agg.join(listing.select("code", F.col("marcap").alias("market_cap")), "code", "left").withColumn("listed", F.lit(True))


def period_change(prices: DataFrame) -> DataFrame:
    """Percent change of the last against the first close; codes with a zero base are left out."""
    ends = prices.groupBy("code").agg(F.min_by("close", "date").alias("first_close"), F.max_by("close", "date").alias("last_close"))
    return ends.where("first_close <> 0").withColumn(
        "change_pct", (F.col("last_close") - F.col("first_close")) / F.col("first_close") * 100)


# --- sentiment shares -------------------------------------------------------------------------------
# Class names and display words, in tie-break order.
SENTIMENTS = (("positive", "긍정"), ("negative", "부정"), ("neutral", "중립"))


def sentiment_shares(scored: DataFrame, companies: DataFrame) -> DataFrame:
    """Share of each class per company and the dominant class; no articles means neutral."""
    counts = scored.groupBy("company").agg(
        *[F.count_if(F.col("sentiment") == k).alias(k) for k, _ in SENTIMENTS], F.count("*").alias("n"))
    out = companies.select("company").distinct().join(counts, "company", "left").fillna(0)
    top = F.greatest(*[F.col(k) for k, _ in SENTIMENTS])
    label = F.when(F.col("n") == 0, SENTIMENTS[-1][1])
    for k, word in SENTIMENTS:
        label = label.when(F.col(k) == top, word)
    share = lambda k: F.when(F.col("n") == 0, 0.0).otherwise(F.bround(F.col(k) / F.col("n"), 3)).alias(f"{k}_ratio")
    return out.select("company", label.alias("label"), *[share(k) for k, _ in SENTIMENTS])


def sentiment_table(scored: DataFrame) -> DataFrame:
    """Articles per class and mean confidence per company."""
    return scored.groupBy("company").agg(
        *[F.count_if(F.col("sentiment") == k).alias(k) for k, _ in SENTIMENTS], F.avg("score").alias("mean_score"))


# --- filings ----------------------------------------------------------------------------------------
def latest_filings(frames: list[DataFrame], n: int = 5) -> DataFrame:
    """Latest n filings per company over several filing types.

    The rank filter is pushed below the shuffle by Spark, so each task forwards at most n rows per company.
    """
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    w = W.partitionBy("corp_name").orderBy(F.col("rcept_dt").desc(), "rcept_no")
    return rows.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n)


def first_important(filings: DataFrame, important: Column, position: str) -> DataFrame:
    """First important filing per company, otherwise its first filing."""
    return first_per_key(filings, ["corp_name"], [~important, F.col(position)])


# --- sessions and history ---------------------------------------------------------------------------
def mark_sessions(events: DataFrame, open_flag: Column, holidays: DataFrame, day: Column) -> DataFrame:
    """Trading-session flag with public holidays joined out (P29). ``holidays`` is a calendar of days."""
    known = holidays.select(F.col("holiday").alias("_day"), F.lit(True).alias("_off"))
    return events.withColumn("_day", day).join(known, "_day", "left").withColumn(
        "session_open", open_flag & F.col("_off").isNull()).drop("_day", "_off")


def is_fresh(open_now: Column, age_seconds: Column, ttl_seconds: int = 180) -> Column:
    """Inside a session entries live three minutes, outside any age is good."""
    return ~open_now | (age_seconds < ttl_seconds)


def latest_and_history(runs: DataFrame, keys: list[str], when: str) -> tuple[DataFrame, DataFrame]:
    """Split runs into the newest record per key and the full history."""
    return first_per_key(runs, keys, [-F.unix_micros(F.col(when).cast("timestamp"))]), runs
