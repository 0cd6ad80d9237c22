"""Company queries: resolution, statements, ratios, scores, prices, sentiment, sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions import calendar as C
from sparkdesk.functions import cleaning as N
from sparkdesk.functions import scoring as S
from sparkdesk.functions.rules import any_keyword
from sparkdesk.operators import companies as B
from sparkdesk.plans.demand import r
from sparkdesk.plans.registry import query
from sparkdesk.plans.tables import ACCOUNTS, FILINGS, LISTING, PRICES


# --- resolution -----------------------------------------------------------------------------------
def register(t):
    """Suppliers are listed companies, customers unlisted ones; the low numbers occur as both."""
    sup = t.supplier.select(F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0")).alias("corp_code"),
                            F.replace("s_name", F.lit("Supplier"), F.lit("Corp ")).alias("corp_name"),
                            F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("stock_code"))
    cust = t.customer.select(F.concat(F.lit("C"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("corp_code"),
                             F.replace("c_name", F.lit("Customer"), F.lit("Corp ")).alias("corp_name"),
                             F.lit(None).cast("string").alias("stock_code"))
    return sup.unionByName(cust)


REGISTER = """register AS (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS corp_code, replace(s_name, 'Supplier', 'Corp ') AS corp_name,
    lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS stock_code FROM supplier
  UNION ALL SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 7, '0'), replace(c_name, 'Customer', 'Corp '), NULL FROM customer)"""


def asked_names(t):
    """Full names, upper-cased endings (contained only) and names that match nothing."""
    full = t.customer.select(F.replace("c_name", F.lit("Customer"), F.lit("Corp ")).alias("name"))
    tail = t.customer.select(F.concat(F.lit("ORP #"), F.substring("c_name", 10, 7)).alias("name"))
    tail2 = t.supplier.select(F.substring("s_name", 13, 6).alias("name"))
    none = t.nation.select("n_name").withColumnRenamed("n_name", "name")
    return full.unionByName(tail).unionByName(tail2).unionByName(none)


@query("j11_resolve_names", f"""WITH {REGISTER}, asked AS (SELECT DISTINCT name FROM (SELECT replace(c_name, 'Customer', 'Corp ') AS name FROM customer
    UNION ALL SELECT 'ORP #' || substr(c_name, 10, 7) FROM customer UNION ALL SELECT substr(s_name, 13, 6) FROM supplier UNION ALL SELECT n_name FROM nation)),
  hits AS (SELECT a.name, g.*, CASE WHEN corp_name = name THEN CASE WHEN stock_code IS NOT NULL THEN 1 ELSE 2 END
    WHEN stock_code IS NOT NULL THEN 3 ELSE 4 END AS tier FROM asked a JOIN register g ON contains(lower(g.corp_name), lower(a.name)))
  SELECT name, CAST(tier AS INTEGER) AS tier, corp_code, corp_name, stock_code FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY tier, corp_code) AS k FROM hits) WHERE k = 1""")
def _(t):
    return B.resolve_names(asked_names(t), register(t))


def asked_tickers(t):
    """Codes (known and unknown), spaced names in capitals, and parts of names."""
    code = t.customer.select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("text"))
    name = t.supplier.select(F.replace(F.upper("s_name"), F.lit("#"), F.lit(" #")).alias("text"))
    part = t.customer.select(F.concat(F.lit("lier#0000"), F.substring("c_name", 14, 4)).alias("text"))
    return code.unionByName(name).unionByName(part)


@query("j12_resolve_tickers", f"""WITH {LISTING}, l AS (SELECT lpad(CAST(CAST(code AS BIGINT) AS VARCHAR), 6, '0') AS ticker, name, market FROM listing),
  asked AS (SELECT DISTINCT text FROM (SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS text FROM customer
    UNION ALL SELECT replace(upper(s_name), '#', ' #') FROM supplier UNION ALL SELECT 'lier#0000' || substr(c_name, 14, 4) FROM customer)),
  w AS (SELECT text, lower(replace(text, ' ', '')) AS q FROM asked WHERE NOT regexp_full_match(text, '\\d{{6}}'))
  SELECT a.text, a.text AS ticker, coalesce(l.name, a.text) AS name FROM asked a LEFT JOIN l ON l.ticker = a.text WHERE regexp_full_match(a.text, '\\d{{6}}')
  UNION ALL SELECT text, ticker, name FROM (SELECT w.text, l.ticker, l.name, row_number() OVER (PARTITION BY w.text ORDER BY l.ticker) AS k
    FROM w JOIN l ON l.market IN ('KOSPI', 'KOSDAQ') AND CASE WHEN EXISTS (SELECT 1 FROM l x WHERE lower(replace(x.name, ' ', '')) = w.q)
      THEN lower(replace(l.name, ' ', '')) = w.q ELSE contains(lower(replace(l.name, ' ', '')), w.q) END) WHERE k = 1""")
def _(t):
    listing = t.listing.withColumn("code", F.col("code").cast("bigint").cast("string"))
    return B.resolve_tickers(asked_tickers(t), listing)


# --- statements -----------------------------------------------------------------------------------
def available(t):
    """Reports a customer 'filed': report code by quarter, statement kind by order status."""
    codes = F.element_at(F.array(*[F.lit(c) for c in ("11011", "11012", "11013", "11014")]), F.quarter("o_orderdate"))
    return t.orders.groupBy(
        F.col("o_custkey").alias("corp_code"), F.year("o_orderdate").cast("bigint").alias("year"), codes.alias("reprt_code"),
        F.when(F.col("o_orderstatus") == "F", "CFS").otherwise("OFS").alias("fs_div"),
    ).agg(F.count("*").alias("n_lines"))


AVAILABLE = """available AS (SELECT o_custkey AS corp_code, CAST(year(o_orderdate) AS BIGINT) AS year, '1101' || quarter(o_orderdate) AS reprt_code,
  CASE WHEN o_orderstatus = 'F' THEN 'CFS' ELSE 'OFS' END AS fs_div, count(*) AS n_lines FROM orders GROUP BY 1, 2, 3, 4)"""


@query("j13_pick_report", f"""WITH {AVAILABLE} SELECT corp_code, year, reprt_code, fs_div, n_lines FROM (
  SELECT *, row_number() OVER (PARTITION BY corp_code, year ORDER BY reprt_code, fs_div) AS k FROM available) WHERE k = 1""")
def _(t):
    return B.pick_report(available(t))


@query("j14_latest_of_two", f"WITH {AVAILABLE} SELECT corp_code, max(year) AS year FROM available WHERE year IN (2000, 1999) GROUP BY 1")
def _(t):
    return B.latest_of_two_years(available(t), 2001)


@query("j15_map_accounts", f"""WITH {ACCOUNTS}, k AS (SELECT unnest(['revenue', 'operating_profit', 'net_income', 'total_assets', 'total_liabilities', 'total_equity']) AS account_key)
  SELECT account_key, count(*) AS n FROM accounts, k GROUP BY 1""")
def _(t):
    unnamed = t.statement_lines.withColumn("account_nm", F.when(F.col("pos") < 3, F.col("account_nm")).otherwise("기타"))
    return B.map_accounts(unnamed).groupBy("account_key").agg(F.count("*").alias("n"))


_POSITIVE = ", ".join(f"CASE WHEN {k} >= 0 THEN {k} END AS {k}" for k in B.ACCOUNT_KEYS)


@query("b08_statement_row", f"WITH {ACCOUNTS} SELECT corp_code, year, {_POSITIVE} FROM accounts")
def _(t):
    return B.statement_row(t.statement_lines)


BASE = f"""{ACCOUNTS}, {PRICES}, {LISTING}, base AS (
  SELECT a.corp_code, a.year, CAST(a.revenue AS DOUBLE) AS revenue, CAST(b.revenue AS DOUBLE) AS prev_revenue,
    CAST(a.operating_profit AS DOUBLE) AS operating_income, CAST(b.operating_profit AS DOUBLE) AS prev_operating_income,
    CAST(a.net_income AS DOUBLE) AS net_income, CAST(b.net_income AS DOUBLE) AS prev_net_income,
    CAST(a.total_equity AS DOUBLE) AS total_equity, CAST(b.total_equity AS DOUBLE) AS prev_total_equity,
    p.close AS current_price, l.stocks * 100 AS stock_count
  FROM accounts a LEFT JOIN accounts b ON b.corp_code = a.corp_code AND b.year = a.year - 1
  JOIN (SELECT code, year(date) AS year, arg_max(close, date) AS close FROM prices GROUP BY 1, 2) p ON p.code = a.corp_code AND p.year = a.year
  JOIN listing l ON l.code = a.corp_code),
  ratios AS (SELECT *, CASE WHEN net_income / stock_count > 0 THEN current_price / (net_income / stock_count) END AS per,
    CASE WHEN total_equity / stock_count > 0 THEN current_price / (total_equity / stock_count) END AS pbr,
    net_income / nullif(total_equity, 0) * 100 AS roe FROM base)"""


def base(t):
    core = B.core_accounts(t.statement_lines)
    price = t.prices.groupBy(F.col("code").alias("corp_code"), F.year("date").cast("bigint").alias("year")).agg(
        F.max_by("close", "date").alias("current_price"))
    shares = t.listing.select(F.col("code").alias("corp_code"), (F.col("stocks") * 100).alias("stock_count"))
    return core.join(price, ["corp_code", "year"]).join(shares, "corp_code")


def ratios(t):
    return B.add_ratios(base(t))


@query("b07_core_accounts", f"""WITH {BASE} SELECT corp_code, year, revenue, prev_revenue, operating_income, prev_operating_income, net_income, prev_net_income,
  total_equity, prev_total_equity FROM base""")
def _(t):
    return B.core_accounts(t.statement_lines)


@query("b06_ratios", f"""WITH {BASE} SELECT corp_code, year, round(net_income / stock_count, 4) AS eps, round(total_equity / stock_count, 4) AS bps, round(per, 6) AS per,
  round(pbr, 6) AS pbr, round(roe, 6) AS roe FROM ratios""")
def _(t):
    return r(r(ratios(t).select("corp_code", "year", "eps", "bps", "per", "pbr", "roe"), 4, "eps", "bps"), 6, "per", "pbr", "roe")


# SQL for the point tables, from the same fixed values the library uses
def _n(v, d):
    return f"printf('%.{d}f', round_even({v}, {d}))"


def _case(rules, default, i):
    return "CASE " + " ".join(f"WHEN {c} THEN {x[i]}" for c, x in rules) + f" ELSE {default[i]} END"


def _both(rules, default):
    return _case(rules, default, 0), _case(rules, default, 1)


def sql_low(v, bands, missing):
    say = lambda w: f"'{w} (' || {_n(v, 2)} || ')'"
    rules = [(f"{v} IS NULL OR {v} <= 0", (0, f"'{missing}'"))] + [(f"{v} <= {th}", (p, say(w))) for th, p, w in bands[:-1]]
    return _both(rules, (bands[-1][1], say(bands[-1][2])))


def sql_roe(bands, low, bad, missing):
    say = lambda w: f"'{w} (' || {_n('roe', 1)} || '%)'"
    rules = [("roe IS NULL", (0, f"'{missing}'"))] + [(f"roe >= {th}", (p, say(w))) for th, p, w in bands] + [("roe > 0", (low[0], say(low[1])))]
    return _both(rules, (0, f"'{bad}'"))


def sql_sign(v, name):
    return _both([(f"{v} IS NULL", (0, f"'{name} 데이터 부족'")), (f"{v} > 0", (5, f"'{name} 흑자'"))], (0, f"'{name} 적자'"))


def _yoy(v):
    return f"(({v} - prev_{v}) / nullif(abs(prev_{v}), 0) * 100)"


def sql_growth(v, bands, prefix, first):
    say = lambda th, w: f"'{(prefix + ' ' + w).strip()} ({'+' if th is not None and th >= 0 else ''}' || {_n(_yoy(v), 1)} || '%)'"
    rules = first + [(f"{_yoy(v)} >= {th}", (p, say(th, w))) for th, p, w in bands[:-1]]
    return _both(rules, (bands[-1][1], say(None, bands[-1][2])))


def _turn(v, name, top):
    return [(f"{v} IS NULL OR prev_{v} IS NULL", (0, f"'{name} 성장 데이터 부족'")), (f"prev_{v} < 0 AND {v} > 0", (top, f"'{name} 흑자전환'")),
            (f"prev_{v} > 0 AND {v} < 0", (0, f"'{name} 적자전환'")), (f"{_yoy(v)} IS NULL", (0, f"'{name} 성장률 산출 불가'"))]


SQL_BLOCKS = {
    "value": [sql_low("per", S.PER_BANDS, "PER 산출 불가"), sql_low("pbr", S.PBR_BANDS, "PBR 산출 불가")],
    "profit": [sql_roe(S.ROE_BANDS, (3, "ROE 낮음"), "ROE 부진", "ROE 산출 불가"), sql_sign("operating_income", "영업이익"), sql_sign("net_income", "순이익")],
    "growth": [sql_growth("revenue", S.REVENUE_GROWTH, "", [(f"{_yoy('revenue')} IS NULL", (0, "'매출 성장 데이터 부족'"))]),
               sql_growth("operating_income", S.PROFIT_GROWTH, "영업이익", _turn("operating_income", "영업이익", 9)),
               sql_growth("net_income", S.INCOME_GROWTH, "순이익", _turn("net_income", "순이익", 8))],
    "stability": [_both([("total_equity IS NULL", (0, "'자본총계 데이터 부족'")), ("total_equity <= 0", (0, "'자본잠식 또는 자본총계 비정상'"))], (10, "'자본총계 양호'")),
                  sql_low("pbr", S.PBR_SAFETY, "PBR 기반 안정성 판단 제한"),
                  _both([("operating_income > 0", (3, "'영업이익 지속 가능성 양호'"))], (0, "NULL")),
                  _both([("net_income > 0", (2, "'순이익 지속 가능성 양호'"))], (0, "NULL")),
                  sql_roe(S.ROE_SAFETY, (1, "ROE 안정성 낮음"), "ROE 안정성 부진", "ROE 기반 안정성 판단 제한")],
}
SCORED = BASE + ", scored AS (SELECT *, " + ", ".join(
    f"CAST(least({' + '.join(p for p, _ in parts)}, 25) AS INTEGER) AS {k}_score, list_filter([{', '.join(w for _, w in parts)}], lambda x: x IS NOT NULL) AS {k}_reasons"
    for k, parts in SQL_BLOCKS.items()) + " FROM ratios)"
TOTAL = "(value_score + profit_score + growth_score + stability_score)"
OPINION = f"CASE WHEN {TOTAL} >= 85 THEN '적극매수' WHEN {TOTAL} >= 70 THEN '매수' WHEN {TOTAL} >= 55 THEN '보유' WHEN {TOTAL} >= 40 THEN '중립' ELSE '관망' END"


def _block_query(name, key):
    @query(name, f"WITH {SCORED} SELECT corp_code, year, {key}_score, array_to_string({key}_reasons, ' / ') AS reasons FROM scored")
    def _(t):
        return B.score_companies(ratios(t)).select("corp_code", "year", f"{key}_score", F.array_join(f"{key}_reasons", " / ").alias("reasons"))


for _nm, _key in (("b01_value_score", "value"), ("b02_profit_score", "profit"), ("b03_growth_score", "growth"), ("b04_stability_score", "stability")):
    _block_query(_nm, _key)


@query("b05_total_score", f"""WITH {SCORED} SELECT corp_code, year, {TOTAL} AS total_score, 25 - stability_score AS risk_score, {OPINION} AS investment_opinion,
  array_to_string((value_reasons[1:2] || profit_reasons[1:2] || growth_reasons[1:2] || stability_reasons[1:2])[1:6], ' / ') AS summary,
  round_even({_yoy('revenue')}, 2) AS revenue_yoy, round_even({_yoy('operating_income')}, 2) AS operating_income_yoy, round_even({_yoy('net_income')}, 2) AS net_income_yoy FROM scored""")
def _(t):
    return B.score_companies(ratios(t)).select(
        "corp_code", "year", "total_score", "risk_score", "investment_opinion", F.array_join("analysis_summary", " / ").alias("summary"),
        "revenue_yoy", "operating_income_yoy", "net_income_yoy")


def company_pairs(t):
    nxt = F.lpad((F.col("s_suppkey") + 1).cast("string"), 8, "0")
    return t.supplier.select(F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("company_a"), nxt.alias("company_b"))


@query("b12_compare_companies", f"""WITH {SCORED}, s AS (SELECT corp_code, year, {TOTAL} AS total FROM scored)
  SELECT a.year, a.corp_code AS company_a, b.corp_code AS company_b, a.total - b.total AS total_score_diff,
    CASE WHEN a.total > b.total THEN a.corp_code ELSE b.corp_code END AS winner
  FROM s a JOIN s b ON b.year = a.year AND CAST(b.corp_code AS BIGINT) = CAST(a.corp_code AS BIGINT) + 1""")
def _(t):
    return B.compare_companies(B.score_companies(ratios(t)), company_pairs(t))


EOK = lambda c: f"coalesce(format('{{:,.1f}}', round_even({c} / 1e8, 1)) || '억원', '정보없음')"
DEBT = "CASE WHEN total_liabilities <> 0 THEN round_even(total_liabilities / nullif(CAST(total_equity AS DOUBLE), 0) * 100, 1) END"


def account_cols():
    return {k: F.col(k) for k in B.ACCOUNT_KEYS}


@query("b09_summary_text", f"""WITH {ACCOUNTS} SELECT corp_code, year, {DEBT} AS debt_ratio, corp_code || '의 ' || year || '년 재무현황' || chr(10) || '매출액: ' || {EOK("revenue")} || chr(10)
  || '영업이익: ' || {EOK("operating_profit")} || chr(10) || '당기순이익: ' || {EOK("net_income")} || chr(10) || '자산총계: ' || {EOK("total_assets")} || chr(10) || '부채총계: ' || {EOK("total_liabilities")}
  || chr(10) || '자본총계: ' || {EOK("total_equity")} || chr(10) || '부채비율: ' || coalesce(printf('%.1f', {DEBT}) || '%', '정보없음') AS summary FROM accounts""")
def _(t):
    f = account_cols()
    return t.accounts_wide.select("corp_code", "year", S.debt_ratio(f["total_liabilities"], f["total_equity"]).alias("debt_ratio"),
                                  S.summary_text(F.col("corp_code"), F.col("year"), f).alias("summary"))


# report labels, in the order of the year they are tried with; the last is unknown
LABELS = ("유상증자", "사업보고서", "감사보고서", "전환사채", "자기주식", "합병·분할", "기타")
_HEAD = "'[' || label || ' · 신뢰도 87%] ' || corp_code || ' ' || year || '년'"
_DR = "coalesce(printf('%.1f', debt_ratio) || '%', '정보없음')"
_SALES = f"'매출액 ' || {EOK('revenue')} || ', 영업이익 ' || {EOK('operating_profit')} || ', 부채비율 ' || {_DR}"


@query("b10_insight_text", f"""WITH {ACCOUNTS}, x AS (SELECT *, {DEBT} AS debt_ratio, ['{"', '".join(LABELS)}'][1 + (year + CAST(corp_code AS BIGINT)) % 7] AS label FROM accounts)
  SELECT corp_code, year, {_HEAD} || CASE label
    WHEN '유상증자' THEN chr(10) || {_SALES} || chr(10) || CASE WHEN operating_profit < 0 THEN '영업손실(' || {EOK("operating_profit")} || ') 상태로, 재무 부담 완화를 위한 자금 조달로 판단됩니다.'
      WHEN debt_ratio > 200 THEN '부채비율(' || {_DR} || ')이 높아 추가 차입보다 주식 발행을 선택한 것으로 보입니다.' ELSE '영업이익 ' || {EOK("operating_profit")} || ' 상태에서 시설투자 또는 사업 확장을 위한 자금 조달로 보입니다.' END
    WHEN '사업보고서' THEN chr(10) || '매출액 ' || {EOK("revenue")} || ', 영업이익 ' || {EOK("operating_profit")} || ', 당기순이익 ' || {EOK("net_income")} || chr(10) || '해당 연도 순이익 기준 ' || CASE WHEN net_income > 0 THEN '흑자' ELSE '적자' END || ' 상태입니다.'
    WHEN '감사보고서' THEN chr(10) || '자산총계 ' || {EOK("total_assets")} || ', 부채총계 ' || {EOK("total_liabilities")} || ', 자본총계 ' || {EOK("total_equity")} || ', 부채비율 ' || {_DR} || chr(10) || '재무 건전성 지표를 기반으로 감사보고서를 검토하세요.'
    WHEN '전환사채' THEN chr(10) || {_SALES} || chr(10) || CASE WHEN debt_ratio > 200 THEN '부채비율(' || {_DR} || ')이 높은 상황에서 전환사채 발행은 추가 재무 부담으로 작용할 수 있습니다.'
      WHEN operating_profit < 0 THEN '영업손실(' || {EOK("operating_profit")} || ') 상태에서 전환사채 발행은 향후 주주 가치 희석 리스크를 내포합니다.' ELSE '전환사채 발행을 통한 자금 조달로, 향후 주식 전환 시 주주 희석 가능성을 검토하세요.' END
    WHEN '자기주식' THEN chr(10) || '매출액 ' || {EOK("revenue")} || ', 당기순이익 ' || {EOK("net_income")} || ', 자본총계 ' || {EOK("total_equity")} || chr(10) || CASE WHEN net_income > 0 THEN '순이익(' || {EOK("net_income")} || ') 흑자 상태에서의 자기주식 취득은 주주환원 정책으로 해석할 수 있습니다.' ELSE '자기주식 취득·처분 내용을 재무 현황과 함께 검토하세요.' END
    WHEN '합병·분할' THEN chr(10) || '자산총계 ' || {EOK("total_assets")} || ', 매출액 ' || {EOK("revenue")} || ', 부채비율 ' || {_DR} || chr(10) || '합병·분할은 기업 구조 변경을 수반하므로 거래 조건 및 합병비율을 공시 원문에서 확인하세요.'
    ELSE ' 재무 데이터를 확인하세요.' END AS insight FROM x""")
def _(t):
    f = account_cols()
    f["debt_ratio"] = S.debt_ratio(f["total_liabilities"], f["total_equity"])
    pick = (1 + (F.col("year") + F.col("corp_code").cast("bigint")) % 7).cast("int")
    label = F.element_at(F.array(*[F.lit(x) for x in LABELS]), pick)
    return t.accounts_wide.select("corp_code", "year", S.insight_text(label, F.lit(0.87), F.col("corp_code"), F.col("year"), f).alias("insight"))


_PRICE_TEXT = "'PER: ' || coalesce(printf('%.2f', round_even(per, 2)), 'N/A (적자)') || chr(10) || 'PBR: ' || coalesce(printf('%.2f', round_even(x, 2)), 'N/A')"


@query("b11_integrity", f"""WITH {BASE}, i AS (SELECT corp_code, year, per, CASE WHEN pbr IS NULL THEN NULL WHEN year = 1999 THEN -pbr ELSE pbr * 4 END AS x, year % 5 * 30 AS news, year % 3 * 12 AS macro FROM ratios),
  z AS (SELECT *, CAST(round_even(per, 2) AS DOUBLE) AS p, CAST(round_even(x, 2) AS DOUBLE) AS b FROM i)
  SELECT corp_code, year, CAST(greatest(0, 100 - CASE WHEN per IS NULL OR x IS NULL THEN 40 ELSE 0 END - CASE WHEN p > 50 THEN 40 WHEN p < 0 THEN 20 ELSE 0 END
    - CASE WHEN b > 10 THEN 30 WHEN b < 0 THEN 20 ELSE 0 END - CASE WHEN news < 100 THEN 20 ELSE 0 END - CASE WHEN macro < 20 THEN 10 ELSE 0 END) AS INTEGER) AS score,
    len(list_filter([per IS NULL OR x IS NULL, coalesce(p > 50 OR p < 0, false), coalesce(b > 10 OR b < 0, false), news < 100, macro < 20], lambda f: f)) AS n_reasons FROM z""")
def _(t):
    text = lambda c, none: F.coalesce(N.fixed(c, 2), F.lit(none))
    x = F.when(F.col("year") == 1999, -F.col("pbr")).otherwise(F.col("pbr") * 4)
    price = F.concat(F.lit("PER: "), text(F.col("per"), "N/A (적자)"), F.lit("\nPBR: "), text(x, "N/A"))
    news = F.repeat(F.lit("n"), (F.col("year") % 5 * 30).cast("int"))
    macro = F.repeat(F.lit("m"), (F.col("year") % 3 * 12).cast("int"))
    return ratios(t).select("corp_code", "year", S.integrity(price, news, macro).alias("i")).select(
        "corp_code", "year", "i.score", F.size("i.reasons").cast("bigint").alias("n_reasons"))


# --- prices -----------------------------------------------------------------------------------------
@query("a28_market_snapshot", f"""WITH {PRICES}, {LISTING}, m AS (SELECT max(date) AS today FROM prices)
  SELECT p.code, arg_max(p.close, p.date) AS close, max(p.high) AS high_52w, min(p.low) AS low_52w, any_value(l.marcap) AS market_cap, true AS listed
  FROM prices p JOIN m ON p.date BETWEEN m.today - 365 AND m.today LEFT JOIN listing l ON l.code = p.code GROUP BY 1""")
def _(t):
    today = t.lineitem.agg(F.max(F.to_date("l_shipdate"))).scalar()
    return B.market_snapshot(t.prices, t.listing, today)


@query("a29_period_change", f"""WITH {PRICES} SELECT code, first_close, last_close, round((last_close - first_close) / CAST(first_close AS DOUBLE) * 100, 6) AS change_pct
  FROM (SELECT code, arg_min(close, date) AS first_close, arg_max(close, date) AS last_close FROM prices GROUP BY 1) WHERE first_close <> 0""")
def _(t):
    return r(B.period_change(t.prices))


# --- sentiment ---------------------------------------------------------------------------------------
def scored_articles(t):
    kind = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    docs = t.documents.select("doc_id", F.concat_ws("/", "source", "lang").alias("company"), "n_chars")
    return docs.join(t.labels, "doc_id").select("company", kind.alias("sentiment"), (F.col("n_chars") / 25000.0).alias("score"))


ARTICLES = """articles AS (SELECT source || '/' || lang AS company, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
  n_chars / 25000.0 AS score FROM documents JOIN labels USING (doc_id))"""


@query("a26_sentiment_shares", f"""WITH {ARTICLES}, c AS (SELECT d.company, count(a.sentiment) AS n, count(*) FILTER (WHERE sentiment = 'positive') AS p,
    count(*) FILTER (WHERE sentiment = 'negative') AS g, count(*) FILTER (WHERE sentiment = 'neutral') AS u
    FROM (SELECT DISTINCT source || '/' || lang AS company FROM documents) d LEFT JOIN articles a USING (company) GROUP BY 1)
  SELECT company, CASE WHEN n = 0 THEN '중립' WHEN p >= g AND p >= u THEN '긍정' WHEN g >= u THEN '부정' ELSE '중립' END AS label,
    CASE WHEN n = 0 THEN 0.0 ELSE round_even(p / CAST(n AS DOUBLE), 3) END AS positive_ratio, CASE WHEN n = 0 THEN 0.0 ELSE round_even(g / CAST(n AS DOUBLE), 3) END AS negative_ratio,
    CASE WHEN n = 0 THEN 0.0 ELSE round_even(u / CAST(n AS DOUBLE), 3) END AS neutral_ratio FROM c""")
def _(t):
    companies = t.documents.select(F.concat_ws("/", "source", "lang").alias("company"))
    return B.sentiment_shares(scored_articles(t), companies)


@query("a27_sentiment_table", f"""WITH {ARTICLES} SELECT company, count(*) FILTER (WHERE sentiment = 'positive') AS positive, count(*) FILTER (WHERE sentiment = 'negative') AS negative,
  count(*) FILTER (WHERE sentiment = 'neutral') AS neutral, round(avg(score), 6) AS mean_score FROM articles GROUP BY 1""")
def _(t):
    return r(B.sentiment_table(scored_articles(t)))


# --- filings ---------------------------------------------------------------------------------------
@query("w13_latest_filings", f"""WITH {FILINGS} SELECT corp_name, rcept_no, rcept_dt, CAST(rk AS INTEGER) AS rk FROM (SELECT *, row_number() OVER (PARTITION BY corp_name ORDER BY rcept_dt DESC, rcept_no) AS rk
  FROM filings WHERE label IN ('en', 'de', 'fr')) WHERE rk <= 5""")
def _(t):
    rows = t.filings.select("corp_name", "rcept_no", "rcept_dt", "label")
    frames = [rows.where(F.col("label") == lb).drop("label") for lb in ("en", "de", "fr")]
    return B.latest_filings(frames, 5)


@query("w14_first_important", f"""WITH {FILINGS} SELECT corp_name, rcept_no FROM (SELECT *, row_number() OVER (PARTITION BY corp_name
  ORDER BY NOT (contains(text, 'password') OR contains(text, 'license')), rcept_no) AS k FROM filings) WHERE k = 1""")
def _(t):
    rows = t.filings.select("corp_name", "rcept_no", any_keyword(F.col("text"), ["password", "license"]).alias("hit"))
    return B.first_important(rows, F.col("hit"), "rcept_no").select("corp_name", "rcept_no")


# --- modes, sessions, freshness ----------------------------------------------------------------------
MODE_WORDS = ("성장 분석", "리스크 점검", "밸류 평가", "가치 평가", "수익 구조", "종합 분석", None)


@query("p28_normalize_mode", """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'growth' WHEN 1 THEN 'risk' WHEN 2 THEN 'value' WHEN 3 THEN 'value' WHEN 4 THEN 'profit' ELSE 'total' END AS mode FROM orders""")
def _(t):
    word = F.element_at(F.array(*[F.lit(w) for w in MODE_WORDS]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    text = F.concat("o_orderpriority", F.lit(" "), word)
    return t.orders.select("o_orderkey", S.normalize_mode(text).alias("mode"))


KST = "(ts + INTERVAL 9 HOUR)"
OPEN_SQL = f"""(dayofweek({KST}) BETWEEN 1 AND 5 AND strftime({KST}, '%m-%d') NOT IN ('05-01', '12-31', '01-01')
  AND CAST({KST} AS TIME) BETWEEN TIME '09:00:00' AND TIME '15:30:00')"""


def sessions(t):
    ts = F.col("ts").cast("timestamp")
    holidays = t.events.select(F.to_date("ts").alias("holiday")).distinct().where(F.date_format("holiday", "MM-dd") == "01-01")
    local_day = F.to_date(F.from_utc_timestamp(ts, "+09:00"))
    return B.mark_sessions(t.events, C.is_session_open(ts), holidays, local_day)


@query("p29_session_flag", f"SELECT event_id, {OPEN_SQL} AS session_open FROM events")
def _(t):
    return sessions(t).select("event_id", "session_open")


@query("p30_freshness", f"SELECT event_id, NOT {OPEN_SQL} OR value * 20 < 180 AS fresh FROM events")
def _(t):
    return sessions(t).select("event_id", B.is_fresh(F.col("session_open"), F.col("value") * 20).alias("fresh"))
