"""Company scoring: point tables as data, compiled to CASE expressions.

Each block returns a struct(score, reasons); a reason array keeps the order of the checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkdesk.functions.cleaning import fixed, hundred_millions, yoy

# Fixed values: (threshold, points, reason text); "<=" tables go up, ">=" tables go down.
PER_BANDS = ((8, 15, "PER 매우 낮음"), (12, 13, "PER 매력적"), (18, 10, "PER 무난"), (25, 6, "PER 다소 높음"), (None, 2, "PER 부담"))
PBR_BANDS = ((1, 10, "PBR 저평가 구간"), (1.5, 8, "PBR 양호"), (2.5, 6, "PBR 무난"), (3.5, 3, "PBR 다소 높음"), (None, 1, "PBR 부담"))
PBR_SAFETY = ((1, 5, "PBR 안정 구간"), (2, 4, "PBR 무난"), (3, 3, "PBR 다소 높음"), (5, 1, "PBR 부담 구간"), (None, 0, "PBR 과열 구간"))
ROE_BANDS = ((20, 15, "ROE 매우 우수"), (15, 13, "ROE 우수"), (10, 10, "ROE 양호"), (5, 6, "ROE 보통"))
ROE_SAFETY = ((15, 5, "ROE 안정성 우수"), (10, 4, "ROE 안정성 양호"), (5, 2, "ROE 안정성 보통"))
REVENUE_GROWTH = ((20, 8, "매출 고성장"), (10, 6, "매출 성장"), (3, 4, "매출 완만 성장"), (0, 2, "매출 보합"), (-5, 1, "매출 소폭 감소"), (None, 0, "매출 감소"))
PROFIT_GROWTH = ((30, 9, "고성장"), (15, 7, "성장"), (5, 5, "완만 성장"), (0, 3, "보합"), (-10, 1, "소폭 감소"), (None, 0, "감소"))
INCOME_GROWTH = ((30, 8, "고성장"), (15, 6, "성장"), (5, 4, "완만 성장"), (0, 2, "보합"), (-10, 1, "소폭 감소"), (None, 0, "감소"))
OPINIONS = ((85, "적극매수"), (70, "매수"), (55, "보유"), (40, "중립"), (None, "관망"))


def _item(points: int, reason: Column | str) -> Column:
    return F.struct(F.lit(points).alias("points"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))


def _ladder(head: Sequence[tuple[Column, Column]], default: Column) -> Column:
    out = None
    for cond, item in head:
        out = F.when(cond, item) if out is None else out.when(cond, item)
    return default if out is None else out.otherwise(default)


# A rung: its condition (None for the last), points, word, and the opening of the bracket that shows the value, if it does.
Rung = tuple[Column | None, int, str, str | None]


def _rated(rungs: Sequence[Rung], value: Column, digits: int, closing: str) -> Column:
    """The item of the first rung that holds. The rung is found as a number; points and words are looked up in literal
    arrays and the value is put into text once, not once per rung."""
    number = _ladder([(cond, F.lit(i)) for i, (cond, *_) in enumerate(rungs[:-1], 1)], F.lit(len(rungs)))
    points = F.element_at(F.lit([p for _, p, _, _ in rungs]), number)
    opening = F.element_at(F.lit([f"{word} ({shown}" if shown is not None else word for _, _, word, shown in rungs]), number)
    shows = F.element_at(F.lit([shown is not None for *_, shown in rungs]), number)
    reason = F.when(shows, F.concat(opening, fixed(value, digits), F.lit(closing))).otherwise(opening)
    return F.struct(points.alias("points"), reason.alias("reason"))


def _low_is_good(value: Column, bands, missing: str) -> Column:
    rungs: list[Rung] = [(value.isNull() | (value <= 0), 0, missing, None)]
    rungs += [(value <= th if th is not None else None, p, w, "") for th, p, w in bands]
    return _rated(rungs, value, 2, ")")


def _roe(value: Column, bands, low: tuple[int, str], bad: str, missing: str) -> Column:
    rungs: list[Rung] = [(value.isNull(), 0, missing, None)]
    rungs += [(value >= th, p, w, "") for th, p, w in bands]
    rungs += [(value > 0, low[0], low[1], ""), (None, 0, bad, None)]
    return _rated(rungs, value, 1, "%)")


def _growth(rate: Column, bands, prefix: str = "") -> list[Rung]:
    return [(None if th is None else rate >= th, p, f"{prefix} {w}".strip(), "+" if th is not None and th >= 0 else "") for th, p, w in bands]


def _sign(value: Column, name: str) -> Column:
    return _ladder(
        [(value.isNull(), _item(0, f"{name} 데이터 부족")), (value > 0, _item(5, f"{name} 흑자"))], _item(0, f"{name} 적자"))


def _block(*items: Column) -> Column:
    rows = F.array_compact(F.array(*items))
    score = F.least(F.aggregate(rows, F.lit(0), lambda a, x: a + x["points"]), F.lit(25))
    return F.struct(score.alias("score"), F.transform(rows, lambda x: x["reason"]).alias("reasons"))


def value_block(per: Column, pbr: Column) -> Column:
    """Price level, up to 25 points (B1)."""
    return _block(_low_is_good(per, PER_BANDS, "PER 산출 불가"), _low_is_good(pbr, PBR_BANDS, "PBR 산출 불가"))


def profit_block(roe: Column, operating: Column, net: Column) -> Column:
    """Profitability, up to 25 points (B2)."""
    return _block(_roe(roe, ROE_BANDS, (3, "ROE 낮음"), "ROE 부진", "ROE 산출 불가"), _sign(operating, "영업이익"), _sign(net, "순이익"))


def _profit_growth(cur: Column, prev: Column, name: str, bands) -> Column:
    rate = yoy(cur, prev)
    rungs: list[Rung] = [
        (cur.isNull() | prev.isNull(), 0, f"{name} 성장 데이터 부족", None),
        ((prev < 0) & (cur > 0), bands[0][1], f"{name} 흑자전환", None),
        ((prev > 0) & (cur < 0), 0, f"{name} 적자전환", None),
        (rate.isNull(), 0, f"{name} 성장률 산출 불가", None),
    ]
    return _rated([*rungs, *_growth(rate, bands, name)], rate, 1, "%)")


def growth_block(rev: Column, prev_rev: Column, op: Column, prev_op: Column, net: Column, prev_net: Column) -> Column:
    """Growth over last year, up to 25 points; turning to profit counts in full."""
    rate = yoy(rev, prev_rev)
    revenue = _rated([(rate.isNull(), 0, "매출 성장 데이터 부족", None), *_growth(rate, REVENUE_GROWTH)], rate, 1, "%)")
    return _block(revenue, _profit_growth(op, prev_op, "영업이익", PROFIT_GROWTH), _profit_growth(net, prev_net, "순이익", INCOME_GROWTH))


def stability_block(equity: Column, pbr: Column, roe: Column, op: Column, net: Column) -> Column:
    """Stability, up to 25 points."""
    capital = _ladder(
        [(equity.isNull(), _item(0, "자본총계 데이터 부족")), (equity <= 0, _item(0, "자본잠식 또는 자본총계 비정상"))],
        _item(10, "자본총계 양호"))
    return _block(
        capital,
        _low_is_good(pbr, PBR_SAFETY, "PBR 기반 안정성 판단 제한"),
        F.when(op > 0, _item(3, "영업이익 지속 가능성 양호")),
        F.when(net > 0, _item(2, "순이익 지속 가능성 양호")),
        _roe(roe, ROE_SAFETY, (1, "ROE 안정성 낮음"), "ROE 안정성 부진", "ROE 기반 안정성 판단 제한"),
    )


def opinion(total: Column) -> Column:
    """Opinion word of a total score."""
    rules = [(total >= th, F.lit(w)) for th, w in OPINIONS if th is not None]
    return _ladder(rules, F.lit(OPINIONS[-1][1]))


# --- data integrity -----------------------------------------------------------------------------
def integrity(price_text: Column, news_text: Column, macro_text: Column) -> Column:
    """struct(score, reasons, status) of a company's collected texts."""
    numbers = lambda name: F.transform(F.regexp_extract_all(price_text, F.lit(rf"{name}:\s*([-\d\.]+)"), F.lit(1)),
                                       lambda x: x.try_cast("double"))
    per, pbr = numbers("PER"), numbers("PBR")
    cost = lambda arr, top, lost: F.aggregate(
        arr, F.lit(0), lambda a, x: a + F.when(x > top, lost).when(x < 0, 20).otherwise(0))
    say = lambda arr, top, high, low: F.array_compact(F.transform(
        arr, lambda x: F.when(x > top, F.concat(F.lit(high), x.cast("string"), F.lit("x)")))
        .when(x < 0, F.concat(F.lit(low), x.cast("string"), F.lit("x)")))))
    missing = price_text.contains("[HARD_DATA_ERROR]") | price_text.contains("N/A")
    unread = F.exists(per, lambda x: x.isNull()) | F.exists(pbr, lambda x: x.isNull())
    few_news, few_macro = F.length(F.trim(news_text)) < 100, F.length(F.trim(macro_text)) < 20
    lost = (
        F.when(missing, 40).otherwise(0) + cost(per, 50, 40) + cost(pbr, 10, 30) + F.when(unread, 20).otherwise(0)
        + F.when(few_news, 20).otherwise(0) + F.when(few_macro, 10).otherwise(0)
    )
    score = F.greatest(F.lit(100) - lost, F.lit(0))
    word = lambda cond, text: F.array_compact(F.array(F.when(cond, text)))
    # fixed values: reasons and status words
    reasons = F.concat(
        word(missing, "핵심 정량 지표 누락"),
        say(per, 50, "치명적 이상치 감지 (PER ", "적자 상태 감지 (PER 음수: "),
        say(pbr, 10, "치명적 이상치 감지 (PBR ", "비정상 수치 감지 (PBR 음수: "),
        word(unread, "정량 지표 상식 검증 실패"),
        word(few_news, "뉴스 컨텍스트 부족"),
        word(few_macro, "거시경제 컨텍스트 부족"),
    )
    status = (
        F.when(score >= 80, "신뢰 가능 (수치 검증 통과)").when(score >= 50, "주의 요망 (데이터 오염 가능성)")
        .otherwise("위험 (수치 신뢰도 붕괴, 판단 보류 권장)")
    )
    return F.struct(score.alias("score"), reasons.alias("reasons"), status.alias("status"))


# --- sentences ------------------------------------------------------------------------------------
def debt_ratio(liabilities: Column, equity: Column) -> Column:
    """Liabilities over equity in percent, one decimal; null where either is absent or 0."""
    return F.when(liabilities != 0, F.bround(liabilities / F.nullif(equity.cast("double"), F.lit(0.0)) * 100, 1))


def summary_text(name: Column, year: Column, f: dict[str, Column]) -> Column:
    """Eight-line statement summary."""
    ratio = debt_ratio(f["total_liabilities"], f["total_equity"])
    # fixed values: line titles
    rows = (("매출액", "revenue"), ("영업이익", "operating_profit"), ("당기순이익", "net_income"),
            ("자산총계", "total_assets"), ("부채총계", "total_liabilities"), ("자본총계", "total_equity"))
    return F.concat_ws(
        "\n",
        F.concat(name, F.lit("의 "), year.cast("string"), F.lit("년 재무현황")),
        *[F.concat(F.lit(f"{title}: "), hundred_millions(f[key])) for title, key in rows],
        F.concat(F.lit("부채비율: "), F.coalesce(F.concat(fixed(ratio, 1), F.lit("%")), F.lit("정보없음"))),
    )


def insight_text(label: Column, score: Column, name: Column, year: Column, f: dict[str, Column]) -> Column:
    """Label-specific reading of the ratios."""
    m = lambda key: hundred_millions(f[key])
    op, net, ratio = f["operating_profit"], f["net_income"], f["debt_ratio"]
    dr = F.coalesce(F.concat(fixed(ratio, 1), F.lit("%")), F.lit("정보없음"))
    head = F.concat(F.lit("["), label, F.lit(" · 신뢰도 "), fixed(score * 100, 0), F.lit("%] "),
                    name, F.lit(" "), year.cast("string"), F.lit("년"))

    def lines(*rest: Column) -> Column:
        return F.concat_ws("\n", head, *rest)

    def row(*pairs: tuple[str, Column]) -> Column:
        parts = []
        for i, (title, value) in enumerate(pairs):
            parts += [F.lit((", " if i else "") + title + " "), value]
        return F.concat(*parts)

    lit = F.lit
    issue = (
        F.when(op < 0, F.concat(lit("영업손실("), m("operating_profit"), lit(") 상태로, 재무 부담 완화를 위한 자금 조달로 판단됩니다.")))
        .when(ratio > 200, F.concat(lit("부채비율("), dr, lit(")이 높아 추가 차입보다 주식 발행을 선택한 것으로 보입니다.")))
        .otherwise(F.concat(lit("영업이익 "), m("operating_profit"), lit(" 상태에서 시설투자 또는 사업 확장을 위한 자금 조달로 보입니다.")))
    )
    bond = (
        F.when(ratio > 200, F.concat(lit("부채비율("), dr, lit(")이 높은 상황에서 전환사채 발행은 추가 재무 부담으로 작용할 수 있습니다.")))
        .when(op < 0, F.concat(lit("영업손실("), m("operating_profit"), lit(") 상태에서 전환사채 발행은 향후 주주 가치 희석 리스크를 내포합니다.")))
        .otherwise(lit("전환사채 발행을 통한 자금 조달로, 향후 주식 전환 시 주주 희석 가능성을 검토하세요."))
    )
    own = F.when(net > 0, F.concat(lit("순이익("), m("net_income"), lit(") 흑자 상태에서의 자기주식 취득은 주주환원 정책으로 해석할 수 있습니다."))).otherwise(
        lit("자기주식 취득·처분 내용을 재무 현황과 함께 검토하세요."))
    sales_op = row(("매출액", m("revenue")), ("영업이익", m("operating_profit")), ("부채비율", dr))
    return (
        F.when(label == "유상증자", lines(sales_op, issue))
        .when(label == "사업보고서", lines(
            row(("매출액", m("revenue")), ("영업이익", m("operating_profit")), ("당기순이익", m("net_income"))),
            F.concat(lit("해당 연도 순이익 기준 "), F.when(net > 0, "흑자").otherwise("적자"), lit(" 상태입니다."))))
        .when(label == "감사보고서", lines(
            row(("자산총계", m("total_assets")), ("부채총계", m("total_liabilities")), ("자본총계", m("total_equity")), ("부채비율", dr)),
            lit("재무 건전성 지표를 기반으로 감사보고서를 검토하세요.")))
        .when(label == "전환사채", lines(sales_op, bond))
        .when(label == "자기주식", lines(
            row(("매출액", m("revenue")), ("당기순이익", m("net_income")), ("자본총계", m("total_equity"))), own))
        .when(label == "합병·분할", lines(
            row(("자산총계", m("total_assets")), ("매출액", m("revenue")), ("부채비율", dr)),
            lit("합병·분할은 기업 구조 변경을 수반하므로 거래 조건 및 합병비율을 공시 원문에서 확인하세요.")))
        .otherwise(F.concat(head, lit(" 재무 데이터를 확인하세요.")))
    )


def normalize_mode(text: Column) -> Column:
    """Free analysis-mode text to one of five keys."""
    t = F.coalesce(text, F.lit(""))
    # fixed values: words and keys
    return (
        F.when(t.contains("성장"), "growth").when(t.contains("리스크"), "risk")
        .when(t.contains("밸류") | t.contains("가치"), "value").when(t.contains("수익"), "profit").otherwise("total")
    )
