"""Question tagging and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkdesk.functions.rules import any_keyword, first_match

# District names, stop words, metric words, routing words.
DISTRICTS = (
    "강남구", "강동구", "강북구", "강서구", "관악구", "광진구", "구로구", "금천구", "노원구", "도봉구", "동대문구", "동작구", "마포구",
    "서대문구", "서초구", "성동구", "성북구", "송파구", "양천구", "영등포구", "용산구", "은평구", "종로구", "중구", "중랑구",
)
NOT_DISTRICTS = ("가구", "가구수", "수급가구", "가구수변화")
USAGE_WORDS = (
    (("전체 전력", "총 전력", "전력 전체", "전체 사용량", "총 사용량"), "total_usage"),
    (("가정용", "가정 전력"), "home_usage"),
    (("서비스", "상업"), "service_usage"),
    (("산업", "공업", "제조"), "industry_usage"),
    (("공공", "관공서"), "public_usage"),
    (("인구", "주민", "상주"), "total_resident_population"),
    (("가구수", "세대수"), "total_households"),
)
SUPPLY_WORDS = (
    (("소득", "수입", "벌이", "급여"), "avg_income"),
    (("인구", "명수", "주민"), "total_pop"),
    (("수급", "가스", "공급"), "gas_supply"),
    (("가구수", "세대수", "집수"), "total_households"),
)
LIST_WORDS = ("속한", "목록", "어디", "어느")
TREND_WORDS = ("수급", "가스", "전력", "전기", "소비", "인구", "가구", "변화", "추이", "현황", "보급", "비율")
SUPPLY_TREND_WORDS = ("수급", "가스수급", "수급가구수", "소득", "인구", "가구", "변화", "추이", "현황")
CITY_WORD = "서울"
DISTRICT_PATTERN = r"([가-힣]{2,}구)"
YEAR_PATTERN = r"(20\d{2})년?"
CLUSTER_PATTERN = r"(?i)(?:클러스터|cluster|군집|집단)\s*(\d+)"
SUPPLY_CLUSTER_PATTERN = r"(?i)(?:클러스터|cluster|군집)\s*(\d+)"


def districts(question: Column, allowed: Sequence[str] | None = DISTRICTS, blocked: Sequence[str] = NOT_DISTRICTS) -> Column:
    """District names in order of appearance: from a list, or anything but the stop words."""
    found = F.array_distinct(F.regexp_extract_all(question, F.lit(DISTRICT_PATTERN), F.lit(1)))
    words = lambda names: F.array(*[F.lit(n) for n in names])
    return F.array_intersect(found, words(allowed)) if allowed is not None else F.array_except(found, words(blocked))


def metric(question: Column, words=USAGE_WORDS, default: str = "total_usage") -> Column:
    return first_match([(any_keyword(question, ws), key) for ws, key in words], default)


def tag(question: Column, allowed: Sequence[str] | None = DISTRICTS, words=USAGE_WORDS, default: str = "total_usage",
        cluster: str = CLUSTER_PATTERN) -> Column:
    """struct(districts, district, year, metric, cluster_id) of a question."""
    found = districts(question, allowed)
    number = lambda pattern: F.regexp_extract(question, pattern, 1).try_cast("int")
    return F.struct(
        found.alias("districts"), F.get(found, F.lit(0)).alias("district"), number(YEAR_PATTERN).alias("year"),
        metric(question, words, default).alias("metric"), number(cluster).alias("cluster_id"),
    )


def route(question: Column, tags: Column, city: str = CITY_WORD, trend_words: Sequence[str] = TREND_WORDS) -> Column:
    """Which kind of answer a question asks for."""
    n = F.size(tags["districts"])
    return first_match(
        [
            (question.contains(city) & (n == 0), "overview"),
            (n >= 2, "compare"),
            (tags["cluster_id"].isNotNull() & any_keyword(question, LIST_WORDS), "cluster_list"),
            ((n == 1) & any_keyword(question, trend_words), "trend"),
            (n == 1, "cluster"),
        ],
        "general",
    )
