"""Sentences as templates, and one filler for all of them."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkdesk.functions.cleaning import fixed, grouped

# The sentences of the fact texts. A field is a column; after the colon stands its unit (whole numbers with
# grouped digits) or its number of decimals (".1"); without one it is put in as it is.
TREND_LINE = "  {year}년: 전체 {total:MWh}, {label} {value}, 인구 {people:명}"
TREND = "{district} {label} 추세 ({start_year}→{end_year}):\n  {start_year}년 {first} → {end_year}년 {last} ({percent:.1}% {status})\n연도별 상세:\n{detail}"
COMPARISON_SIDE = (
    "{district}: 전체 {total_usage:MWh}, 가정용 {home_usage:MWh}({home:.1}%), 서비스업 {service_usage:MWh}({service:.1}%), "
    "산업용 {industry_usage:MWh}({industry:.1}%), 공공용 {public_usage:MWh}({public:.1}%). 상주인구 {total_resident_population:명}.")
COMPARISON = "{year}년 기준.\n{side_a}\n{side_b}\n전체 전력사용량은 {higher}가 더 높으며, 차이는 {gap:MWh}({percent:.1}%)."
CLUSTER = (
    "{year}년 {district}는 Cluster {cluster_label}({cluster})에 속한다. 전체 전력사용량 {total:MWh}, 가정용 {home_usage:MWh}({home:.1}%), "
    "서비스업 {service_usage:MWh}({service:.1}%), 산업용 {industry_usage:MWh}({industry:.1}%). 상주인구 {total_resident_population:명}.")
CITY = (
    "{year}년 {city}전체 전력사용량: {total_usage:MWh} (가정용 {home_usage:MWh}, 공공용 {public_usage:MWh}, 서비스업 {service_usage:MWh}, "
    "산업용 {industry_usage:MWh}). 자치구별 평균 {usage_per_district:MWh}. 총 상주인구 {total_resident_population:명} (자치구별 평균 {people_per_district:명}).")


def fill(template: str, **columns: Column) -> Column:
    """The template with its fields; a field that isn't given is the column of its name."""
    parts = []
    for literal, field, unit, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            value = columns.get(field, F.col(field))
            if unit.startswith("."):
                parts.append(fixed(value, int(unit[1:])))
            else:
                parts.append(grouped(value, unit) if unit else value.cast("string"))
    return F.concat(*parts)
