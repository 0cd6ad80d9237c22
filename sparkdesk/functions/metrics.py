"""Metric catalogue: key, label and unit of every panel metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Metric key, label, unit.
PANEL_METRICS = (
    ("total_usage", "전체 전력사용량", "MWh"),
    ("gas_supply", "가스 수급가구수", "가구"),
    ("gas_supply_ratio", "가스 보급률", ""),
    ("total_resident_population", "총상주인구", "명"),
    ("total_households", "총가구수", "가구"),
    ("home_ratio", "가정용 전력 비율", ""),
    ("public_ratio", "공공용 전력 비율", ""),
    ("service_ratio", "서비스업 전력 비율", ""),
    ("industry_ratio", "산업용 전력 비율", ""),
    ("home_usage", "가정용 전력사용량", "MWh"),
    ("public_usage", "공공용 전력사용량", "MWh"),
    ("service_usage", "서비스업 전력사용량", "MWh"),
    ("industry_usage", "산업용 전력사용량", "MWh"),
)
SUPPLY_METRICS = (
    ("gas_supply", "가정용 도시가스 수급가구수", "가구"),
    ("avg_income", "월 평균 소득", "원"),
    ("total_pop", "총인구", "명"),
    ("total_households", "총가구수", "가구"),
)
# Short series labels used in trend and KPI rows.
SERIES_LABELS = (
    ("total_usage", "전체 전력사용량", "MWh"),
    ("home_usage", "가정용", "MWh"),
    ("public_usage", "공공용", "MWh"),
    ("service_usage", "서비스업", "MWh"),
    ("industry_usage", "산업용", "MWh"),
    ("total_resident_population", "총상주인구", "명"),
)
# Names of joint directions by the signs of population and metric, and the name of all other cases.
USAGE_TRENDS = ((-1, 1, "인구 감소와 사용량 증가"), (1, -1, "인구 증가와 사용량 감소"), (-1, -1, "동반 감소"), (1, 1, "동반 증가"))
USAGE_TREND_ELSE = "정체"
SUPPLY_TRENDS = ((-1, 1, "인구 감소와 수급 증가"), (1, -1, "인구 증가와 수급 감소"), (-1, -1, "동반 감소"), (1, 1, "동반 증가"))
SUPPLY_TREND_ELSE = "정체와 수급 증가"
CLUSTER_LABELS = (
    (0, "고소득 다인가구 주거지"),
    (1, "표준 중산층 주거지"),
    (2, "소규모 1~2인 가구 지역"),
    (3, "대규모 1~2인 가구 혼합지역"),
)


def metric_table(spark: SparkSession, metrics=PANEL_METRICS) -> DataFrame:
    """The catalogue as a DataFrame; a literal table of a dozen rows, so its size is known."""
    return spark.createDataFrame(list(metrics), "key string, label string, unit string")


def cluster_label_table(spark: SparkSession, labels=CLUSTER_LABELS) -> DataFrame:
    return spark.createDataFrame(list(labels), "cluster int, cluster_label string")
