"""Wide/long reshaping, spines and completeness checks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.functions.cleaning import SUBTOTAL_NAMES, clean_number
from sparkdesk.operators.ordered import number_rows
from sparkdesk.session import materialize


def melt_years(wide: DataFrame, key: str, years: Sequence[str], value: str) -> DataFrame:
    """Year columns to (key, year, value); unreadable cells are dropped (P5)."""
    long = wide.unpivot([key], list(years), "year", "_text")
    return long.select(
        key, F.regexp_extract("year", r"(\d{4})", 1).cast("bigint").alias("year"), clean_number("_text").alias(value)
    ).dropna(subset=[value])


def melt_matching(wide: DataFrame, key: str, pattern: str, name: str, value: str) -> DataFrame:
    """Unpivot every column whose name matches a pattern."""
    cols = [c for c in wide.columns if re.search(pattern, c)]
    return wide.unpivot([key], [F.col(f"`{c}`") for c in cols], name, value)


def melt_blocks(wide: DataFrame, key: str, blocks: dict[int, Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Several columns per year to one row per (key, year)."""
    rows = F.array(*[
        F.struct(F.lit(y).cast("bigint").alias("year"), *[clean_number(c).alias(n) for c, n in zip(cols, names)])
        for y, cols in blocks.items()
    ])
    return wide.select(key, F.inline(rows))


def widen(long: DataFrame, keys: list[str], column: str, values: Sequence, value: str) -> DataFrame:
    """Long to wide with the first known value per cell; the value list is given, so no extra job runs."""
    return long.groupBy(*keys).pivot(column, list(values)).agg(F.first(value, ignorenulls=True))


def drop_subtotals(df: DataFrame, name: str, suffix: str | None = None, subtotals: Sequence[str] = SUBTOTAL_NAMES) -> DataFrame:
    """Trim the key and drop subtotal rows, or keep only keys with a suffix."""
    out = df.withColumn(name, F.trim(F.col(name)))
    if suffix is not None:
        return out.where(F.col(name).endswith(suffix))
    return out.where(~F.col(name).isin(*subtotals))


def date_spine(bounds: DataFrame, start: str, end: str, step: str = "1 day", name: str = "day") -> DataFrame:
    """One row per step between two columns of ``bounds``."""
    keep = [c for c in bounds.columns if c not in (start, end)]
    days = F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"interval {step}")))
    return bounds.select(*keep, days.alias(name))


def missing_periods(expected: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Expected periods that are not stored."""
    return expected.join(stored.select(*keys).distinct(), keys, "left_anti")


_BITS = 63  # of a period bitmap's word


def missing_combinations(df: DataFrame, entity: str, period: str) -> DataFrame:
    """(entity, period) pairs that never occur, of all entities and periods that do.

    Periods are numbered; an entity's periods are bits of words, gathered by ``bit_or``. Only entities with too few bits
    are looked at further: their words are held against the words of all periods, and only bits that are missing become
    rows. So complete entities cost one counter and neither side is ever multiplied out. Null entities and periods count
    as none.
    """
    known = df.select(F.col(entity).alias("_e"), F.col(period).alias("_p")).dropna()
    periods = number_rows(known.select("_p").distinct().withColumn("_all", F.lit(0)), ["_all"], "_p", "_n")
    at = F.col("_n") - 1
    periods = materialize(periods.select("_p", F.floor(at / _BITS).cast("int").alias("_w"), (at % _BITS).cast("int").alias("_b")), "periods")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_b"))
    words = periods.groupBy("_w").agg(F.bit_or(bit).alias("_full"))
    total, last = periods.agg(F.count("*")).scalar(), periods.agg(F.max("_w")).scalar()
    own = known.join(periods, "_p").groupBy("_e", "_w").agg(F.bit_or(bit).alias("_own"))
    short = own.groupBy("_e").agg(F.sum(F.bit_count("_own")).alias("_seen")).where(F.col("_seen") < total)
    spine = short.select("_e", F.explode(F.sequence(F.lit(0), last)).alias("_w")).join(own, ["_e", "_w"], "left").join(words, "_w")
    gap = F.col("_full").bitwiseAND(F.bitwise_not(F.coalesce("_own", F.lit(0).cast("bigint"))))
    bits = F.filter(F.sequence(F.lit(0), F.lit(_BITS - 1)), lambda b: F.call_function("getbit", gap, b) == 1)
    return spine.select("_e", "_w", F.explode(bits).alias("_b")).join(periods, ["_w", "_b"]).select(F.col("_e").alias(entity), F.col("_p").alias(period))


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys present in both frames."""
    return a.select(key).intersect(b.select(key))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column as (column_name, nulls) rows."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "nulls")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def imbalance(df: DataFrame, column: str) -> DataFrame:
    """Largest class over smallest class."""
    return value_counts(df, column).agg(
        F.max("n").alias("largest"), F.min("n").alias("smallest"), (F.max("n") / F.min("n")).alias("ratio")
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the maximum belongs to the last bin."""
    ends = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    slot: Column = F.least(F.width_bucket(F.col(column).cast("double"), lo, hi, F.lit(bins)), F.lit(bins))
    return df.where(F.col(column).isNotNull()).groupBy(slot.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


def success_rate(df: DataFrame, group: str, condition: Column) -> DataFrame:
    """Share of rows that meet a condition per group."""
    return df.groupBy(group).agg(
        F.count("*").alias("n"), F.count_if(condition).alias("passed"), F.avg(condition.cast("double")).alias("rate")
    )


def reconcile(detail: DataFrame, published: DataFrame, keys: list[str], parts: list[str], total: str,
              limit: float = 100.0) -> DataFrame:
    """Largest gap between summed parts and a published total, and whether it is acceptable."""
    summed = detail.select(*keys, sum((F.col(p) for p in parts), F.lit(0)).alias("_sum"))
    gap = F.max(F.abs(F.col("_sum") - F.col(total)))
    return summed.join(published.select(*keys, total), keys).agg(
        F.count("*").alias("n_rows"), gap.cast("double").alias("max_gap"), (gap < limit).alias("passed")
    )
