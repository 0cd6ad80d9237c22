"""Date and period expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def weekday(col: Column | str) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(col))


def is_weekend(col: Column | str) -> Column:
    return F.dayofweek(_c(col)).isin(1, 7)


def year_month(col: Column | str) -> Column:
    """``yyyy-MM`` key."""
    return F.date_format(_c(col), "yyyy-MM")


def days_in_month(yyyymm: Column | str) -> Column:
    """Number of days of a ``yyyyMM`` month."""
    return F.dayofmonth(F.last_day(F.try_to_date(F.concat(_c(yyyymm), F.lit("01")), "yyyyMMdd")))


def season(month: Column | str) -> Column:
    """Season of a month number."""
    m = _c(month)
    return (
        F.when(m.between(3, 5), "spring").when(m.between(6, 8), "summer").when(m.between(9, 11), "autumn")
        .otherwise("winter")
    )


def quarter_code(col: Column | str) -> tuple[Column, Column]:
    """Split a ``yyyyq`` code into year and quarter."""
    code = F.expr(f"try_cast({col} as bigint)") if isinstance(col, str) else col.try_cast("bigint")
    return F.floor(code / 10), code % 10


def period_from_text(col: Column | str) -> tuple[Column, Column]:
    """Year and month out of text such as ``2021. 04월``."""
    c = _c(col)
    return (
        F.regexp_extract(c, r"(\d{4})", 1).try_cast("bigint"),
        F.regexp_extract(c, r"\d{4}\. (\d{2})", 1).try_cast("bigint"),
    )


def is_session_open(ts_utc: Column | str, zone: str = "+09:00", start: str = "09:00", end: str = "15:30") -> Column:
    """Weekday inside trading hours, outside 1 May and 31 December; holidays are joined away."""
    local = F.from_utc_timestamp(_c(ts_utc), zone)
    day = F.date_format(local, "MM-dd")
    clock = F.date_format(local, "HH:mm:ss.SSSSSS")
    return (
        ~F.dayofweek(local).isin(1, 7)
        & ~day.isin("05-01", "12-31")
        & (clock >= F.lit(f"{start}:00.000000"))
        & (clock <= F.lit(f"{end}:00.000000"))
    )
