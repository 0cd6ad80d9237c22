"""Merges as DataFrame rewrites.

Gold state is a cube (sums, counts, largest values) and means are derived on read, so merging a batch is a union and one
aggregation: the order of batches does not matter, nulls do not stick, and a hot key is reduced before the shuffle.
What has been merged is known by silver itself: only rows whose key is not stored yet are new, so a day may be delivered
twice or in halves. Corrections rebuild the cells they touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.operators import demand as D
from sparkdesk.operators.cube import smallest_row


def fresh_rows(stored: DataFrame, arriving: DataFrame, keys: list[str]) -> DataFrame:
    """Arriving rows whose key is not stored yet, one per key (the smallest of repeats)."""
    return smallest_row(arriving, keys).join(stored.select(*keys), keys, "left_anti").select(arriving.columns)


def insert_only(stored: DataFrame, arriving: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows plus arriving rows whose key is not stored yet (M1, M2)."""
    return stored.unionByName(fresh_rows(stored, arriving, keys))


def upsert(stored: DataFrame, arriving: DataFrame, keys: list[str], latest: str) -> DataFrame:
    """Arriving rows replace stored rows of the same key (S12); of several arriving rows of a key the one largest in ``latest`` counts."""
    rest = [c for c in arriving.columns if c not in keys and c != latest]
    best = arriving.groupBy(*keys).agg(F.max(F.struct(latest, *rest)).alias("_row"))
    fresh = best.select(*keys, "_row.*").select(arriving.columns)
    return stored.join(fresh.select(*keys), keys, "left_anti").select(stored.columns).unionByName(fresh)


def replace_groups(stored: DataFrame, arriving: DataFrame, group: str) -> DataFrame:
    """Every stored row of a group that arrives again is dropped first."""
    return stored.join(arriving.select(group).distinct(), group, "left_anti").unionByName(arriving)


def append_missing(stored: DataFrame, arriving: DataFrame, keys: list[str]) -> DataFrame:
    """Only the arriving rows that still have to be appended."""
    return arriving.join(stored.select(*keys).distinct(), keys, "left_anti")


# --- gold state -----------------------------------------------------------------------------------
def merged_daily(cube: DataFrame, silver: DataFrame, arriving: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State and silver after a batch of silver rows (M3-M6): (cube, fresh rows to append to silver)."""
    fresh = fresh_rows(silver, arriving, D.DAILY_KEY)
    return D.DAILY.merge(cube, D.daily_cube(fresh)), fresh


def corrected_daily(cube: DataFrame, silver: DataFrame, changed: DataFrame) -> DataFrame:
    """State after rows of silver were corrected; ``silver`` holds the corrections, ``changed`` the keys they have.

    A largest value can't be taken back, so the cells of the touched stations and days are worked out again, all others stay.
    """
    stations, days = changed.select("line", "station").distinct(), changed.select("use_ymd").distinct()
    rest = D.DAILY.without(cube, {"station": stations, "weekday": stations, "month": stations, "day": days})
    again = D.daily_cube(silver.join(stations, ["line", "station"], "left_semi"), "station", "weekday", "month")
    return rest.unionByName(again).unionByName(D.daily_cube(silver.join(days, "use_ymd", "left_semi"), "day"))


def rebuild_weekly(daily: DataFrame) -> DataFrame:
    """Weekday table rebuilt from all of silver instead of merged (M7)."""
    return D.weekday_load(D.daily_cube(daily, "weekday"))


def migrate_columns(stored: DataFrame | None, silver: DataFrame, kind: str, min_lines: int = 2) -> DataFrame:
    """Stored transfer table if it has the current columns, otherwise a rebuild from silver (M8)."""
    need, build = {"pattern": ("tp_cnt", D.transfer_pattern), "monthly": ("total_alight", D.transfer_monthly)}[kind]
    if stored is not None and need in stored.columns:
        return stored
    return build(D.daily_cube(silver, "station", "month"), min_lines)
