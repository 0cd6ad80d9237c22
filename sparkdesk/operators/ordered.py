"""Order-dependent jobs over keys of any size: running totals as a segmented scan over sorted ranges.

Rows are sorted into ranges whose bounds Spark samples, so a key of any size, with positions however far apart, stretches
over as many tasks as it needs. Inside a range the total runs along the rows; what reaches over its edge is one carry per
range. The sorted rows are written once, so that their places hold however often a lost task runs again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.session import materialize

_RANGE_BITS = 33  # a generated row id holds the number of its partition above so many bits


@dataclass(frozen=True)
class Running:
    """A total that can run along rows: over a window, over unordered rows with their places, and of two stretches."""

    along: Callable[[Column], Column]
    whole: Callable[[Column, Column], Column]
    joined: Callable[[Column, Column], Column]


SUM = Running(F.sum, lambda v, at: F.sum(v), lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
XOR = Running(F.bit_xor, lambda v, at: F.bit_xor(v), lambda a, b: F.coalesce(a, F.lit(0)).bitwiseXOR(F.coalesce(b, F.lit(0))))
LAST = Running(lambda v: F.last(v, ignorenulls=True), lambda v, at: F.max_by(v, F.when(v.isNotNull(), at)), lambda a, b: F.coalesce(b, a))


def sorted_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str | Column] | None = None) -> DataFrame:
    """``keep`` of the rows in the order of keys and ``order`` (nulls first), with their place ``_at`` and range ``_range``; stored."""
    by = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    rows = rows.select(*(keep if keep is not None else df.columns), "_at")
    return materialize(rows.withColumn("_range", F.shiftright("_at", _RANGE_BITS)), "ranges")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, tuple[Running, Column]],
            keep: Sequence[str | Column] | None = None, before: bool = False) -> DataFrame:
    """Running totals of each key in an order of any type, up to each row or (``before``) up to the one ahead of it.

    Rows of equal order stand in any order among themselves. ``keep`` names the columns that stay, keys included; wide
    columns that only decide the order are left behind after the sort. A null key is a key like any other.
    """
    rows = sorted_ranges(df, keys, order, keep)
    key = F.struct(*keys)
    edges = rows.groupBy("_range").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    ends = rows.join(F.broadcast(edges.select("_range", "_last")), "_range").where(key.eqNullSafe(F.col("_last")))
    ends = ends.groupBy("_range").agg(*[t.whole(v, F.col("_at")).alias(f"_c_{n}") for n, (t, v) in totals.items()])
    edges = materialize(edges.join(ends, "_range"), "range-edges")  # one row per range

    of = [f"_c_{n}" for n in totals]
    told = edges.select(F.col("_last").alias("_key"), "_range", *of)
    asked = edges.select(F.col("_first").alias("_key"), "_range", *[F.lit(None).cast(edges.schema[c].dataType).alias(c) for c in of])
    both = told.union(asked).groupBy("_key", "_range").agg(*[F.max(c).alias(c) for c in of])
    earlier = W.partitionBy("_key").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = both.select("_key", "_range", *[t.along(F.col(f"_c_{n}")).over(earlier).alias(f"_c_{n}") for n, (t, _) in totals.items()])
    carried = carried.join(edges.select("_range", F.col("_first").alias("_key")), ["_range", "_key"]).withColumnRenamed("_key", "_first")

    inside = W.partitionBy("_range", *keys).orderBy("_at").rowsBetween(W.unboundedPreceding, -1 if before else 0)
    out = rows.withColumns({f"_r_{n}": t.along(v).over(inside) for n, (t, v) in totals.items()}).join(F.broadcast(carried), "_range", "left")
    mine = key.eqNullSafe(F.col("_first"))
    out = out.withColumns({n: t.joined(F.when(mine, F.col(f"_c_{n}")), F.col(f"_r_{n}")) for n, (t, _) in totals.items()})
    return out.drop("_at", "_range", "_first", *of, *[f"_r_{n}" for n in totals])


def carry_forward(df: DataFrame, keys: list[str], order: str, value: Column, default, name: str) -> DataFrame:
    """Last known value at or before each row."""
    rows = running(df.withColumn("_val", value), keys, [order], {name: (LAST, F.col("_val"))})
    return rows.withColumn(name, F.coalesce(name, F.lit(default))).drop("_val")


def number_rows(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """1-based position of each row within its key, by a column of any sortable type."""
    return running(df, keys, [order], {name: (SUM, F.lit(1))})
