"""Exact order statistics without gathering a group in one task.

Equal values are counted before the shuffle; the counts are then added up along sorted ranges, whose bounds Spark takes
from a sample, so ranges are even however the values are distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.operators.ordered import SUM, running
from sparkdesk.session import materialize

Rank = Callable[[Column], Column]


def values_at_ranks(df: DataFrame, groups: list[str], value: str, ranks: Sequence[Rank]) -> DataFrame:
    """Values at 0-based ranks of each group: columns ``v0``, ``v1``, ... and the group size ``n``.

    Each rank is a function of the group size. A rank outside 0..n-1 gives null.
    """
    src = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    counts = src.groupBy(*groups, "_v").agg(F.count("*").alias("_n"))
    placed = running(counts, groups, ["_v"], {"_before": (SUM, F.col("_n"))}, before=True)
    wanted = F.array(*[fn(F.col("n")).cast("bigint") for fn in ranks])
    sizes = src.groupBy(*groups).agg(F.count("*").alias("n")).withColumn("_want", wanted)
    here = lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_n"))
    found = placed.join(sizes, groups).where(F.exists("_want", here)).groupBy(*groups).agg(
        *[F.max(F.when(here(F.col("_want")[i]), F.col("_v"))).alias(f"v{i}") for i in range(len(ranks))])
    return sizes.drop("_want").join(found, groups, "left")


def whole_table(column: str) -> Column:
    """The same key for every row; computed, so that joins on it stay joins on a key."""
    return F.pmod(F.xxhash64(column), F.lit(1))


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per probability, plus the count ``n``.

    With no groups the result has a single row.
    """
    keys = groups or ["_all"]
    src = df if groups else df.withColumn("_all", whole_table(value))
    place = lambda p: (lambda n: F.lit(p) * (n - 1))
    ranks: list[Rank] = []
    for p in probs:
        ranks += [lambda n, f=place(p): F.floor(f(n)), lambda n, f=place(p): F.ceil(f(n))]
    vals = values_at_ranks(src, keys, value, ranks)
    cols = []
    for i, (p, name) in enumerate(zip(probs, names)):
        at = place(p)(F.col("n"))
        lo, hi = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        cols.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return vals.select(*groups, "n", *cols)


def exact_median(df: DataFrame, groups: list[str], value: str, name: str = "median") -> DataFrame:
    return exact_quantiles(df, groups, value, [0.5], [name])


def describe(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles per group."""
    basics = df.groupBy(*groups).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"),
    )
    quart = exact_quantiles(df, groups, value, [0.25, 0.5, 0.75], ["q25", "q50", "q75"]).drop("n")
    return basics.join(quart, groups)


def seeded_order(key: Column, seed: int) -> Column:
    """A reproducible pseudo-random number in 0..2^52 per key, the same in every run and engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def first_in_seeded_order(df: DataFrame, groups: list[str], key: str, size: Rank, seed: int, flag: str = "chosen") -> DataFrame:
    """Flag the ``size(n)`` rows of each group that come first in seeded order.

    The cut-off value is found as an order statistic, so no group is sorted as a whole.
    """
    ranked = df.withColumn("_h", seeded_order(F.col(key), seed))
    cut = values_at_ranks(ranked, groups, "_h", [lambda n: F.least(size(n), n) - 1])
    # one row per group, stored: its true size decides whether the join broadcasts it
    cut = materialize(cut.select(*groups, F.col("v0").cast("bigint").alias("_cut")), "cut")
    joined = ranked.join(cut, groups)
    return joined.withColumn(flag, F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))).drop("_h", "_cut")
