"""One mergeable state behind many tables: grouping sets over sums, counts and largest values.

A cube reads its rows once. Every row is counted at each level (a set of key columns), reduced on the map side, and every
statistic kept is additive or a maximum, so two states merge by one more aggregation, in any order and over any split of
the rows. The tables people read are views: one level of the state, with means worked out there.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEVEL, ROWS = "level", "n_rows"
_KINDS = {"sum": F.sum, "n": F.count, "top": F.max}


@dataclass(frozen=True)
class Cube:
    """Levels (name to key columns) and the measures that are summed, counted and maximised at each."""

    levels: dict[str, tuple[str, ...]]
    measures: tuple[str, ...]

    @property
    def keys(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(k for level in self.levels.values() for k in level))

    @property
    def stats(self) -> tuple[str, ...]:
        return (ROWS, *(f"{m}_{kind}" for m in self.measures for kind in _KINDS))

    def build(self, rows: DataFrame, *levels: str) -> DataFrame:
        """(level, keys, statistics) at the named levels (all by default), in one pass; keys outside a level are null."""
        chosen = {name: self.levels[name] for name in levels or self.levels}
        keys = [k for k in self.keys if any(k in level for level in chosen.values())]
        folds = [F.count("*").alias(ROWS), *(fold(m).alias(f"{m}_{kind}") for m in self.measures for kind, fold in _KINDS.items())]
        if len(chosen) == 1:
            (name, own), = chosen.items()
            state = rows.groupBy(*own).agg(*folds).withColumn(LEVEL, F.lit(name))
        else:
            sets = rows.groupingSets([[F.col(k) for k in level] for level in chosen.values()], *[F.col(k) for k in keys])
            state = sets.agg(F.grouping_id().alias("_set"), *folds)
            absent = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in level) for name, level in chosen.items()}
            named: Column = F.lit(None).cast("string")
            for name, bits in absent.items():
                named = F.when(F.col("_set") == bits, name).otherwise(named)
            state = state.withColumn(LEVEL, named)
        every = [F.col(k) if k in keys else F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in self.keys]
        return state.select(LEVEL, *every, *self.stats)

    def merge(self, *states: DataFrame) -> DataFrame:
        """The state of all rows behind ``states`` together."""
        whole = states[0]
        for state in states[1:]:
            whole = whole.unionByName(state)
        return whole.groupBy(LEVEL, *self.keys).agg(*[(F.max if s.endswith("_top") else F.sum)(s).alias(s) for s in self.stats])

    def view(self, state: DataFrame, level: str, **columns: str) -> DataFrame:
        """A table of one level: its keys and the asked statistics, each as ``"measure kind"`` (mean, sum, n, top) or ``"rows"``."""
        return state.where(F.col(LEVEL) == level).select(*self.levels[level], *[self._said(what).alias(name) for name, what in columns.items()])

    def _said(self, what: str) -> Column:
        if what == "rows":
            return F.col(ROWS)
        measure, kind = what.split()
        if kind == "mean":
            return F.col(f"{measure}_sum") / F.nullif(f"{measure}_n", F.lit(0))
        return F.col(f"{measure}_{kind}")

    def without(self, state: DataFrame, touched: dict[str, DataFrame]) -> DataFrame:
        """The state less the cells of the named levels whose keys are among ``touched`` (level to a table of some of its keys)."""
        for level, cells in touched.items():
            of = [k for k in self.levels[level] if k in cells.columns]
            marked = cells.select(*of).distinct().withColumn(LEVEL, F.lit(level))
            state = state.join(marked, [LEVEL, *of], "left_anti")
        return state.select(LEVEL, *self.keys, *self.stats)


def save(state: DataFrame, path: str) -> None:
    """All tables in one job: a folder per level, so that a view reads its own level only."""
    state.write.mode("overwrite").partitionBy(LEVEL).parquet(path)


def load(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(like.columns)


def smallest_row(df: DataFrame, keys: Iterable[str], order: Iterable[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the other columns, so that repeats in any arrival order give the same row."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = F.min(F.struct(*order, *[c for c in rest if c not in order]))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(df.columns)
