"""Many K-means runs as one iteration.

Restarts, years, numbers of clusters, subsamples and seeds are all runs: a number of clusters, a seed and the rows that
take part (each row carries the list of its runs). Every round is one job: tasks hold their rows against the centres of
the runs that still move and return sums per (run, cluster), which Spark adds up. So the number of jobs is the number of
rounds, whatever the number of runs. Centres travel with the tasks; they are runs x clusters x features numbers, set by
the caller and not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkdesk.operators.quantiles import seeded_order

SAMPLE = 2000  # rows per slice from which starting centres are drawn
ROUNDS = 100
RUNS, SLICE = "_runs", "_slice"


@dataclass(frozen=True)
class Run:
    k: int
    seed: int


@dataclass
class Fit:
    """Centres of a run in a fixed order, rows and squares per cluster, and the sum of squared distances."""

    centres: np.ndarray
    sizes: np.ndarray
    squares: np.ndarray
    cost: float


def started(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ centres: each next one in proportion to its squared distance from those before."""
    rng = np.random.default_rng(seed)
    if not len(points):
        return points
    centres = [points[rng.integers(len(points))]]
    near = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and near.sum() > 0:
        centres.append(points[rng.choice(len(points), p=near / near.sum())])
        near = np.minimum(near, ((points - centres[-1]) ** 2).sum(axis=1))
    return np.array(centres)


def _points(batch: pa.RecordBatch, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows' features, and their runs as (row, run) pairs."""
    x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False).astype(float) for f in features]) if batch.num_rows else np.empty((0, len(features)))
    lists = batch.column(RUNS)
    return x, np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def _round(rows: DataFrame, features: Sequence[str], centres: dict[int, np.ndarray]) -> dict[int, list]:
    """One pass: per run, (cluster, rows, cost, squares, sums) of its clusters."""
    names = [f"s{i}" for i in range(len(features))]
    schema = "run int, cluster int, n long, cost double, sq double, " + ", ".join(f"{c} double" for c in names)

    def sums(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x, row, run = _points(batch, features)
            for r in np.intersect1d(np.unique(run), np.fromiter(centres, int)):
                mine = x[row[run == r]]
                d = _distances(mine, centres[r])
                at = d.argmin(axis=1)
                for c in np.unique(at):
                    here = mine[at == c]
                    part = np.concatenate([[len(here), d[at == c, c].sum(), (here * here).sum()], here.sum(axis=0)])
                    held[r, c] = held.get((r, c), 0) + part
        keys = list(held)
        cols = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([int(held[k][0]) for k in keys], pa.int64())]
        cols += [pa.array([float(held[k][i]) for k in keys], pa.float64()) for i in range(1, 3 + len(features))]
        yield pa.RecordBatch.from_arrays(cols, ["run", "cluster", "n", "cost", "sq", *names])

    parts = rows.select(*features, RUNS).mapInArrow(sums, schema).groupBy("run", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", "cost", "sq", *names)])
    out: dict[int, list] = {}
    for r in sorted(parts.collect()):
        out.setdefault(r["run"], []).append(r)
    return out


def fit_runs(rows: DataFrame, features: Sequence[str], runs: Sequence[Run], key: str) -> list[Fit]:
    """All runs over ``rows``, a stored table with the columns RUNS and SLICE; ``key`` names the rows for the draw of starts."""
    order = Window.partitionBy(SLICE).orderBy(seeded_order(F.col(key), 0), key)
    picked = rows.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= SAMPLE).select(RUNS, *features).toArrow()
    x = np.column_stack([picked[f].to_numpy().astype(float) for f in features]) if len(picked) else np.empty((0, len(features)))
    of = [set(v) for v in picked[RUNS].to_pylist()]
    centres = {i: started(x[[i in s for s in of]], run.k, run.seed) for i, run in enumerate(runs)}
    moving = {i: c for i, c in centres.items() if len(c)}
    fits: dict[int, Fit] = {}
    for _ in range(ROUNDS):
        if not moving:
            break
        for i, found in _round(rows, features, moving).items():
            sizes, squares, new = np.zeros(len(moving[i])), np.zeros(len(moving[i])), moving[i].copy()
            for r in found:
                sizes[r["cluster"]], squares[r["cluster"]] = r["n"], r["sq"]
                new[r["cluster"]] = np.array(r[5:]) / r["n"]
            cost = sum(r["cost"] for r in found)
            still = np.allclose(new, moving[i], rtol=1e-12, atol=1e-12)
            fits[i] = Fit(moving[i], sizes, squares, cost)
            moving[i] = new
            if still:
                del moving[i]
    for f in fits.values():
        by = np.lexsort(f.centres.T[::-1])
        f.centres, f.sizes, f.squares = f.centres[by], f.sizes[by], f.squares[by]
    return [fits.get(i, Fit(np.empty((0, len(features))), np.empty(0), np.empty(0), 0.0)) for i in range(len(runs))]


def best_of(fits: Sequence[Fit], runs: Sequence[int]) -> int:
    """The run of least cost; the first of equal ones."""
    return min(runs, key=lambda i: (fits[i].cost, i))


def labelled(rows: DataFrame, features: Sequence[str], fits: Sequence[Fit], chosen: Sequence[int]) -> DataFrame:
    """The rows' own columns with (run, cluster): one row per row and chosen run that it takes part in."""
    keep = [c for c in rows.columns if c not in (RUNS, SLICE)]
    fields = [*rows.select(*keep).schema.fields, T.StructField("run", T.IntegerType()), T.StructField("cluster", T.IntegerType())]

    def assign(batches):
        for batch in batches:
            x, row, run = _points(batch, features)
            for r in chosen:
                mine = row[run == r]
                if len(mine):
                    at = _distances(x[mine], fits[r].centres).argmin(axis=1)
                    cols = [batch.column(c).take(pa.array(mine)) for c in keep]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(mine), r), pa.int32()), pa.array(at, pa.int32())], [*keep, "run", "cluster"])

    return rows.mapInArrow(assign, T.StructType(fields))


def squared_silhouettes(rows: DataFrame, features: Sequence[str], fits: Sequence[Fit], chosen: Sequence[int]) -> DataFrame:
    """(run, silhouette): the mean squared-distance silhouette of chosen runs, linear in the rows, in one pass."""

    def sums(batches):
        total = {r: [0, 0.0] for r in chosen}
        for batch in batches:
            x, row, run = _points(batch, features)
            for r in chosen:
                mine, fit = x[row[run == r]], fits[r]
                if not len(mine):
                    continue
                at = _distances(mine, fit.centres).argmin(axis=1)
                n = np.maximum(fit.sizes, 1)
                mean = (mine * mine).sum(axis=1)[:, None] - 2 * mine @ fit.centres.T + fit.squares / n
                mean[:, fit.sizes == 0] = np.inf
                own, size = mean[np.arange(len(mine)), at], fit.sizes[at]
                mean[np.arange(len(mine)), at] = np.inf
                a, b = own * size / np.maximum(size - 1, 1), mean.min(axis=1)
                top = np.maximum(a, b)
                s = np.where((size > 1) & (top > 0) & np.isfinite(b), (b - a) / np.where(top > 0, top, 1), 0.0)
                total[r][0] += len(mine)
                total[r][1] += float(s.sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.float64())], ["run", "n", "s"])

    parts = rows.select(*features, RUNS).mapInArrow(sums, "run int, n long, s double")
    return parts.groupBy("run").agg((F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("silhouette"))


def with_runs(df: DataFrame, runs: Column, slice_: Column | None = None) -> DataFrame:
    return df.withColumns({RUNS: runs.cast("array<int>"), SLICE: F.lit(0) if slice_ is None else slice_})
