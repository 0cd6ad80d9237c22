"""Embedding whitening on leading components found by spectrum slicing.

1. Vectors become whole numbers x = floor(256 c). The fit list is each distinct x once (equal vectors meet map-side first).
2. Sums are exact; the covariance is centred before multiplying. Both are added up per task and then over tasks by Spark;
   only figures of the vector length (d sums, d x d products) reach the driver.
3. The signs of the pivots of LDLᵀ of the covariance less a shift say how many eigenvalues lie below the shift. Bisection
   on that count isolates each leading eigenvalue; Rayleigh quotient iteration, which converges cubically, finds it and
   its vector; counts beside it certify its number, or bisection goes on. Repeated eigenvalues share an interval that no
   count can split: their vectors are found one after another, each free of the ones before.

Rows: null vectors and those with null or non-finite entries are dropped. Of different lengths the commonest (the
shortest of equally common) is whitened and the others are dropped. Repeated rows and null ids come back as often as
they came. Components whose eigenvalue is nothing but rounding have no whitened value and are left out, so a table of one
distinct vector, or an empty one, gives no row. A deviation beyond the range of a long is null. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.session import materialize

SCALE = 256
COMPONENTS = 4
_MOST = (1 << 63) - 1
_PIVOT = (1 + 17**0.5) / 8  # of Bunch and Parlett: bounds the growth of both kinds of pivot
_STEPS = 200


# --- eigenvalues by counting ---------------------------------------------------------------------------
def below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie below ``shift``: the negative pivots of LDLᵀ, with pivots of one or two rows."""
    a = matrix - shift * np.eye(len(matrix))
    negative = 0
    while len(a):
        n = len(a)
        diagonal = np.abs(np.diagonal(a))
        p = int(diagonal.argmax())
        off = np.abs(np.tril(a, -1))
        r, c = divmod(int(off.argmax()), n)
        if max(diagonal[p], off[r, c]) == 0:
            break
        if diagonal[p] >= _PIVOT * off[r, c]:
            rest = np.delete(np.arange(n), p)
            pivot, column = a[p, p], a[rest, p]
            negative += pivot < 0
            a = a[np.ix_(rest, rest)] - np.outer(column, column / pivot)
        else:  # a pivot of two rows has one negative eigenvalue: its off-diagonal outweighs both others
            rest = np.delete(np.arange(n), [r, c])
            block, columns = a[np.ix_([r, c], [r, c])], a[np.ix_(rest, [r, c])]
            negative += 1
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
        a = (a + a.T) / 2
    return int(negative)


def rayleigh(matrix: np.ndarray, shift: float, found: list[np.ndarray], rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """An eigenvalue and its vector near ``shift``, free of the vectors ``found``."""
    scale, n = np.abs(matrix).sum(axis=1).max(), len(matrix)

    def free(x):
        for v in (*found, *found):
            x = x - (v @ x) * v
        return x / np.linalg.norm(x)

    def solved(value, x):
        for nudge in (0.0, 1e-15, 1e-13):
            try:
                y = np.linalg.solve(matrix - (value + nudge * scale) * np.eye(n), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all() and y.any():
                return free(y / np.abs(y).max())
        return x

    x = free(rng.standard_normal(n))
    for _ in range(3):  # inverse iteration first, so that the quotient starts within reach
        x = solved(shift, x)
    value, left = float(x @ matrix @ x), np.inf
    for _ in range(_STEPS):
        y = solved(value, x)
        new = float(y @ matrix @ y)
        here = np.linalg.norm(matrix @ y - new * y)
        if here >= left and left < 1e-10 * scale:
            break
        x, value, left = y, new, here
    return value, x


def leading(matrix: np.ndarray, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``count`` eigenvalues (falling) and unit vectors (columns) of a symmetric matrix; ones that are rounding only are left out."""
    n, rng = len(matrix), np.random.default_rng(seed)
    radius = np.abs(matrix).sum(axis=1).max() if n else 0.0
    grain = max(n, 1) * np.finfo(float).eps * radius
    values, vectors = [], []
    while radius > 0 and len(values) < min(count, n):
        k = len(values) + 1
        low, high = -radius - 2 * grain, radius + 2 * grain
        while True:  # low < the k-th largest <= high, and only as many others as are equal within rounding
            above_low, above_high = n - below(matrix, low), n - below(matrix, high)
            wide = high - low > 4 * grain
            if high <= 8 * grain:
                return _columns(values, vectors, n)
            if above_low - above_high == 1 or not wide:
                value, vector = rayleigh(matrix, (low + high) / 2, vectors, rng)
                beside = max(4 * grain, 1e-12 * abs(value))
                if low - beside <= value <= high + beside and n - below(matrix, value + beside) < k <= n - below(matrix, value - beside):
                    break
                if not wide:
                    raise ArithmeticError(f"eigenvalue {k} wasn't found between {low} and {high}")
            middle = (low + high) / 2
            if n - below(matrix, middle) >= k:
                low = middle
            else:
                high = middle
        if value <= 4 * grain:
            break
        values.append(value)
        vectors.append(vector if vector[np.abs(vector).argmax()] > 0 else -vector)
    return _columns(values, vectors, n)


def _columns(values: list[float], vectors: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.array(values), np.array(vectors).reshape(len(vectors), n).T


# --- statistics of the table ----------------------------------------------------------------------------
def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the finite vectors of the commonest length as whole numbers; stored."""
    v = F.col(vector)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.select(F.col(key).alias("vec_id"), v.alias("v")).where(fine & (F.size("v") > 0))
    lengths = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    rows = rows.where(F.size("v") == (lengths[0]["dim"] if lengths else 0))
    return materialize(rows.select("vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * scale)).alias("x")), "whitening-rows")


def _table(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _total(x: np.ndarray) -> list[int]:
    if not len(x):
        return []
    safe = max(int(x.max()), -int(x.min())) * len(x) < 1 << 62
    return [int(s) for s in (x.sum(axis=0) if safe else x.astype(object).sum(axis=0))]


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the exact sum per dimension."""

    def part(batches):
        rows, total = 0, []
        for batch in batches:
            here = _total(_table(batch)) if batch.num_rows else []
            total = [a + b for a, b in zip(total, here, strict=True)] if total and here else total or here
            rows += batch.num_rows
        held = [rows, *total]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(held)), pa.int32()), pa.array([Decimal(v) for v in held], pa.decimal128(38, 0))], ["i", "s"])

    found = {r["i"]: int(r["s"]) for r in fit.mapInArrow(part, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return found.get(0, 0), [found[i] for i in range(1, len(found))]


def covariance(fit: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """The covariance (divisor n) of the rows, centred before multiplying."""
    mean = np.array([s / n for s in total])

    def part(batches):
        held = np.zeros((len(mean), len(mean)))
        for batch in batches:
            if batch.num_rows:
                away = _table(batch) - mean
                held += away.T @ away
        yield pa.RecordBatch.from_arrays([pa.array(range(len(mean)), pa.int32()), pa.array(list(held), pa.list_(pa.float64()))], ["i", "products"])

    cells = fit.mapInArrow(part, "i int, products array<double>").select("i", F.posexplode("products").alias("j", "p"))
    rows = cells.groupBy("i", "j").agg(F.sum("p").alias("p")).toArrow()
    out = np.zeros((len(mean), len(mean)))
    out[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["p"].to_numpy()
    return (out + out.T) / (2 * n)


@dataclass(frozen=True)
class Whitening:
    """Components of the fit list: (x - sums / n) on ``vectors``, each over the root of its eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float]

    def apply(self, rows: DataFrame) -> DataFrame:
        """(vec_id, deviation, whitened) of rows (vec_id, x)."""
        n, total, mean = self.n, self.sums, np.array([s / max(self.n, 1) for s in self.sums])
        weights = self.vectors / np.sqrt(self.values)

        def part(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _table(batch)
                most = n * max(int(x.max()), -int(x.min())) + max(map(abs, total))
                if most * most * len(total) < 1 << 62:
                    dev = ((n * x - np.array(total)) ** 2).sum(axis=1).tolist()
                else:
                    dev = [d if d <= _MOST else None for d in ((n * x.astype(object) - np.array(total, dtype=object)) ** 2).sum(axis=1)]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(dev, pa.int64()), pa.array(list((x - mean) @ weights), pa.list_(pa.float64()))], ["vec_id", "deviation", "whitened"])

        return rows.mapInArrow(part, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation long, whitened array<double>")

    def identity_error(self, fit: DataFrame) -> float:
        """Largest absolute entry of the whitened fit list's covariance less the identity."""
        white = self.apply(fit.select(F.lit(0).alias("vec_id"), "x")).select(*[F.col("whitened")[i].alias(f"w{i}") for i in range(len(self.values))])
        pairs = [(i, j) for i in range(len(self.values)) for j in range(i + 1)]
        row = white.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
        return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fitted on every row of ``fit`` (x), which holds each distinct vector once."""
    n, total = sums(fit)
    if not n:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)), [])
    spread = covariance(fit, n, total)
    values, vectors = leading(spread, components)
    return Whitening(n, total, values, vectors, [float(v / np.trace(spread)) for v in values])


def whitened(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per row and component."""
    rows = whole_numbers(vectors, key, vector)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, components)
    if not len(model.values):
        rows, error = rows.limit(0), 0.0
    else:
        error = model.identity_error(fit)
    out = model.apply(rows).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(e) for e in model.explained] or [F.lit(0.0)])
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
