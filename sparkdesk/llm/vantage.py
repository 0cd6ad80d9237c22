"""Nearest neighbours by inner product: vantage-point trees per shard, pruned by the triangle inequality.

An inner product becomes a distance by one more coordinate. Vectors are taken in shells of like length (a factor of
1.26); with M the largest length of a shell, a vector x stands at (x, sqrt(M² - |x|²)) and a query, stretched to length M,
at (q, 0). All points then have length M, the largest product is the smallest distance, and distances obey the triangle
inequality.

1. A small tree per shell over a bounded sample (``SAMPLE_ROWS``) deals all rows into shards; a shard above ``SHARD_ROWS``
   (copies of one vector, say) is dealt on by id. Every row is indexed: each part is one tree, one row of the index table.
2. A query first asks a part of the fullest shell, which gives a product to beat. It then asks the parts whose bound,
   times ``factor``, stays within the distance that stands for it; inside a tree, branches are held to the same test.
   Factor one restores exact search; a larger one leaves out branches that are unlikely to help. Without a given factor
   the index takes the largest of ``FACTORS`` that keeps ``RECALL`` of the neighbours within the sample.
3. A part and up to ``QUERY_BLOCK`` of its queries are one group of bounded size. The best of all parts are ranked.

Rows: vectors that are null, empty or zero, or hold null or non-finite components, and rows without an id take no part,
nor as queries. Of rows with one id the smallest vector counts. Vectors of different length never meet. Equal products
are ranked by id; fewer candidates than asked give fewer rows; an empty table gives none. Squares of components must stay
in the range of doubles. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkdesk.session import materialize

SAMPLE_ROWS = 65_536
PER_SHARD = 256  # sampled rows per shard, within SAMPLE_ROWS
SHARD_ROWS = 8192
QUERY_BLOCK = 2048
LEAF_ROWS = 128
FACTORS = (6.0, 5.0, 4.0, 3.0, 2.5, 2.0, 1.75, 1.5, 1.25, 1.1)
RECALL = 0.99
TRIAL_ROWS, TRIAL_QUERIES = 8192, 256  # of the sample, to choose a factor
_NO_ID = np.iinfo(np.int64).max
_SHELL = ["dim", "shell"]
_PART = [*_SHELL, "leaf", "part"]
_ASKED = "id long, v array<double>, dim int, shell int, leaf int, part int, floor double"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, dim, shell, norm): one finite vector that isn't zero per id."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & fine)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = rows.groupBy("id").agg(F.min("v").alias("v")).withColumns({"dim": F.size("v"), "norm": norm})
    return rows.withColumn("shell", F.floor(F.log2("norm") * 3 + 0.5).cast("int"))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


class Tree:
    """A vantage-point tree over points of one part; rows are stored in the order of the leaves.

    ``nodes`` holds (start, end, inside, outside, vantage row), ``bounds`` the smallest and largest distance from the
    vantage point to the rows inside and outside.
    """

    def __init__(self, ids, points, lift, nodes, bounds, most):
        self.ids, self.points, self.lift, self.nodes, self.bounds, self.most = ids, points, lift, nodes, bounds, most

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray, most: float, leaf_rows: int, seed: int = 0) -> Tree:
        order, rng = np.argsort(ids, kind="stable"), np.random.default_rng(seed)
        lift = lifted(points, most)
        nodes, bounds, todo = [], [], [(0, len(ids), -1, 0)]
        while todo:
            start, end, above, side = todo.pop()
            here, me = order[start:end], len(nodes)
            if above >= 0:
                nodes[above][2 + side] = me
            nodes.append([start, end, -1, -1, -1])
            bounds.append((0.0, 0.0, 0.0, 0.0))
            if end - start <= leaf_rows:
                continue
            eye = int(here[rng.integers(len(here))])
            d = between(points[here] @ points[eye] + lift[here] * lift[eye], most)
            half = len(here) // 2
            cut = np.argpartition(d, half)
            order[start:end], d = here[cut], d[cut]
            nodes[me][4] = eye
            bounds[me] = (d[:half].min(), d[:half].max(), d[half:].min(), d[half:].max())
            todo += [(start, start + half, me, 0), (start + half, end, me, 1)]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        table = np.array(nodes, dtype=np.int64)
        table[:, 4] = np.where(table[:, 4] >= 0, place[table[:, 4]], -1)
        return cls(ids[order], points[order], lift[order], table, np.array(bounds), most)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best (products, ids) of each query that reach its floor; the query's own id is left out."""
        best, who = np.full((len(queries), k), -np.inf), np.full((len(queries), k), _NO_ID)
        length, full = np.linalg.norm(queries, axis=1), 2 * self.most**2
        stretched = queries * (self.most / length)[:, None]
        todo = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
        while todo:
            node, rows, bound = todo.pop()
            to_beat = np.maximum(best[rows, -1], floor[rows])
            fine = near(bound, to_beat, length[rows], self.most, factor)
            rows = rows[fine]
            if not len(rows):
                continue
            start, end, inside, outside, eye = self.nodes[node]
            if eye < 0:
                self._leaf(slice(start, end), rows, query_ids, queries, floor, 1e-12 * length * self.most, best, who)
                continue
            d = np.sqrt(np.maximum(full - 2 * (stretched[rows] @ self.points[eye]), 0))
            low_in, high_in, low_out, high_out = self.bounds[node]
            to_in = np.maximum(np.maximum(low_in - d, d - high_in), 0)
            to_out = np.maximum(np.maximum(low_out - d, d - high_out), 0)
            first_in = to_in <= to_out
            for pick, later, sooner in ((first_in, (outside, to_out), (inside, to_in)), (~first_in, (inside, to_in), (outside, to_out))):
                if pick.any():
                    todo += [(child, rows[pick], lower[pick]) for child, lower in (later, sooner)]
        return best, who

    def _leaf(self, span, rows, query_ids, queries, floor, slack, best, who):
        points, ids = self.points[span], self.ids[span]
        least = np.maximum(best[rows, -1], floor[rows]) - slack[rows]
        hit_q, hit_p = np.nonzero((queries[rows] @ points.T >= least[:, None]) & (ids != query_ids[rows][:, None]))
        if not len(hit_q):
            return
        found = np.full((len(rows), len(ids)), -np.inf)
        found[hit_q, hit_p] = (queries[rows[hit_q]] * points[hit_p]).sum(axis=1)  # row by row: equal vectors get equal products
        touched = np.unique(hit_q)
        at, k = rows[touched], best.shape[1]
        score = np.hstack([best[at], found[touched]])
        name = np.hstack([who[at], np.where(np.isneginf(found[touched]), _NO_ID, ids)])
        order = np.lexsort((name, -score), axis=-1)[:, :k]
        best[at], who[at] = np.take_along_axis(score, order, 1), np.take_along_axis(name, order, 1)


def lifted(points: np.ndarray, most: float) -> np.ndarray:
    """The coordinate that brings each point to length ``most``."""
    return np.sqrt(np.maximum(most * most - (points * points).sum(axis=1), 0))


def between(product: np.ndarray, most: float) -> np.ndarray:
    """Distances of points of length ``most`` from their products."""
    return np.sqrt(np.maximum(2 * most * most - 2 * product, 0))


def near(bound: np.ndarray, to_beat: np.ndarray, length: np.ndarray, most: float, factor: float) -> np.ndarray:
    """Whether a point no nearer than ``bound`` may still reach the product ``to_beat``; roundings never prune."""
    reach = 2 * most * most - 2 * to_beat * (most / length) + 1e-9 * most * most
    return (reach >= 0) & (factor * bound <= np.sqrt(np.maximum(reach, 0)))


class Router:
    """A small tree per shell over its sample: which shard a row lies in, and how near a query may come to each."""

    def __init__(self, samples: dict[tuple[int, int], np.ndarray], shards: dict[tuple[int, int], int], most: dict[tuple[int, int], float]):
        self.most, self.cuts = most, {}
        for shell, points in samples.items():
            tree = Tree.build(np.arange(len(points)), points, most[shell], max(1, -(-len(points) // shards[shell])))
            at = {n: i for i, n in enumerate(np.flatnonzero(tree.nodes[:, 4] >= 0))}
            leaves = {n: -1 - i for i, n in enumerate(np.flatnonzero(tree.nodes[:, 4] < 0))}
            child = at | leaves  # a negative child -1-s is shard s
            cuts = [(tree.points[eye].copy(), tree.lift[eye], tree.bounds[n][1], child[inside], child[outside])
                    for n in at for _, _, inside, outside, eye in [tree.nodes[n]]]
            self.cuts[shell] = (cuts, len(leaves))

    def shard(self, shell: tuple[int, int], points: np.ndarray, lift: np.ndarray) -> np.ndarray:
        cuts, _ = self.cuts.get(shell, ((), 1))
        at = np.full(len(points), 0 if cuts else -1)
        while (at >= 0).any():
            for n in np.unique(at[at >= 0]):
                rows, (eye, high, radius, inside, outside) = np.flatnonzero(at == n), cuts[n]
                d = between(points[rows] @ eye + lift[rows] * high, self.most[shell])
                at[rows] = np.where(d <= radius, inside, outside)
        return -1 - at

    def stretched(self, shell: tuple[int, int], queries: np.ndarray) -> np.ndarray:
        return queries * (self.most[shell] / np.linalg.norm(queries, axis=1))[:, None]

    def home(self, shell: tuple[int, int], queries: np.ndarray) -> np.ndarray:
        return self.shard(shell, self.stretched(shell, queries), np.zeros(len(queries)))

    def bounds(self, shell: tuple[int, int], queries: np.ndarray) -> np.ndarray:
        """Least distance of each query to each shard of a shell."""
        cuts, n = self.cuts.get(shell, ((), 1))
        out, at = np.zeros((len(queries), n)), self.stretched(shell, queries)
        todo = [(0, np.zeros(len(queries)))] if cuts else []
        while todo:
            node, low = todo.pop()
            eye, _, radius, inside, outside = cuts[node]
            d = between(at @ eye, self.most[shell])
            for child, here in ((inside, np.maximum(low, d - radius)), (outside, np.maximum(low, radius - d))):
                if child >= 0:
                    todo.append((child, here))
                else:
                    out[:, -1 - child] = here
        return out


def tuned(samples: dict[tuple[int, int], np.ndarray], most: dict[tuple[int, int], float], fullest: dict[int, tuple[int, int]], k: int) -> float:
    """The largest factor that keeps the asked recall when sampled rows of every shell ask the sample; one if none does."""
    lists = []  # per vector length: trees, the fullest shell's first, and the queries
    for dim, first in fullest.items():
        mine = [s for s in samples if s[0] == dim]
        rows = sum(len(samples[s]) for s in mine)
        step = -(-rows // TRIAL_ROWS) if rows else 1
        trees, points, at = [], [], 0
        for shell in sorted(mine, key=lambda s: s != first):
            here = samples[shell][::step]
            trees.append(Tree.build(np.arange(at, at + len(here)), here, most[shell], LEAF_ROWS))
            points.append(here)
            at += len(here)
        if at:
            own = np.arange(at)[:: -(-at // TRIAL_QUERIES)]
            lists.append((trees, own, np.concatenate(points)[own]))

    def found(trees, own, queries, factor):
        best = np.full((len(own), k), -np.inf)
        for tree in trees:
            score, _ = tree.search(own, queries, best[:, -1], k, factor)
            best = -np.sort(-np.hstack([best, score]), axis=1)[:, :k]
        return best

    exact = [found(*x, 1.0) for x in lists]
    slack = [1e-9 * np.abs(np.where(np.isneginf(e), 0, e)).max() for e in exact]
    for factor in FACTORS:
        if all((found(*x, factor) >= e - s).mean() >= RECALL for x, e, s in zip(lists, exact, slack, strict=True)):
            return factor
    return 1.0


def by_shell(batch: pa.RecordBatch):
    """The rows of a batch per shell: (shell, row numbers, matrix)."""
    keys = np.stack([batch.column(c).to_numpy() for c in _SHELL], axis=1)
    for dim, shell in np.unique(keys, axis=0):
        rows = np.flatnonzero((keys == (dim, shell)).all(axis=1))
        yield (int(dim), int(shell)), rows, matrix(batch.column("v").take(pa.array(rows)))


def _lists(points: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1) * points.shape[1], pa.int32()), pa.array(np.ascontiguousarray(points).ravel()))


def _asked(ids, points, shell, leaf, part, floor) -> pa.RecordBatch:
    fixed = [pa.array(np.full(len(points), x), pa.int32()) for x in shell]
    return pa.RecordBatch.from_arrays([pa.array(ids), _lists(points), *fixed, pa.array(leaf, pa.int32()), pa.array(part, pa.int32()), pa.array(floor, pa.float64())],
                                      ["id", "v", *_PART, "floor"])


class Index:
    """The stored trees of ``vectors`` and what it takes to ask them. One row per shell reaches the driver, and the sample."""

    def __init__(self, vectors: DataFrame, key: str, vector: str):
        self.points = materialize(usable(vectors, key, vector), "vantage-points")
        sizes = {(r["dim"], r["shell"]): (r["n"], r["most"]) for r in self.points.groupBy(*_SHELL).agg(F.count("*").alias("n"), F.max("norm").alias("most")).collect()}
        shards = {s: -(-n // SHARD_ROWS) for s, (n, _) in sizes.items()}
        most = {s: m * (1 + 1e-12) for s, (_, m) in sizes.items()}
        size = min(SAMPLE_ROWS, PER_SHARD * max(sum(shards.values()), 16))
        share = min(1.0, 1.2 * size / max(sum(n for n, _ in sizes.values()), 1))
        picked = self.points.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("id"), "id").limit(size)
        found: dict[tuple[int, int], list] = {}
        for r in picked.select(*_SHELL, "v").collect():
            found.setdefault((r["dim"], r["shell"]), []).append(r["v"])
        self.samples = {s: np.array(v, dtype=np.float64) for s, v in found.items()}
        self.router = Router(self.samples, shards, most)
        self.fullest = {dim: max((s for s in sizes if s[0] == dim), key=lambda s: sizes[s]) for dim, _ in sizes}
        self.trees, self.parts = self._build()

    def _build(self) -> tuple[DataFrame, dict[tuple[int, int, int], int]]:
        router, leaf_rows = self.router, LEAF_ROWS

        def route(batches):
            for batch in batches:
                for shell, rows, points in by_shell(batch):
                    leaf = router.shard(shell, points, lifted(points, router.most[shell]))
                    ids = batch.column("id").take(pa.array(rows)).to_numpy()
                    yield _asked(ids, points, shell, leaf, np.zeros(len(rows), np.int32), np.zeros(len(rows))).select(["id", "v", *_SHELL, "leaf"])

        def build(rows: pa.Table) -> pa.Table:
            own = [rows[c][0].as_py() for c in _PART]
            tree = Tree.build(rows["id"].to_numpy(), matrix(rows["v"]), router.most[own[0], own[1]], leaf_rows)
            cols = [pa.array([x], pa.int32()) for x in own] + [pa.array([a.tobytes()], pa.binary()) for a in (tree.ids, tree.points, tree.lift, tree.nodes, tree.bounds)]
            return pa.Table.from_arrays(cols, [*_PART, "ids", "points", "lift", "nodes", "bounds"])

        dealt = materialize(self.points.mapInArrow(route, "id long, v array<double>, dim int, shell int, leaf int"), "vantage-dealt")
        counts = dealt.groupBy(*_SHELL, "leaf").count()  # as many rows as the router has shards
        parts = {(r["dim"], r["shell"], r["leaf"]): -(-r["count"] // SHARD_ROWS) for r in counts.collect()}
        split = dealt.join(F.broadcast(counts), [*_SHELL, "leaf"])
        split = split.withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("count") / SHARD_ROWS)).cast("int")).drop("count")
        schema = "dim int, shell int, leaf int, part int, ids binary, points binary, lift binary, nodes binary, bounds binary"
        return materialize(split.groupBy(*_PART).applyInArrow(build, schema), "vantage-trees"), parts

    def nearest(self, chosen: Column, k: int, factor: float | None = None) -> DataFrame:
        """(query_id, rank, vec_id, score): the k best of all rows for every indexed row that ``chosen`` (a condition on id) picks."""
        factor = tuned(self.samples, self.router.most, self.fullest, k) if factor is None else factor
        router, parts, fullest = self.router, self.parts, self.fullest
        shells = {dim: [s for s in router.most if s[0] == dim] for dim in fullest}
        queries = self.points.where(chosen)

        def first_part(batches):
            for batch in batches:
                for (dim, _), rows, points in by_shell(batch):
                    leaf = router.home(fullest[dim], points)
                    of = np.array([parts.get((*fullest[dim], int(s)), 1) for s in leaf])
                    ids = batch.column("id").take(pa.array(rows)).to_numpy()
                    yield _asked(ids, points, fullest[dim], leaf, ids % of, np.full(len(rows), -np.inf))

        def other_parts(batches):
            for batch in batches:
                for (dim, _), rows, points in by_shell(batch):
                    ids, floor = (batch.column(c).take(pa.array(rows)).to_numpy() for c in ("id", "floor"))
                    length = np.linalg.norm(points, axis=1)
                    for shell in shells[dim]:
                        at_home = router.home(shell, points) if shell == fullest[dim] else np.full(len(rows), -1)
                        bound = router.bounds(shell, points)
                        for leaf in range(bound.shape[1]):
                            of = parts.get((*shell, leaf), 0)
                            fits = near(bound[:, leaf], floor, length, router.most[shell], factor)
                            for part in range(of):
                                ask = np.flatnonzero(fits & ~((at_home == leaf) & (ids % of == part)))
                                if len(ask):
                                    yield _asked(ids[ask], points[ask], shell, np.full(len(ask), leaf), np.full(len(ask), part), floor[ask])

        first = materialize(self._ask(queries.mapInArrow(first_part, _ASKED), k, factor), "vantage-first")
        floors = first.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("low"))
        floors = floors.select("id", F.when(F.col("n") >= k, F.col("low")).otherwise(float("-inf")).alias("floor"))
        again = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        rows = first.unionByName(self._ask(again.select("id", "v", *_SHELL, "floor").mapInArrow(other_parts, _ASKED), k, factor))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def _ask(self, asked: DataFrame, k: int, factor: float) -> DataFrame:
        """The k best of each asked part: a part and a block of its queries meet in one bounded group."""
        most, block_rows = self.router.most, QUERY_BLOCK
        asked = materialize(asked, "vantage-asked")
        blocks = asked.groupBy(*_PART).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
        trees = self.trees.join(blocks, _PART).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        asked = asked.join(blocks, _PART).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")

        def search(tree_rows: pa.Table, rows: pa.Table) -> pa.Table:
            if not len(rows):  # a block that no query fell into
                return pa.Table.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], ["query_id", "vec_id", "score"])
            raw = {c: tree_rows[c][0].as_py() for c in tree_rows.column_names}
            ids = np.frombuffer(raw["ids"], np.int64)
            tree = Tree(ids, np.frombuffer(raw["points"]).reshape(len(ids), -1), np.frombuffer(raw["lift"]), np.frombuffer(raw["nodes"], np.int64).reshape(-1, 5),
                        np.frombuffer(raw["bounds"]).reshape(-1, 4), most[raw["dim"], raw["shell"]])
            own = rows["id"].to_numpy()
            score, who = tree.search(own, matrix(rows["v"]), rows["floor"].to_numpy(), k, factor)
            real = ~np.isneginf(score)
            return pa.Table.from_arrays([pa.array(np.repeat(own, real.sum(axis=1))), pa.array(who[real]), pa.array(score[real])], ["query_id", "vec_id", "score"])

        key = [*_PART, "block"]
        return trees.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(search, "query_id long, vec_id long, score double")
