"""Near-duplicate join on word shingles with count-vector R-trees.

The distinct shingles of a document are hashed into groups; the counts per group are its point. Two documents share at
most the sum of the smaller counts, so a pair, or two whole tree nodes, whose bound stays under what the similarity asks
for can't link. Survivors are verified on their whole shingle sets.

1. A profile per document: set size, set id, point, and the first shingles in a fixed order. Documents of the asked
   similarity share one of those, so each such shingle is a block and documents alone in all their blocks are done.
   Where a shingle stands in the order bounds what two members can share that have no earlier one in common; members that
   so have no possible partner leave the block.
2. Each set is held against one other, the one that comes first in most of its blocks: bound, then verification. Thousands
   of near copies cost one pair each, and become one component or a few; a turn holds one member of each, in every block,
   against another.
3. Blocks that still hold several components are searched with an R-tree for pairs across components; those are verified too.
   A round takes the likeliest partners of each set; blocks that had more are searched again with the components that came
   of it, the last time for all pairs.
4. Components of all links; members of one component need no further pairs, so no link between different texts is lost.

Rows: a null or empty text, or one without words, has an empty set and stands alone. Equal sets are one point with one
set id. Repeated rows come back as often as they came. A null doc_id keeps its row, with a null component unless it is
linked; it never names a component. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkdesk.llm.common import components, keep_ids
from sparkdesk.llm.textbytes import mix, slices, spaced_words, windows
from sparkdesk.session import materialize

WIDTH = 5
PERCENT = 75
PER_GROUP = 2  # shingles per group of a point, at most
LEAST_GROUPS = 64
MOST = 255  # a count that doesn't fit stands for "any number"
ANY = 60_000
TURNS = 1
SIZE_STEP = 1.1  # sizes in one class differ by less
SAMPLE_DOCS = 4096  # documents whose shingles decide which ones are common
COMMON_SHARE = 200  # common: in more than one of so many sampled documents
COMMON_MOST = 65_536
FANOUT = 16
PARTNERS = 4  # of a set in one block, in the first round of the search; four times as many in each further one
ROUNDS = 3  # with bounded partners; then all pairs that are left
PAIRS_HELD = 200_000  # before the likeliest are chosen
PAIRS_AT_ONCE = 2048  # of tree nodes, in one piece of work


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` make one shingle of them all."""
    words, first = spaced_words(column)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b == a:
            yield np.empty(0, np.uint64)
        elif b - a < width:
            yield windows(words[a:b], b - a)
        else:
            found = windows(words[a:b], width)
            found.sort()
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]


def lead_size(n: int, percent: int) -> int:
    """So many first members that sets of the asked similarity share one of them."""
    return n - (percent * n + 99) // 100 + 1


def point(found: np.ndarray) -> np.ndarray:
    """Counts per group. The number of groups is the power of two that keeps them small; a larger point folds to a smaller one."""
    groups = max(LEAST_GROUPS, 1 << max(0, (len(found) - 1) // PER_GROUP).bit_length())
    return np.minimum(np.bincount((found & np.uint64(groups - 1)).astype(np.int64), minlength=groups), MOST).astype(np.uint8)


def counts_of(stored: bytes, groups: int) -> np.ndarray:
    """A stored point folded to ``groups`` counts."""
    counts = np.frombuffer(stored, np.uint8).astype(np.uint16)
    counts[counts == MOST] = ANY
    return np.minimum(counts.reshape(-1, groups).sum(axis=0, dtype=np.int64), ANY).astype(np.uint16)


def set_id(found: np.ndarray) -> int:
    """An id of a set; its last byte is the class of its size."""
    code = min(255, int(np.log(len(found)) / np.log(SIZE_STEP)))
    value = int(mix(np.array([mix(found).sum(dtype=np.uint64) + np.uint64(len(found))]))[0])
    return int(np.uint64((value & ~0xFF) | code).astype(np.int64))


def linked(shared: int | np.ndarray, n: int | np.ndarray, m: int | np.ndarray, percent: int):
    return (shared * (100 + percent) >= percent * (n + m)) & (np.minimum(n, m) > 0)


class CountTree:
    """An R-tree packed over count vectors: points sorted by size and heaviest group, cut into nodes of ``FANOUT``.

    A node keeps the largest count per group and the smallest size below it; that bounds every pair under two nodes.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray | None = None):
        self.order = np.lexsort((points.argmax(axis=1), sizes))
        self.tops, self.least, self.largest = [points[self.order]], [sizes[self.order]], [sizes[self.order]]
        labels = np.arange(len(sizes)) if labels is None else labels
        self.low, self.high = [labels[self.order]], [labels[self.order]]  # pairs of one label are not asked for
        while len(self.tops[-1]) > 1:
            cut = np.arange(0, len(self.tops[-1]), FANOUT)
            self.tops.append(np.maximum.reduceat(self.tops[-1], cut))
            self.least.append(np.minimum.reduceat(self.least[-1], cut))
            self.largest.append(np.maximum.reduceat(self.largest[-1], cut))
            self.low.append(np.minimum.reduceat(self.low[-1], cut))
            self.high.append(np.maximum.reduceat(self.high[-1], cut))

    def bound(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether some pair under the nodes ``a`` and ``b`` of a level may link."""
        small, top = self.least[level], self.largest[level]
        fits = (100 * top[a] >= percent * small[b]) & (100 * top[b] >= percent * small[a])
        if level:
            fits &= np.minimum(self.low[level][a], self.low[level][b]) != np.maximum(self.high[level][a], self.high[level][b])
        at = np.flatnonzero(fits)
        fits[at] = self.shared(level, a[at], b[at]) * (100 + percent) >= percent * (small[a[at]] + small[b[at]])
        return fits

    def shared(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum(self.tops[level][a], self.tops[level][b]).sum(axis=1, dtype=np.int64)

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows of different labels (each once) that the bounds leave, by a joint descent in pieces of bounded size."""
        step = max(64, min(PAIRS_AT_ONCE, (2 << 20) // self.tops[0].shape[1]))  # a node pair opens into FANOUT squared
        todo = [(len(self.tops) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, a, b = todo.pop()
            if len(a) > step:
                todo += [(level, a[step:], b[step:])]
                a, b = a[:step], b[:step]
            keep = self.bound(level, a, b, percent)
            a, b = a[keep], b[keep]
            if not level:
                off = (a < b) & (self.low[0][a] != self.low[0][b])
                yield self.order[a[off]], self.order[b[off]]
            elif len(a):
                below, span = len(self.tops[level - 1]), np.arange(FANOUT)
                x = (a[:, None, None] * FANOUT + span[:, None]).repeat(FANOUT, axis=2).ravel()
                y = (b[:, None, None] * FANOUT + span[None, :]).repeat(FANOUT, axis=1).ravel()
                real = (x < below) & (y < below) & (x <= y)
                todo.append((level - 1, x[real], y[real]))


def common_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles of many documents, commonest last, as a bounded sample shows them. They only order the shingles: results don't depend on them."""
    rows = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(rows, 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def found(batches):
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column(0), width))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["key"])

    least = max(3, int(rows * share) // COMMON_SHARE)
    counted = sample.select("text").mapInArrow(found, "key long").groupBy("key").count().where(F.col("count") >= least)
    top = counted.orderBy(F.desc("count"), "key").limit(COMMON_MOST).collect()
    return np.array([r["key"] for r in reversed(top)], dtype=np.int64).view(np.uint64)


def profiles(docs: DataFrame, width: int, percent: int) -> DataFrame:
    common = common_shingles(docs, width)
    by_value = np.argsort(common)
    ordered = common[by_value]

    def profile(batches):
        said = set()
        for batch in slices(batches):
            out = [[], [], [], []]
            named = batch.column("doc_id").is_valid().to_pylist()  # a row without an id names no blocks
            for found, has_id in zip(shingle_sets(batch.column("text"), width), named, strict=True):
                n = len(found)
                sid = set_id(found) if n else None
                lead = None
                if n and has_id and sid not in said:  # a set's blocks are named once in a task
                    said.add(sid)
                    if len(said) > 1_000_000:
                        said.clear()
                    size = lead_size(n, percent)
                    if len(common):
                        at = np.minimum(np.searchsorted(ordered, found), len(ordered) - 1)
                        hit = ordered[at] == found
                        rank = np.where(hit, by_value[at] + 1, 0)
                        lead = found[np.argsort(rank, kind="stable")[:size]]
                    else:
                        lead = found[:size]
                for column, value in zip(out, (n, sid, point(found).tobytes() if n else None, lead), strict=True):
                    column.append(value)
            flat_leads = [x for x in out[3] if x is not None]
            at = np.cumsum([0] + [len(x) if x is not None else 0 for x in out[3]])
            leads = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array((np.concatenate(flat_leads) if flat_leads else np.empty(0, np.uint64)).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), leads],
                ["doc_id", "n_shingles", "sid", "point", "lead"],
            )

    return docs.mapInArrow(profile, "doc_id long, n_shingles long, sid long, point binary, lead array<long>")


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """The pairs (u, v) of set ids whose whole sets link: a bound on the points first, then the texts."""
    left, right = (sets.select(F.col("sid").alias(k), F.col("doc_id").alias(f"{k}_doc"), F.col("n").alias(f"{k}_n"), F.col("point").alias(f"{k}_point")) for k in "uv")

    def bounded(batches):
        for batch in batches:
            points = (batch.column(f"{k}_point").to_pylist() for k in "uv")
            sizes = (batch.column(f"{k}_n").to_pylist() for k in "uv")
            keep = []
            for a, b, n, m in zip(*points, *sizes, strict=True):
                groups = min(len(a), len(b))
                keep.append(bool(linked(int(np.minimum(counts_of(a, groups), counts_of(b, groups)).sum(dtype=np.int64)), n, m, percent)))
            yield batch.select(["u", "v", "u_doc", "v_doc"]).filter(pa.array(keep, pa.bool_()))

    near = pairs.join(left, "u").join(right, "v").where(f"100 * least(u_n, v_n) >= {percent} * greatest(u_n, v_n)")
    near = materialize(near.mapInArrow(bounded, "u long, v long, u_doc long, v_doc long"), f"{name}-near")
    ids = materialize(near.select(F.col("u_doc").alias("doc_id")).union(near.select("v_doc")).distinct(), f"{name}-ids")
    texts = keep_ids(docs, ids, "doc_id")

    def verify(batches):
        for batch in slices(slices(batches, "u_text"), "v_text"):
            both = zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), shingle_sets(batch.column("u_text"), width), shingle_sets(batch.column("v_text"), width), strict=True)
            keep = [bool(len(x) and len(y) and set_id(x) == u and set_id(y) == v and linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)) for u, v, x, y in both]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    at = near.join(texts.select(F.col("doc_id").alias("u_doc"), F.col("text").alias("u_text")), "u_doc")
    at = at.join(texts.select(F.col("doc_id").alias("v_doc"), F.col("text").alias("v_text")), "v_doc")
    return materialize(at.select("u", "v", "u_text", "v_text").mapInArrow(verify, "u long, v long").distinct(), f"{name}-links")


def _size(at: Column) -> Column:
    return F.shiftrightunsigned(at, 32)


def _rest(at: Column) -> Column:
    """The shingles of a set from a place on: as many as it can share with a set that it meets there first."""
    return _size(at) - at.bitwiseAND(F.lit(0xFFFFFFFF))


def _with_partners(members: DataFrame, percent: int) -> DataFrame:
    """Members of blocks (key, sid, at) that may link with another one of their block, by sizes; of two by their places too."""
    block = Window.partitionBy("key")
    by_size = block.orderBy("at", "sid")
    at, before, after = F.col("at"), F.lag("at").over(by_size), F.lead("at").over(by_size)
    other = F.coalesce(before, after)
    both = F.least(_rest(at), _rest(other)) * (100 + percent) >= (_size(at) + _size(other)) * percent
    sizes = (_size(before) * 100 >= _size(at) * percent) | (_size(at) * 100 >= _size(after) * percent)
    near = F.when(F.count("*").over(block) == 2, both).otherwise(sizes)
    return members.withColumn("near", near).where("near").drop("near")


def _joined(labels: DataFrame, more: DataFrame, name: str) -> DataFrame:
    """``labels`` (node, label: the smallest of its component) after further links ``more`` (u, v): only the labels they tie are joined anew."""
    for k in "uv":
        of = labels.select(F.col("node").alias(k), F.col("label").alias(f"{k}_label"))
        more = more.join(of, k, "left").withColumn(f"{k}_label", F.coalesce(f"{k}_label", k))
    more = materialize(more.select("u", "v", "u_label", "v_label"), f"{name}-tied")
    moved = components(more.select(F.col("u_label").alias("u"), F.col("v_label").alias("v")).where("u <> v"), name)
    fresh = more.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(labels, "node", "left_anti").withColumn("label", F.col("node"))
    nodes = labels.union(fresh).withColumnRenamed("label", "old")
    return materialize(nodes.join(moved.withColumnsRenamed({"node": "old"}), "old", "left").select("node", F.coalesce("label", "old").alias("label")), f"{name}-joined")


def likeliest(a: np.ndarray, b: np.ndarray, bound: np.ndarray, most: int) -> np.ndarray:
    """Of pairs (a, b) those with one of the ``most`` highest bounds of either end."""
    ends, times, pair = np.concatenate([a, b]), np.tile(bound, 2), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((-times, ends))
    ends = ends[order]
    heads = np.flatnonzero(np.concatenate(([True], ends[1:] != ends[:-1])))
    rank = np.arange(len(ends)) - np.repeat(heads, np.diff(np.append(heads, len(ends))))
    return np.unique(pair[order[rank < most]])


def _across(blocks: DataFrame, sets: DataFrame, percent: int, most: int | None) -> DataFrame:
    """(u, v): pairs of set ids of different labels in one block of ``blocks`` (key, sid, label, at) that the bounds leave.

    With ``most`` the likeliest of each set; a block that had more is named by a row of its key and null.
    """

    def across(batches):
        held, last = [], None
        for batch in batches:
            keys = batch.column("key").to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if keys[a] != last:
                    yield from search(held)
                    held, last = [], keys[a]
                held.append(batch.slice(a, b - a))
        yield from search(held)

    def search(held):
        if not held:
            return
        whole = pa.Table.from_batches(held)
        sid, label, at = (whole.column(c).to_numpy() for c in ("sid", "label", "at"))
        n, points = at >> 32, whole.column("point").to_pylist()
        rest = n - (at & 0xFFFFFFFF)
        groups = np.array([len(p) for p in points])
        cut = False
        for here in np.unique(groups):  # sizes of a pair are alike, so its numbers of groups differ by a factor of two at most
            rows = np.flatnonzero((groups == here) | (groups == 2 * here))
            stacked = np.stack([counts_of(points[i], here) for i in rows])
            tree = CountTree(stacked, n[rows], label[rows])
            best = [np.empty(0, np.int64)] * 3
            for a, b in tree.pairs(percent):
                x, y = rows[a], rows[b]
                off = (groups[x] == here) | (groups[y] == here)
                off &= linked(np.minimum(rest[x], rest[y]), n[x], n[y], percent)  # holds in the first block of a linked pair at least
                if most is None:
                    yield from out(sid[x[off]], sid[y[off]])
                    continue
                a, b = a[off], b[off]
                bound = np.minimum(stacked[a], stacked[b]).sum(axis=1, dtype=np.int64) / (n[rows[a]] + n[rows[b]])
                best = [np.concatenate(c) for c in zip(best, (a, b, bound), strict=True)]
                if len(best[0]) > PAIRS_HELD + len(rows) * most:
                    best, cut = [c[likeliest(*best, most)] for c in best], True
            if most is not None and len(best[0]):
                kept = likeliest(*best, most)
                cut |= len(kept) < len(best[0])
                yield from out(sid[rows[best[0][kept].astype(np.int64)]], sid[rows[best[1][kept].astype(np.int64)]])
        if cut:
            yield pa.RecordBatch.from_arrays([whole.column("key").slice(0, 1).combine_chunks(), pa.array([None], pa.int64())], ["u", "v"])

    def out(u, v):
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

    rows = blocks.join(sets.select("sid", "point"), "sid").select("key", "sid", "label", "at", "point")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(across, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): one row per row of ``docs`` (doc_id, text).

    ``n_links`` counts the verified links of the document's set, enough of them to hold its component together.
    """
    docs = docs.select("doc_id", "text")
    profile = materialize(profiles(docs, width, percent), "jaccard-profiles")
    sets = materialize(
        profile.where("sid is not null and doc_id is not null").groupBy("sid").agg(F.min_by(F.struct("doc_id", "n_shingles", "point"), "doc_id").alias("x"))
        .select("sid", "x.doc_id", F.col("x.n_shingles").alias("n"), "x.point"), "jaccard-sets")

    members = profile.where("lead is not null and doc_id is not null").select("sid", "n_shingles", F.posexplode("lead").alias("pos", "key"))
    members = members.select("key", "sid", (F.shiftleft("n_shingles", 32) + F.col("pos")).alias("at"))  # set size and place, in one number
    block = Window.partitionBy("key")
    members = members.withColumns({"low": F.min("sid").over(block), "high": F.max("sid").over(block)}).where("low < high")
    members = _with_partners(members.select("key", "sid", "at").distinct(), percent)
    members = materialize(members.withColumn("u", F.min("sid").over(block)), "jaccard-blocks")

    shared = members.where("u < sid").groupBy("u", F.col("sid").alias("v")).agg(F.count("*").alias("blocks"))
    tested = materialize(shared.groupBy("v").agg(F.max_by("u", F.struct("blocks", F.bitwise_not("u"))).alias("u")).select("u", "v"), "jaccard-pairs")
    links = _verified(tested, docs, sets, width, percent, "jaccard-first")
    labels = components(links, "jaccard-first")
    for turn in range(TURNS):  # components meet by one member each, another one every turn, while that joins some
        labelled = members.join(labels, members["sid"] == labels["node"], "left").select("key", "sid", F.coalesce("label", "sid").alias("label"))
        rank = F.xxhash64("sid", F.lit(turn))
        heads = labelled.groupBy("key", "label").agg(F.min(F.struct(rank.alias("rank"), "sid")).alias("head"))
        hub = F.min("head").over(block)
        heads = heads.select(F.col("head.sid").alias("sid"), hub["sid"].alias("hub")).where("sid <> hub")
        pairs = heads.select(F.least("sid", "hub").alias("u"), F.greatest("sid", "hub").alias("v")).distinct()
        pairs = materialize(pairs.join(tested, ["u", "v"], "left_anti"), "jaccard-pairs")
        more = _verified(pairs, docs, sets, width, percent, "jaccard-turn")
        tested = tested.union(pairs)
        if more.limit(1).count() == 0:
            break
        links, labels = links.union(more), _joined(labels, more, "jaccard-turn")
    blocks = members
    for most in [*(PARTNERS * 4**i for i in range(ROUNDS)), None]:
        labelled = blocks.join(labels, blocks["sid"] == labels["node"], "left").select("key", "sid", "at", F.coalesce("label", "sid").alias("label"))
        places = F.sum(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))).alias("places")
        mixed = labelled.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.bit_xor(F.xxhash64("sid")).alias("mark"), places)
        mixed = mixed.where("low < high and n > 2").groupBy("n", "low", "high", "mark").agg(F.min_by("key", "places").alias("key")).select("key")  # equal blocks once: the first in the order
        labelled = materialize(_with_partners(labelled.join(mixed, "key", "left_semi"), percent), "jaccard-mixed")
        found = materialize(_across(labelled, sets, percent, most), "jaccard-found")
        pairs = materialize(found.where("v is not null").join(tested, ["u", "v"], "left_anti"), "jaccard-across")
        more = _verified(pairs, docs, sets, width, percent, "jaccard-across")
        links, tested = links.union(more), tested.union(pairs)
        labels = _joined(labels, more, "jaccard-across")
        left = found.where("v is null").select(F.col("u").alias("key"))
        if left.limit(1).count() == 0:
            break
        blocks = labelled.select("key", "sid", "at").join(left, "key", "left_semi")

    named = sets.select("sid", "doc_id").join(labels, sets["sid"] == labels["node"], "left").select("sid", "doc_id", F.coalesce("label", "sid").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    ends = links.select(F.explode(F.array("u", "v")).alias("sid")).groupBy("sid").agg(F.count("*").alias("n_links"))
    named = named.join(least, "label").select("sid", "component_id").join(ends, "sid", "left")
    return profile.select("doc_id", "n_shingles", "sid").join(named, "sid", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The documents whose id is the smallest of their component; all columns. A repeated row of one id stays as often as it came; a null id stays."""
    found = near_duplicates(docs, **options)
    lost = materialize(found.where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-lost")
    return docs.join(lost, "doc_id", "left_anti").select(docs.columns)
