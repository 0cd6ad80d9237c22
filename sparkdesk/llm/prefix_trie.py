"""Prefix trie of conversations by vertical bitmaps.

1. Turns get their positions by an ordered scan; a turn is then known by 128 bits of its position, role and text.
2. Conversations are cut into bands of ``BAND`` positions. A band knows its root, the prefix ahead of it, as the
   exclusive-or of the turns before (an ordered scan again), so a conversation of any length is as many small rows.
3. Bands are sorted into ranges by root and conversation; a task takes up to ``SHARD`` conversations under one root at a
   time. There an index maps each (position, turn) to the bitset of its conversations, and a depth-first descent meets
   the parent's bitset with the postings: members by popcount, children, and the list of conversations that end.
   A root with more conversations is several shards, whose nodes are added up by their 128-bit id.
4. Every node belongs to its smallest member. A node's subtree holds the whole of what its members own, less what its
   owner owns above it, so sums over subtrees are sums over members: one more addition, whatever the depth.

Rows: turns of a null conversation id are left out. Null role or text is empty; turns of equal number follow by role and
text; repeated rows are repeated turns. A conversation whose turns all fall away ends at the root. An empty table has no
node. Very long texts count by hash and length only. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.operators.ordered import SUM, XOR, running
from sparkdesk.session import materialize

BAND = 32  # positions of a conversation in one row
SHARD = 4096  # conversations whose bitsets are held at a time
PARTS = "k1 long, k2 long, p1 long, p2 long, depth long, least long, n long, chars long, members array<long>, ends array<long>"
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def positioned(turns: DataFrame) -> DataFrame:
    """(conv_id, pos from 0, t1, t2, chars) of turns (conv_id, turn, role, text): the hash and the length stay of a text."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", *said)
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    keep = ["conv_id", half(1).alias("t1"), half(17).alias("t2"), F.length("text").cast("long").alias("chars")]
    placed = running(rows, ["conv_id"], ["turn", "role", "text"], {"pos": (SUM, F.lit(1))}, keep)
    return materialize(placed.withColumn("pos", F.col("pos") - 1), "trie-turns")


def with_shared_openings(turns: DataFrame, group: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations and turns in which c opens with the first ``h = crc32(c) % most`` turns of conversation ``c - c % group``.

    The rest are its own turns after its first h. All of the opening if it is shorter, none if there is no such conversation.
    """
    size = turns.groupBy("conv_id").agg(F.max("pos").alias("size")).select("conv_id", (F.col("size") + 1).alias("size"))
    convs = size.select("conv_id", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    base = size.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = convs.join(base, "base", "left").withColumn("opened", F.least("h", F.coalesce("base_size", F.lit(0))))
    convs = materialize(convs.select("conv_id", "base", "h", "opened"), "trie-conversations")
    heads = turns.where(F.col("pos") < most).select(F.col("conv_id").alias("base"), "pos", "t1", "t2", "chars")
    opening = convs.where("opened > 0").join(heads, "base").where("pos < opened").select("conv_id", "pos", "t1", "t2", "chars")
    own = turns.join(convs.select("conv_id", "h", "opened"), "conv_id").where("pos >= h")
    return convs.select("conv_id"), opening.unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("opened")).alias("pos"), "t1", "t2", "chars"))


def bands(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(r1, r2, band, conv_id, k1s, k2s, chars, last): the turns of a conversation in bands, under the prefix ahead of each.

    A conversation without turns is one empty band.
    """
    rows = turns.select("conv_id", F.floor(F.col("pos") / BAND).alias("band"), "pos",
                        F.xxhash64("pos", "t1", "t2").alias("k1"), F.xxhash64("pos", "t2", "t1", F.lit(1)).alias("k2"), "chars")
    cut = rows.groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(F.struct("pos", "k1", "k2", "chars"))).alias("turns"), F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"))
    cut = cut.select("conv_id", "band", "turns.k1", "turns.k2", "turns.chars", "x1", "x2")
    ends = cut.groupBy("conv_id").agg(F.max("band").alias("final"))
    cut = materialize(cut, "trie-bands")
    roots = running(cut.select("conv_id", "band", "x1", "x2"), ["conv_id"], ["band"], {"r1": (XOR, F.col("x1")), "r2": (XOR, F.col("x2"))}, before=True)
    cut = cut.drop("x1", "x2").join(roots.select("conv_id", "band", "r1", "r2"), ["conv_id", "band"]).join(ends, "conv_id")
    cut = cut.select("r1", "r2", "band", "conv_id", F.col("k1").alias("k1s"), F.col("k2").alias("k2s"), "chars", (F.col("band") == F.col("final")).alias("last"))
    none = F.array().cast("array<long>")
    bare = convs.join(ends, "conv_id", "left_anti").select(
        F.lit(0).cast("long").alias("r1"), F.lit(0).cast("long").alias("r2"), F.lit(0).cast("long").alias("band"), "conv_id",
        none.alias("k1s"), none.alias("k2s"), none.alias("chars"), F.lit(True).alias("last"))
    return cut.unionByName(bare)


class Shard:
    """Vertical bitmaps over some conversations with one prefix: bit i of a posting is conversation i."""

    def __init__(self, root: tuple[int, int], start: int, convs: list[int], turns: list[list[tuple[int, int]]], chars: list[list[int]], last: list[bool]):
        self.root, self.start, self.convs, self.turns, self.chars, self.last = root, start, convs, turns, chars, last
        self.postings: list[dict[tuple[int, int], int]] = []
        self.ended: list[int] = []  # by position: conversations that have no turn there
        for pos in range(max(map(len, turns), default=0) + 1):
            here: dict[tuple[int, int], list[int]] = {}
            gone = 0
            for i, own in enumerate(turns):
                if pos < len(own):
                    here.setdefault(own[pos], []).append(i)
                elif pos == len(own):
                    gone |= 1 << i
            self.postings.append({k: _bitset(v) for k, v in here.items()})
            self.ended.append(gone)

    def nodes(self) -> Iterator[tuple]:
        """Each node under the root (and the root itself in the first band), depth first."""
        every = (1 << len(self.convs)) - 1
        todo = [(0, every, self.root, None, 0)]
        while todo:
            pos, members, node, parent, chars = todo.pop()
            ends = [i for i in _bits(members & self.ended[pos]) if self.last[i]]
            if pos or not self.start:
                yield self._row(node, parent, pos, members, chars, ends)
            rest = members & ~self.ended[pos]
            while rest:  # the posting of the lowest conversation left, cut with the parent's members, is a child
                first = (rest & -rest).bit_length() - 1
                turn = self.turns[first][pos]
                child = rest & self.postings[pos][turn]
                rest ^= child
                todo.append((pos + 1, child, (node[0] ^ turn[0], node[1] ^ turn[1]), node, self.chars[first][pos]))

    def _row(self, node, parent, pos, members, chars, ends):
        mine = [self.convs[i] for i in _bits(members)]
        p1, p2 = parent or (None, None)
        return (*node, p1, p2, self.start + pos, mine[0], len(mine), chars, mine, [self.convs[i] for i in ends])


def _bitset(places: list[int]) -> int:
    if len(places) == 1:
        return 1 << places[0]
    held = bytearray(places[-1] // 8 + 1)
    for i in places:
        held[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(held, "little")


def _bits(held: int) -> Iterator[int]:
    while held:
        low = held & -held
        yield low.bit_length() - 1
        held ^= low


def shard_nodes(cut: DataFrame) -> DataFrame:
    """The nodes of every shard (see PARTS): id, parent's id, depth, smallest member, members, last text's length, ends."""
    by = [F.col(c).asc_nulls_first() for c in ("band", "r1", "r2", "conv_id")]
    schema = pa.schema([(c, pa.int64()) for c in ("k1", "k2", "p1", "p2", "depth", "least", "n", "chars")] + [(c, pa.list_(pa.int64())) for c in ("members", "ends")])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def descend(held):
        (band, r1, r2), rows = held
        convs, turns, chars, last = (list(x) for x in zip(*rows, strict=True))
        return Shard((r1, r2), band * BAND, convs, turns, chars, last).nodes()

    def shards(batches):
        root, rows = None, []
        for b in batches:
            band, r1, r2, conv, k1s, k2s, chars, last = (b.column(c).to_pylist() for c in ("band", "r1", "r2", "conv_id", "k1s", "k2s", "chars", "last"))
            for i, here in enumerate(zip(band, r1, r2, strict=True)):
                if here != root or len(rows) >= SHARD:
                    if rows:
                        yield root, rows
                    root, rows = here, []
                rows.append((conv[i], list(zip(k1s[i], k2s[i], strict=True)), chars[i], last[i]))
        if rows:
            yield root, rows

    def walk(batches):
        out = []
        size = 0
        for held in shards(batches):
            for row in descend(held):
                out.append(row)
                size += 4 + row[6]
                if size > 100_000:
                    yield batch(out)
                    out, size = [], 0
        if out:
            yield batch(out)

    return cut.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(walk, PARTS)


def end_lists(parts: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of nodes where conversations end: ids in ascending order stream through the hash, none is gathered."""
    rows = parts.select("k1", "k2", F.explode("ends").alias("conv_id"))

    def digests(batches):
        node, sha = None, None
        for b in batches:
            out = []
            for k1, k2, conv in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "conv_id")), strict=True):
                if (k1, k2) != node:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (k1, k2), hashlib.sha256(str(conv).encode())
                else:
                    sha.update(b",%d" % conv)
            yield digest_batch(out)
        if node:
            yield digest_batch([(*node, sha.hexdigest())])

    def digest_batch(out):
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["k1", "k2", "ends_sha256"])

    return rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(digests, "k1 long, k2 long, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos, t1, t2, chars); ``convs`` names also those without turns.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)
    """
    parts = materialize(shard_nodes(bands(convs, turns)), "trie-parts")
    node = ["k1", "k2"]
    merged = parts.groupBy(*node).agg(*[F.first(c).alias(c) for c in ("p1", "p2", "depth", "chars")], F.min("least").alias("least"), F.sum("n").alias("n"))
    merged = materialize(merged, "trie-nodes")
    children = merged.where("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    saved = (F.col("n") - 1) * F.col("chars")
    nodes = merged.join(children, node, "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "saved": saved})

    # what lies above a node on its owner's path, and what each conversation owns as a whole
    nodes = materialize(running(nodes, ["least"], ["depth"], {"above": (SUM, F.col("saved"))}, before=True), "trie-owned")
    owned = nodes.groupBy(F.col("least").alias("member")).agg(F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    shared = nodes.where("n > 1").select(*node)
    below = parts.join(shared, node, "left_semi").select(*node, F.explode("members").alias("member")).join(owned, "member")
    below = below.groupBy(*node).agg(F.sum("saved").alias("below"), F.sum("leaves").alias("leaves"))

    parents = merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("least").alias("parent_conv_id"))
    out = nodes.join(below, node, "left").join(end_lists(parts), node, "left").join(parents, ["p1", "p2"], "left")
    alone = F.col("n") == 1  # a path of one conversation saves nothing and has one leaf
    return out.select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.when(alone, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        F.when(alone, 0).otherwise(F.col("below") - F.col("above")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"))
