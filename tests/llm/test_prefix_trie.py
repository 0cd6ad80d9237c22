import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from oracle import compare, duck

from sparkdesk.llm import prefix_trie, queries

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows, group=100, most=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(c - c % group, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = {}
    for p in members:
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(x != q and x[: len(q)] == q for x in members)]
        ends = ",".join(map(str, sorted(c for c in members[p] if len(built[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * (len(q[-1][1]) if q else 0) for q in below)
        out[min(members[p]), len(p)] = (min(members[p[:-1]]) if p else None, len(members[p]), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def found(df, group=100, most=6):
    turns = prefix_trie.positioned(df)
    rows = prefix_trie.trie(*prefix_trie.with_shared_openings(turns, group, most)).collect()
    got = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in rows}
    assert len(got) == len(rows)
    return got


def conversations(seed):
    """Few distinct texts, so that prefixes, whole copies and forks abound; one long conversation and its copies."""
    rng = random.Random(seed)
    rows = []
    for c in range(90):
        for turn in range(rng.choice([1, 2, 3, 9])):
            rows.append((c * 7, turn, rng.choice(["user", None]), rng.choice(["a", "bb", "", None, "é✓"])))
    for c in (1000, 1001, 1005, 1102):
        rows += [(c, turn, "user", f"t{turn % 5}") for turn in range(40 if c != 1005 else 33)]
    return rows


@pytest.mark.parametrize("band, shard", [(32, 4096), (4, 5)])
def test_equals_brute_force(spark, monkeypatch, band, shard):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    rows = conversations(band)
    df = spark.createDataFrame(rows, TURNS).repartition(4).selectExpr("*", "1 as pos", "'x' as t1", "2 as least")
    assert found(df) == brute(rows)


def test_shard_descends_by_bitsets():
    shard = prefix_trie.Shard((0, 0), 0, [4, 7, 9], [[(1, 1), (2, 6)], [(1, 1)], [(3, 3)]], [[5, 6], [5], [8]], [True] * 3)
    assert shard.postings[0] == {(1, 1): 0b011, (3, 3): 0b100} and shard.ended == [0, 0b110, 0b001]
    got = {r[:2]: r[2:] for r in shard.nodes()}
    assert got == {
        (0, 0): (None, None, 0, 4, 3, 0, [4, 7, 9], []), (1, 1): (0, 0, 1, 4, 2, 5, [4, 7], [7]),
        (3, 3): (0, 0, 1, 9, 1, 8, [9], [9]), (1 ^ 2, 1 ^ 6): (1, 1, 2, 4, 1, 6, [4], [4])}


def test_edge_rows(spark):
    long = "z" * 300_000
    rows = [(None, 1, "user", "lost"), (5, None, None, None), (5, 2, "user", long), (5, 2, "user", long), (6, 2, "b", "x"), (6, 2, "a", "y"), (-250, 1, "user", "n"), (103, 0, "u", "gone")]
    assert found(spark.createDataFrame(rows, TURNS)) == brute(rows)
    assert found(spark.createDataFrame([], TURNS)) == {}
    assert found(spark.createDataFrame([(None, 1, "u", "t")], TURNS)) == {}


def test_query_equals_sql(spark, sf_dir):
    ok, note = compare(queries.op11_prefix_trie(spark, sf_dir), duck(sf_dir), queries.ORACLES["op11_prefix_trie"])
    assert ok, note
