import zlib
from collections import Counter

import numpy as np

from sparkdesk.llm import queries
from sparkdesk.llm.sharding import fisher_yates, shuffled, write_shards


def test_law_of_rows(spark, sf_dir, texts):
    got = queries.op3_shards(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    for r in got:
        data = texts[r["doc_id"]].encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data) and r["law"] == "rows" and r["grown_shard"] is None


def test_order_is_seeded_and_random(docs):
    place = lambda seed, parts: {r["doc_id"]: (r["shard"], r["slot"]) for r in shuffled(docs.repartition(parts), 4, seed, 1 << 16).collect()}
    one = place(1, 3)
    assert one == place(1, 5) and one != place(2, 3)  # whatever the input's partitions
    order = [i for i, _ in sorted(one.items(), key=lambda x: x[1])]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.25


def test_swaps_are_uniform():
    rng = np.random.default_rng(0)
    counts = Counter(tuple(fisher_yates(3, rng).tolist()) for _ in range(6000))
    assert len(counts) == 6 and min(counts.values()) > 850
    assert fisher_yates(0, rng).tolist() == [] and fisher_yates(1, rng).tolist() == [0]


def test_edge_rows(spark, frame, tmp_path, monkeypatch):
    same = [(5, "copy", "en", "s", 4)] * 300
    df = frame([None, "", "x" * 100_000], [(None, None, None, None, None), *same]).selectExpr("*", "7 as shard", "8 as _bucket", "9 as _content")
    monkeypatch.setattr("sparkdesk.llm.sharding.HOT_COPIES", 100)
    got = shuffled(df, 5, bucket_bytes=4096).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 304 and max(counts.values()) - min(counts.values()) <= 1 and {r["_bucket"] for r in got} == {8}
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in counts.items())
    assert shuffled(frame([])).collect() == []
    assert sorted(r["shard"] for r in shuffled(frame(["a", "b"]), 24).collect()) == [0, 1]
    write_shards(frame(["a", "b", "c"]), str(tmp_path / "out"), 2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_hot_copies_keep_their_buckets_when_the_input_is_dealt_anew(frame, monkeypatch):
    monkeypatch.setattr("sparkdesk.llm.sharding.HOT_COPIES", 50)
    df = frame([f"text {i}" for i in range(300)], [(5000, "copy", "en", "s", 4)] * 1200).repartition(8)  # places change with every run
    got = shuffled(df, 24, bucket_bytes=2048).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == 1500 and set(counts) == set(range(24)) and set(counts.values()) <= {62, 63}
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in counts.items())


def test_copies_of_a_long_text_are_dealt_by_bytes(frame):
    got = shuffled(frame([], [(1, "x" * 5000, "en", "s", 5000)] * 40 + [(2, "short", "en", "s", 5)]), 3, bucket_bytes=1 << 15)
    assert got.count() == 41 and max(got.groupBy("shard").count().toPandas()["count"]) == 14
