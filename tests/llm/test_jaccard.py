import random
import re

import numpy as np
import pytest

from sparkdesk.llm.jaccard import CountTree, counts_of, lead_size, likeliest, linked, near_duplicates, one_of_each_group, point


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(texts):
    """{id: (set size, component)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect()}


def test_given_documents(docs, texts):
    assert found(docs) == brute(texts)


def test_chains_hubs_and_shared_passages(frame):
    """Chains whose ends don't link, stars of near copies, and texts that only share a passage."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(3):  # each copy changes its predecessor a little
        base = [word() for _ in range(80)]
        for step in range(12):
            texts.append(" ".join(base))
            base = base[:]
            for _ in range(1 + step % 2):
                base[rng.randrange(80)] = word()
    for _ in range(30):
        texts.append(" ".join([*(word() for _ in range(rng.randrange(5, 60))), *passage, *(word() for _ in range(rng.randrange(5, 60)))]))
    hub = [word() for _ in range(60)]
    for _ in range(60):
        mine = hub[:]
        for at in rng.sample(range(60), rng.randrange(0, 4)):
            mine[at] = word()
        texts.append(" ".join(mine))
    texts += ["a b c", "A B  c", "a b", "x", "x x x x x x x x", "x x x x x"]
    assert found(frame(texts)) == brute(dict(enumerate(texts)))


def test_edge_rows(spark, frame):
    extra = [(None, "one two three four five six", None, None, None), (3, "one two three four five six", "de", None, 1), (3, "one two three four five six", "de", None, 1)]
    got = near_duplicates(frame([None, "", " \n\t"], extra)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got) == [
        ("0", 0, 0), ("1", 0, 1), ("2", 0, 2), ("3", 2, 3), ("3", 2, 3), ("None", 2, 3)]
    assert near_duplicates(frame([])).collect() == []
    clash = frame(["a b c d e f", "a b c d e f"]).selectExpr("*", "1 as sid", "2 as n_shingles", "3 as key")
    assert [r["component_id"] for r in near_duplicates(clash).collect()] == [0, 0]
    assert one_of_each_group(clash).columns == clash.columns and one_of_each_group(clash).count() == 1


def test_null_id_before_a_near_copy(spark):
    """A copy without an id, first in its task, takes no block from the rows of the same text that have ids."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (5, text), (2, text + " end"), (9, "other words that stand quite alone here")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got) == [("2", 2), ("5", 2), ("9", 9), ("None", 2)]


def test_long_text(frame):
    long = " ".join(f"w{i % 70001}" for i in range(120_000))
    assert found(frame([long, long + " end", "short"])) == {0: (len(shingles(long)), 0), 1: (len(shingles(long + " end")), 0), 2: (1, 2)}


@pytest.mark.parametrize("seed", range(3))
def test_tree_loses_no_pair(seed):
    """The bound never falls below what two sets share, so every linked pair survives."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, (12, 90), dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(b, rng.integers(60, 90), replace=False), rng.integers(0, 2**63, rng.integers(0, 9), dtype=np.uint64)])) for b in base for _ in range(8)]
    sizes = np.array([len(s) for s in sets])
    got = {tuple(sorted((int(x), int(y)))) for a, b in CountTree(np.stack([counts_of(point(s).tobytes(), 64) for s in sets]), sizes).pairs(75) for x, y in zip(a, b, strict=True)}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if linked(len(np.intersect1d(sets[i], sets[j])), sizes[i], sizes[j], 75)}
    assert want and want <= got and len(got) < len(sets) * (len(sets) - 1) // 4


def test_lead_size_is_the_smallest_safe_one():
    for n in range(1, 200):
        least = next(s for s in range(n + 1) if 100 * s >= 75 * n)  # a partner shares so many members at least
        assert lead_size(n, 75) == n - least + 1


def borderline(rng, copies, edits):
    """Copies of one text with so many edits that only some of them link with each other."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base, texts = [word() for _ in range(150)], []
    for _ in range(copies):
        mine = base[:]
        for at in rng.sample(range(150), edits):
            mine[at] = word()
        texts.append(" ".join(mine))
    return texts


def test_links_of_a_dense_group_grow_with_its_members(frame):
    texts = borderline(random.Random(11), 160, 2)
    rows = near_duplicates(frame(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(dict(enumerate(texts)))
    assert sum(r["n_links"] for r in rows) <= 4 * len(texts)  # one partner a member, not one per block


def test_blocks_with_more_partners_are_searched_again(frame, monkeypatch):
    """With one partner a round the rest comes with later rounds, the last of them unbounded."""
    rng = random.Random(12)
    texts = borderline(rng, 60, 2) + borderline(rng, 60, 3)
    monkeypatch.setattr("sparkdesk.llm.jaccard.PARTNERS", 1)
    monkeypatch.setattr("sparkdesk.llm.jaccard.ROUNDS", 1)
    assert found(frame(texts)) == brute(dict(enumerate(texts)))


def test_likeliest_partners():
    a, b = np.array([0, 0, 0, 1]), np.array([1, 2, 3, 2])
    assert likeliest(a, b, np.array([0.9, 0.5, 0.4, 0.8]), 1).tolist() == [0, 2, 3]
