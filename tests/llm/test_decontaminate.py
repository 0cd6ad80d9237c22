import random

import numpy as np

from sparkdesk.llm.decontaminate import contaminated, nearest, pieces, plain, without_contaminated


def table_distance(pattern, text):
    """Least edits between the pattern and any stretch of the text, by the full table."""
    row = np.zeros(len(text) + 1, int)
    chars = np.array(list(text))
    for i, c in enumerate(pattern, 1):
        change = np.concatenate(([i], np.minimum(row[:-1] + (chars != c), row[1:] + 1)))
        row = np.minimum.accumulate(change - np.arange(len(change))) + np.arange(len(change))
    return int(row.min())


def test_distance_against_the_table():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 60)))
        pattern = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 80)))
        best, end = nearest(pattern, text)
        assert best == min(len(pattern), table_distance(pattern, text)) and 0 <= end <= len(text)


def test_pieces_cover_the_item():
    for n in (1, 5, 41, 233):
        got = pieces("x" * n, min(7, n - 1))
        assert "".join(p for _, p in got) == "x" * n and len(got) == min(7, n - 1) + 1


def test_given_documents_by_full_tables(spark, sf_dir, docs, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    some = [i for i in sorted(texts) if len(texts[i]) < 3000][:40] + [d for d, _ in got]
    for d in some:
        for i in list(items)[:12] + [i for dd, i in got if dd == d]:
            item, text = plain(items[i]), plain(texts[d])
            assert (table_distance(item, text) <= int(len(item) * 0.05)) == ((d, i) in got), (d, i)


def test_edited_passages(spark, frame):
    rng = random.Random(2)
    item = "".join(rng.choice("abcdefghij ") for _ in range(200))
    fill = "".join(rng.choice("klmnop ") for _ in range(500))
    texts = []
    for edits in (0, 3, 10, 11, 25):
        chars = list(item)
        for at in sorted(rng.sample(range(10, 190), edits), reverse=True):
            kind = rng.randrange(3)
            if kind == 0:
                chars[at] = "z"
            elif kind == 1:
                del chars[at]
            else:
                chars.insert(at, "z")
        texts.append(fill + "".join(chars).upper().replace(" ", "\n") + fill)
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, item)], "item_id long, text string")
    got = contaminated(frame([*texts, None, "", item[:150]]), bench).collect()
    want = {(d, i) for d in range(len(texts)) for i in (1, 5) if table_distance(plain(item), plain(texts[d])) <= 10}
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want) and (4, 1) not in want
    exact = next(r for r in got if (r["doc_id"], r["item_id"]) == (0, 1))
    assert (exact["begin"], exact["end"], exact["edits"]) == (500, 700, 0)
    many = contaminated(frame(texts), bench, block_chars=150).collect()  # more blocks, same matches
    assert {tuple(r) for r in many} == {tuple(r) for r in got}
    kept = without_contaminated(frame([*texts, None], [(None, texts[0], None, None, None)]), bench)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([str(d) for d in range(len(texts)) if (d, 1) not in want] + [str(len(texts)), "None"])
    assert contaminated(frame([]), bench).collect() == [] and contaminated(frame(texts), bench.limit(0)).collect() == []


def test_copies_that_follow_at_once(spark, frame):
    """Each of several copies is found, whatever little stands between them and with letters left out of the later one."""
    rng = random.Random(4)
    item = "".join(rng.choice("abcdefghij") for _ in range(200))
    less = item[:5] + item[7:]
    texts = [item + gap + item for gap in ("", " ", " " * 9, " " * 40)] + [item + less + item, item + item[:150]]
    got = contaminated(frame(texts), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    rows = sorted((r["doc_id"], r["begin"], r["end"], r["edits"]) for r in got)
    assert rows == [
        *((d, *x, 0) for d, gap in enumerate((0, 1, 9, 40)) for x in ((0, 200), (200 + gap, 400 + gap))),
        (4, 0, 200, 0), (4, 200, 398, 2), (4, 398, 598, 0), (5, 0, 200, 0)]
