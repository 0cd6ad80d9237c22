import random
import re

from sparkdesk.llm import suffixes as S


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))


def test_given_documents(docs, texts):
    """Each result is a maximal equal stretch, and every 50-word run that two texts share lies in results of both."""
    rows = S.repeated_passages(docs).collect()
    split = {i: words(t) for i, t in texts.items()}
    covered = {i: [] for i in texts}
    for r in rows:
        a, b, i, j, n = split[r["doc_id"]], split[r["other_id"]], r["begin"], r["other_begin"], r["words"]
        assert n >= 50 and a[i : i + n] == b[j : j + n] and (r["other_id"], j) < (r["doc_id"], i)
        assert (i + n == len(a) or j + n == len(b) or a[i + n] != b[j + n]) and (i == 0 or j == 0 or a[i - 1] != b[j - 1])
        covered[r["doc_id"]].append((i, i + n))
        covered[r["other_id"]].append((j, j + n))
    where = {}
    for d, w in split.items():
        for p in range(len(w) - 49):
            where.setdefault(tuple(w[p : p + 50]), []).append((d, p))
    shared = [x for places in where.values() if len(places) > 1 for x in places]
    found = sum(any(a <= p and p + 50 <= b for a, b in covered[d]) for d, p in shared)
    assert shared and found == len(shared)


def test_passages_in_many_texts(frame):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(5))
    passage = [word() for _ in range(52)]
    texts = [" ".join([*(word() for _ in range(rng.randrange(0, 90))), *passage, *(word() for _ in range(rng.randrange(0, 90)))]) for _ in range(40)]
    clean = [" ".join(word() for _ in range(120)) for _ in range(10)]
    rows = S.repeated_passages(frame([*texts, *clean, None, "", "short one"], [(None, texts[0], None, None, None), (3, texts[3], None, None, None)])).collect()
    assert {r["doc_id"] for r in rows} | {r["other_id"] for r in rows} == set(range(40)) and all(52 <= r["words"] < 60 for r in rows)
    assert S.repeated_passages(frame([])).collect() == []


def test_pairs_among_texts_that_share_the_middle_of_the_passage(frame):
    """40 pairs share 50 words each, of which the middle 30 stand in 300 further texts too."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(5))
    many = lambda n: [word() for _ in range(n)]
    plain = many(30)
    texts = [" ".join([*many(rng.randrange(40)), *plain, *many(30)]) for _ in range(300)]
    for _ in range(40):
        ahead, after = many(10), many(10)
        texts += [" ".join([*many(rng.randrange(40)), *ahead, *plain, *after, *many(20)]) for _ in range(2)]
    rows = S.repeated_passages(frame(texts)).collect()
    assert {(r["other_id"], r["doc_id"]) for r in rows if r["words"] >= 50} == {(300 + 2 * i, 301 + 2 * i) for i in range(40)}


def test_long_text_and_clashing_columns(frame):
    rng = random.Random(9)
    text = " ".join("".join(rng.choice("abcdefghijk") for _ in range(4)) for _ in range(30_000))
    df = frame([text, "x " + text, "y y y"]).selectExpr("*", "1 as key", "2 as next", "3 as place", "4 as a", "5 as shift", "6 as words")
    rows = S.repeated_passages(df).collect()
    assert [(r["doc_id"], r["other_id"], r["begin"], r["words"]) for r in rows if r["words"] == 30_000] == [(1, 0, 1, 30_000)]
