import random
import re

from sparkdesk.llm import sentence_spans as S


def words(s):
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", s.translate({c: c + 32 for c in range(65, 91)})))


def brute(texts, width=S.WIDTH, least=S.LEAST_WORDS):
    """{id: removed sentence numbers}, from all runs in order of id and place."""
    seen, gone = set(), {}
    split = {i: S.sentences(t) if t else [] for i, t in texts.items()}
    for i in sorted(texts):
        runs = split[i]
        k = min(width, len(runs))
        for p in range(len(runs) - k + 1 if k else 0):
            run = tuple(map(words, runs[p : p + k]))
            if sum(map(len, run)) < least:
                continue
            if run in seen:
                gone.setdefault(i, set()).update(range(p, p + k))
            seen.add(run)
    return {i: sorted(x) for i, x in gone.items()}


def test_sentences_are_the_text(texts):
    for t in [*texts.values(), "a " * 500, " .. \n x", "no end " * 30 + "!"]:
        assert "".join(S.sentences(t)) == t


def test_given_documents(docs, texts):
    got = {r["doc_id"]: r for r in S.without_repeats(docs).collect()}
    want = brute(texts)
    assert {i: list(r["removed"]) for i, r in got.items() if r["removed"]} == want and want
    for i, r in got.items():
        lost = set(want.get(i, ()))
        assert r["kept"] == "".join(s for n, s in enumerate(S.sentences(texts[i])) if n not in lost)


def test_edge_rows(frame):
    passage = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen."
    texts = ["start here. " + passage, "other begin! " + passage.upper() + " end now.", None, "", passage, "w " * 40_000]
    df = frame(texts, [(None, "null id. " + passage, None, None, None), (7, "same same. " + passage, None, None, None), (7, "same same. " + passage, None, None, None)]).selectExpr("*", "1 as row", "2 as kept", "3 as place")
    got = S.without_repeats(df).collect()
    assert len(got) == 9 and [r["kept"] for r in got if r["doc_id"] is None] == ["null id. " + passage]
    by = {r["doc_id"]: r for r in got}
    assert by[2]["kept"] is None and by[3]["kept"] == "" and by[4]["kept"] == "" and by[0]["kept"] == "start here. " and by[1]["kept"] == "other begin! end now."
    assert sorted(r["kept"] for r in got if r["doc_id"] == 7) == ["", "same same. "]
    assert by[1]["first_docs"] == [] and by[4]["first_docs"] == []  # the first occurrence is the row of the null id
    assert S.without_repeats(frame([])).collect() == []


def untouched(texts, got):
    """(shared, whole): 50-word windows that stand in an earlier text too, and how many of them lose no word."""
    seen, shared, whole = set(), 0, 0
    for i in sorted(texts):
        lost = [(w, n in got[i]) for n, s in enumerate(S.sentences(texts[i] or "")) for w in words(s)]
        mine = [(tuple(w for w, _ in lost[p : p + 50]), any(x for _, x in lost[p : p + 50])) for p in range(len(lost) - 49)]
        shared += sum(w in seen for w, _ in mine)
        whole += sum(w in seen and not x for w, x in mine)
        seen.update(w for w, _ in mine)
    return shared, whole


def test_every_shared_passage_loses_a_sentence(docs, texts, frame):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    many = lambda n: [word() for _ in range(n)]
    p, q, r, u = many(50), many(71), many(60), many(54)
    lines = ["\n".join(" ".join(r[i : i + k]) for i in range(0, 60, k)) for k in (1, 2, 3)]
    short = " ".join(u[:27]) + ". " + " ".join(u[27:])
    made = [" ".join(p), " ".join([*many(7), *p, *many(30)]), " ".join(q), " ".join([*many(11), *q]), *lines, "\t".join([*many(5), *r, *many(40)]), short, " ".join(many(9)) + " " + short + " " + " ".join(many(9)) + ". One. Two."]
    for df, held in ((frame(made), dict(enumerate(made))), (docs, texts)):
        rows = S.without_repeats(df, passage_words=50).collect()
        got = {x["doc_id"]: set(x["removed"]) for x in rows}
        shared, whole = untouched(held, got)
        assert shared and not whole
        assert all(x["kept"] == ("".join(s for n, s in enumerate(S.sentences(held[x["doc_id"]])) if n not in got[x["doc_id"]]) if held[x["doc_id"]] is not None else None) for x in rows)
    fresh = [" ".join(many(200)) for _ in range(5)]
    assert not any(x["removed"] for x in S.without_repeats(frame(fresh), passage_words=50).collect())
