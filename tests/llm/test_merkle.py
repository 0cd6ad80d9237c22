import hashlib
import re

from pyspark.sql import functions as F

from sparkdesk.llm import merkle, queries

LEAF = re.compile(r"\s*(?:\S*[^\s.!?]\s+){0,7}\S+\s*|\s+")


def digest(text, n):
    return hashlib.sha256(text.encode()).hexdigest()[:n]


def printed(text):
    sections = []
    for section in re.split(r"(?<=\n\n)(?=[^\n])", text or ""):
        lines = []
        for paragraph in re.split(r"(?<=\n)", section) if section else [""]:
            leaves = ".".join(digest(x, merkle.LEAF_DIGITS) for x in LEAF.findall(paragraph))
            lines.append(f"{digest(leaves, merkle.NODE_DIGITS)}.{leaves}")
        joined = ",".join(lines)
        sections.append(f"{digest(joined, merkle.NODE_DIGITS)}:{joined}")
    whole = "/".join(sections)
    return f"{digest(whole, 64)}/{whole}"


def leaves(print_):
    return {x for x in re.split(r"[./:,]", print_) if len(x) == merkle.LEAF_DIGITS}


def test_leaves_keep_every_character(texts):
    for t in texts.values():
        assert "".join("".join(LEAF.findall(p)) for p in re.split(r"(?<=\n)", t)) == t


def test_query_on_given_documents(spark, sf_dir, texts):
    ids = sorted(texts)
    got = {r["doc_id"]: r for r in queries.op2_merkle(spark, sf_dir).collect()}
    assert sorted(got) == ids
    for n, i in enumerate(ids):
        text, after = texts[i], texts[ids[(n + 1) % len(ids)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        row = got[i]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == printed(text) and row["edited_fingerprint"] == printed(edited)
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = leaves(printed(text)), leaves(printed(other))
            assert abs(row[name] - (2 * len(a & b) / (len(a) + len(b)) if a or b else 1)) < 1e-12
    assert sum(r["near_edited"] > r["near_next"] for r in got.values()) > 0.9 * len(got)


def test_edge_rows(frame):
    long = "word " * 60_000
    df = frame(["a b. c", None, "", "x" * 50_000, long, "a b. c", "\n\n \n", "é🙂 z\n\nq"], [(None, "null id", None, None, None), (0, "a b. c", None, None, None)])
    rows = merkle.with_edited(df).select("*", merkle.fingerprint(F.col("text")).alias("p")).collect()
    assert len(rows) == 10 and all(r["p"] == printed(r["text"]) for r in rows)
    edited = {r["doc_id"]: r["edited"] for r in rows}
    order = sorted({(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows})
    by_id = {(r["doc_id"] is not None, r["doc_id"] or 0): r["text"] for r in rows}
    for n, i in enumerate(order):
        text, after = by_id[i], by_id[order[(n + 1) % len(order)]]
        assert edited[i[1] if i[0] else None] == text[: len(text) - len(text) // 4] + after[: len(text) // 4]
    one = merkle.with_edited(frame(["abcdefgh"])).first()
    assert one["edited"] == "abcdefab" and merkle.with_edited(frame([])).collect() == []


def test_branches_locate_edits(frame):
    a, b = "one two.\nthree four.\n\nfive six.\nseven.", "one two.\nthree 4.\n\nfive six.\nseven."
    df = frame([a]).select(merkle.fingerprint(F.lit(a)).alias("a"), merkle.fingerprint(F.lit(b)).alias("b"))
    row = df.select(merkle.root(F.col("a")) == merkle.root(F.col("b")), merkle.differing_paragraphs(F.col("a"), F.col("b"))).first()
    assert list(row) == [False, ["0.1"]]
