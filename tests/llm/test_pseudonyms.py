import re
from datetime import date

from sparkdesk.llm.pseudonyms import PATTERN, pseudonymised


def luhn(value):
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def shape(value):
    return re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", value)))


def valid(value):
    """Whether a found value is to be replaced."""
    if "@" in value or value[0] == "+" or re.fullmatch(r"[0-9a-fA-F]{32,128}", value) or value.count(".") == 3:
        return True
    if re.fullmatch(r"\d{4}-\d\d-\d\d", value):
        try:
            date.fromisoformat(value)
            return True
        except ValueError:
            return False
    return luhn(value)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    done = pseudonymised(docs, "key")
    got = done.collect()
    back = {r["doc_id"]: r["text"] for r in pseudonymised(done, "key", back=True).select("doc_id", "text").collect()}
    pairs, changed = {}, 0
    new = {r["doc_id"]: r for r in got}
    for old in docs.collect():
        row, text = new[old["doc_id"]], old["text"]
        want = [v for v in re.findall(PATTERN, text, re.ASCII) if valid(v)]
        assert [v for v in want if v in row["found"]] == row["found"] and len(want) - len(row["found"]) <= 1
        assert back[old["doc_id"]] == text and row["replaced"] == len(row["found"])
        if not want:
            assert row["text"] == text
        changed += bool(row["found"])
        for a, b in zip(row["found"], row["pseudonyms"], strict=True):
            assert pairs.setdefault(a, b) == b and a not in row["text"]
            assert a.count(".") == 3 and "@" not in a or re.fullmatch(r"[0-9a-fA-F]{32,}", a) or shape(a) == shape(b)
            assert luhn(b) if shape(a) == "9" * 16 else True
    assert changed > 50 and len(set(pairs.values())) == len(pairs)


def test_formats(spark):
    text = ('+1 (743) 555-3824; a.b.34@mail7.example.com; 227.5.221.1; 4111 1111 1111 1111; 4785380592391141; 2024-02-29; 2023-02-30; '
            '"24BE64439E3E49CF46B2D7C90F3602A3D0B907FF"; 300.1.1.1; version 1.2.3; 12345')
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "x" * 200_000 + " 10.0.0.1"), (1, text)], "doc_id int, text string").selectExpr("*", "1 as found", "2 as _x")
    rows = pseudonymised(df, "k").collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 5 and by[1]["replaced"] == 6 and by[2]["text"] is None and by[3]["text"] == "" and by[4]["replaced"] == 1
    new = dict(zip(by[1]["found"], by[1]["pseudonyms"], strict=True))
    date.fromisoformat(new["2024-02-29"])
    assert luhn(new["4111 1111 1111 1111"]) and new["4111 1111 1111 1111"][4] == " " and all(0 <= int(x) < 256 for x in new["227.5.221.1"].split("."))
    assert by[1]["text"].endswith("300.1.1.1; version 1.2.3; 12345") and "4785380592391141" in by[1]["text"] and "2023-02-30" in by[1]["text"]
    assert pseudonymised(df, "other").first()["pseudonyms"] != by[1]["pseudonyms"] and pseudonymised(df.limit(0), "k").collect() == []
