"""Text jobs against plain Python written from their description."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sparkdesk.functions import questions as Qn
from sparkdesk.functions import text as X
from sparkdesk.operators import corpus as K
from sparkdesk.operators import datasets as D


def texts(seed, n=40):
    rng = random.Random(seed)
    words = ["강남구", "에너지", "a", "12,345", "표", "소비", "45.2%", "분석 개요", "x" * 30, "가나다라마바사"]
    out = []
    for _ in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 12))]
        out.append(rng.choice(["\n", "\n\n", "\n\n\n"]).join(lines))
    return out


@pytest.mark.parametrize("size,overlap", [(1200, 200), (90, 20), (60, 50)])
def test_packed_chunks_bounds_and_overlap(spark, size, overlap):
    """Every paragraph lies in a chunk, a chunk opens with the tail of the one before, and only one paragraph may exceed the size."""
    src = texts(size)
    df = spark.createDataFrame(list(enumerate(src)), "i int, t string")
    for r in df.select("i", X.packed_chunks("t", size, overlap).alias("c")).collect():
        paragraphs = [p.strip() for p in re.split("\n\n+", src[r.i]) if p.strip()]
        longest = max(map(len, paragraphs), default=0)
        assert all(any(p in c for c in r.c) for p in paragraphs)
        assert all(len(c) <= max(size, longest + overlap + 2) for c in r.c)
        for before, after in zip(r.c, r.c[1:]):
            assert len(before) <= overlap or after.startswith(before[-overlap:].lstrip())


def test_packed_chunks_keep_a_short_tail_unless_told(spark):
    df = spark.createDataFrame([("a" * 50 + "\n\n" + "b" * 8,)], "t string")
    row = df.select(X.packed_chunks("t", 52, 0).alias("all"), X.packed_chunks("t", 52, 0, min_last=50).alias("long")).first()
    assert row["all"][-1].endswith("b" * 8) and len(row["long"]) == len(row["all"]) - 1


def test_remove_noise_line_by_line(spark):
    """One case for each kind of line; the lines around it show that it alone goes."""
    kept = ["강남구 에너지 소비가 크게 늘었다", "강남구는 높다"]
    dropped = ["", "a b c", "12,345", "45.2%", "표 1", "[표 요약]", "x" * 40]
    for line in dropped:
        got = spark.range(1).select(X.remove_noise(F.lit(f"{kept[0]}\n{line}\n{kept[1]}")).alias("c")).first().c
        assert [x for x in got.split("\n") if x] == kept, line
    assert spark.range(1).select(X.remove_noise(F.lit("\n".join(kept))).alias("c")).first().c == "\n".join(kept)


def test_fixed_chunks_cover_the_text(spark):
    src = ["", "a" * 5, "b" * 800, "c" * 801, "d" * 2345]
    df = spark.createDataFrame(list(enumerate(src)), "i int, t string")
    got = {r.i: r.c or [] for r in df.select("i", X.fixed_chunks("t").alias("c")).collect()}
    assert got == {i: [t[s:s + 800] for s in range(0, len(t), 700)] for i, t in enumerate(src)}


def test_separator_split_respects_size_and_keeps_words():
    for t in texts(11, 30):
        pieces = K.split_by_separators(t, 80, 10)
        assert all(len(p) <= 80 for p in pieces)
        joined = " ".join(pieces)
        assert all(w in joined for w in t.split())


def test_chunk_table(spark):
    pages = spark.createDataFrame(
        [("d", 1, "분석 개요\n" + "가" * 60), ("d", 2, ""), ("d", 3, "나" * 70), ("d", 4, "결론\n" + "다" * 55), ("e", 1, "라" * 60)],
        "doc_id string, page_num long, text string")
    got = {r.chunk_id: (r.section, r.page_num) for r in K.build_chunks(pages).collect()}
    assert got == {"d_p0001_c01": ("분석 개요", 1), "d_p0003_c01": ("분석 개요", 3), "d_p0004_c01": ("결론", 4), "e_p0001_c01": ("General", 1)}


def test_question_tags(spark):
    rows = ["강남구와 서초구의 2021년 가정용 전력 비교", "군집 3에 속한 곳은?", "서울 전체 전력 현황", "마포구 인구 추이", "가구수 변화"]
    df = spark.createDataFrame([(q,) for q in rows], "q string").withColumn("g", Qn.tag(F.col("q")))
    got = [(list(r.districts), r.year, r.metric, r.cluster_id, r.route) for r in df.select("g.*", Qn.route(F.col("q"), F.col("g")).alias("route")).collect()]
    assert got == [
        (["강남구", "서초구"], 2021, "home_usage", None, "compare"), ([], None, "total_usage", 3, "cluster_list"),
        ([], None, "total_usage", None, "overview"), (["마포구"], None, "total_resident_population", None, "trend"),
        ([], None, "total_households", None, "general")]


def test_report_label_order(spark):
    df = spark.createDataFrame([("신주인수권부사채 발행",), ("합병 결정",), ("기타",)], "report_nm string")
    assert [r.label for r in K.label_reports(df).collect()] == ["유상증자", "합병·분할", None]


def test_every_row_is_encoded_or_reported(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,), (None,)], "label string")
    assert {(r["label"], r["label_id"]) for r in D.encode_labels(df, ["a", "b"]).collect()} == {("a", 0), ("b", 1)}
    assert {(r["label"], r["n"]) for r in D.unknown_labels(df, ["a", "b"]).collect()} == {("z", 1), (None, 2)}


def test_groups_without_lines_get_the_fallback(spark):
    df = spark.createDataFrame([("a", 1, "12\nword one"), ("a", 2, "word two"), ("b", 3, "34"), (None, 4, "word"), ("c", 5, None)], "g string, p int, text string")
    got = {(r["g"], r["context"], r["n_lines"]) for r in K.context_lines(df, "g", "p", "text", "a-z", fallback="none").collect()}
    assert got == {("a", "word one\nword two", 2), ("b", "none", 0), (None, "word", 1), ("c", "none", 0)}
    assert K.context_lines(df, "g", "p", "text", "a-z").count() == 2
