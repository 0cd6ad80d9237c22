"""Text expressions: markup removal, noise lines, chunks, quality measures. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities, unit words, header tags, heading words, letter class.
HTML_ENTITIES = (("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                 ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
INLINE_ENTITIES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
LETTERS = "가-힣"
NUMBER_LINE = r"^[\d\s,\.~\-\(\)·]*(만|MWh|%|명|연도|저점|기준선|백만|억|천)?[\d\s,\.~\-\(\)·]*$"
TABLE_LINE = r"^[가-힣]{2,5}[구군],\s*[\d,\s\.]+$"
HEADER_TAG = r"^\[(서술 텍스트|표 요약|차트 인사이트)\]$"
HEADINGS = (r"^(Executive Summary|분석 개요|분석 목적|분석 범위|방법론|군집 분석|상관관계|클러스터|결론|시사점|데이터 출처|변수|요약|"
            r"핵심 인사이트|분석 결과|정책 제언)")
KEYWORD_PATTERNS = (r"[가-힣]{2,}구", r"\d+[.\d]*%", r"[가-힣]{2,}용", r"군집\s*\d+", r"[가-힣]{3,}(?=\s|$)")

_SPACE = r"[\s\p{Z}]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Trim every kind of white space from both ends."""
    return F.regexp_replace(_c(col), rf"^{_SPACE}+|{_SPACE}+$", "")


def html_to_text(html: Column | str, drop: Sequence[str] = ("script", "style", "head"), max_chars: int | None = None) -> Column:
    """Visible text of a page: dropped elements, comments and tags removed, spaces collapsed."""
    t = F.regexp_replace(_c(html), r"(?s)<!--.*?-->", " ")
    for tag in drop:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    t = F.replace(t, F.lit("&cr;"), F.lit(" "))
    for name, char in HTML_ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    t = strip(F.regexp_replace(t, rf"{_SPACE}+", " "))
    return t if max_chars is None else F.substring(t, 1, max_chars)


def strip_inline_tags(text: Column | str) -> Column:
    """Tags removed without leaving a gap, four entities decoded."""
    t = F.regexp_replace(_c(text), r"<[^>]+>", "")
    for name, char in INLINE_ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    return strip(t)


def count_letters(text: Column, letters: str = LETTERS) -> Column:
    return F.length(F.regexp_replace(text, f"[^{letters}]", ""))


def remove_noise(text: Column | str, letters: str = LETTERS, number_line: str = NUMBER_LINE, table_line: str = TABLE_LINE,
                 header_tag: str = HEADER_TAG) -> Column:
    """Drop header tags, number and table rows and lines with hardly any letters; blank lines stay."""

    def keep(line: Column) -> Column:
        s = strip(line)
        n, size = count_letters(s, letters), F.length(s)
        noise = (
            s.rlike(header_tag) | (n == 0) | ((n < 3) & (size <= 10)) | s.rlike(number_line) | s.rlike(table_line)
            | ((size <= 30) & (n / size < 0.20))
        )
        return (s == "") | ~noise

    lines = F.filter(F.split(_c(text), "\n", -1), keep)
    blanked = F.transform(lines, lambda l: F.when(strip(l) == "", "").otherwise(l))
    return strip(F.array_join(blanked, "\n"))


def fixed_chunks(text: Column | str, size: int = 800, overlap: int = 100, drop_tail: bool = False) -> Column:
    """Array of overlapping pieces; ``drop_tail`` leaves out a last piece that is only overlap."""
    t, step = _c(text), size - overlap
    last = F.length(t) - 1 - (overlap if drop_tail else 0)
    starts = F.when(F.length(t) > 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step)))
    return F.transform(starts, lambda i: F.substring(t, i + 1, F.lit(size)))


def packed_chunks(text: Column | str, size: int = 1200, overlap: int = 200, min_last: int = 0, separator: str = r"\n{2,}") -> Column:
    """Paragraphs packed up to ``size`` characters, each chunk opening with the tail of the one before."""
    paragraphs = F.filter(F.transform(F.split(_c(text), separator, -1), strip), lambda p: p != "")
    empty = F.struct(F.lit("").alias("cur"), F.array().cast("array<string>").alias("done"))

    def add(acc: Column, p: Column) -> Column:
        cur, done = acc["cur"], acc["done"]
        full = (cur != "") & (F.length(cur) + F.length(p) + 2 > size)
        tail = F.when(F.length(cur) > overlap, F.concat(F.right(cur, F.lit(overlap)), F.lit("\n\n"), p)).otherwise(p)
        grown = F.when(cur == "", p).otherwise(strip(F.concat(cur, F.lit("\n\n"), p)))
        return F.struct(
            F.when(full, tail).otherwise(grown).alias("cur"),
            F.when(full, F.concat(done, F.array(strip(cur)))).otherwise(done).alias("done"),
        )

    def close(acc: Column) -> Column:
        rest = strip(acc["cur"])
        return F.when(F.length(rest) > min_last, F.concat(acc["done"], F.array(rest))).otherwise(acc["done"])

    return F.aggregate(paragraphs, empty, add, close)


def chunk_title(chunk: Column, page: Column) -> Column:
    """First line cut to 60 characters, or the page number."""
    first = strip(F.substring(F.element_at(F.split(chunk, "\n", -1), 1), 1, 60))
    return F.when(first == "", F.concat(F.lit("페이지 "), page.cast("string"))).otherwise(first)


def heading(text: Column | str, pattern: str = HEADINGS) -> Column:
    """First line where it is a section heading, otherwise null."""
    first = strip(F.element_at(F.split(_c(text), "\n", -1), 1))
    return F.when(first.rlike(pattern), first)


def slug(path: Column | str) -> Column:
    """Document id of a file path: stem, separators to underscores, other signs removed."""
    name = F.regexp_replace(_c(path), r"^.*/", "")
    stem = F.regexp_replace(name, r"(.)\.[^.]*$", "$1")
    return F.lower(F.regexp_replace(F.regexp_replace(stem, r"[\s\-]+", "_"), r"[^\p{L}\p{N}_]", ""))


def is_valid_chunk(chunk_id: Column, text: Column, min_chars: int = 50) -> Column:
    """Chunks with a real id and enough text."""
    return chunk_id.isNotNull() & (chunk_id != "") & (chunk_id != "nan") & (F.length(text) >= min_chars)


def enriched_text(title: Column, text: Column, keywords: Column | None = None) -> Column:
    """Title, body and keywords in one text, as the embedding input."""
    out = F.concat(F.lit("제목: "), title, F.lit("\n내용: "), text)
    if keywords is None:
        return out
    return F.concat(out, F.lit("\n키워드: "), F.array_join(keywords, ", "))


def quality_measures(text: Column | str, letters: str = LETTERS, number_line: str = NUMBER_LINE) -> Column:
    """struct(letter_ratio, digit_ratio, length, noise_line_ratio, avg_line_len, score) of a chunk."""
    t = F.coalesce(_c(text), F.lit(""))
    size = F.greatest(F.length(t), F.lit(1))
    lines = F.filter(F.transform(F.split(t, "\n", -1), strip), lambda s: s != "")
    bad = F.filter(lines, lambda s: s.rlike(number_line) | ((F.length(s) <= 10) & ~s.rlike(f"[{letters}]")))
    n_lines = F.greatest(F.size(lines), F.lit(1))
    letter = count_letters(t, letters) / size
    digit = F.length(F.regexp_replace(t, r"[^\p{Nd}]", "")) / size
    noise = F.size(bad) / n_lines
    mean_len = F.aggregate(lines, F.lit(0), lambda a, s: a + F.length(s)) / n_lines
    score = letter * 0.4 + (1 - noise) * 0.3 + F.least(F.length(t) / 1200.0, F.lit(1.0)) * 0.3
    return F.struct(
        letter.alias("letter_ratio"), digit.alias("digit_ratio"), F.length(t).cast("bigint").alias("length"),
        noise.alias("noise_line_ratio"), mean_len.alias("avg_line_len"), score.alias("score"),
    )


def keyword_set(text: Column | str, patterns: Sequence[str] = KEYWORD_PATTERNS) -> Column:
    """Distinct matches of several patterns."""
    found = [F.regexp_extract_all(_c(text), F.lit(p), F.lit(0)) for p in patterns]
    return F.array_distinct(F.flatten(F.array(*found)))


def keyword_recall(truth: Column, context: Column) -> Column:
    """Share of the expected keywords that occur in the context."""
    return F.size(F.array_intersect(truth, context)) / F.greatest(F.size(truth), F.lit(1))


def tokens(text: Column | str) -> Column:
    """Words split on white space, exactly as Python's ``str.split`` does."""
    gap = r"[\s\p{Z}\x1c-\x1f\x85]+"
    t = F.regexp_replace(_c(text), f"^{gap}|{gap}$", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, gap))
