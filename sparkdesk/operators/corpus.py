"""Corpus jobs over pages, chunks and reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions import text as X
from sparkdesk.functions.rules import first_keyword
from sparkdesk.operators.ordered import carry_forward

# Report title keyword -> label, first in this order wins.
REPORT_LABELS = (
    ("사업보고서", "사업보고서"), ("반기보고서", "사업보고서"), ("분기보고서", "사업보고서"),
    ("감사보고서", "감사보고서"), ("감사인", "감사보고서"), ("내부회계", "감사보고서"),
    ("유상증자", "유상증자"), ("무상증자", "유상증자"), ("주요사항보고서[유상증자]", "유상증자"), ("주요사항보고서[무상증자]", "유상증자"),
    ("투자설명서", "유상증자"), ("신주", "유상증자"),
    ("전환사채", "전환사채"), ("교환사채", "전환사채"), ("신주인수권부사채", "전환사채"), ("주요사항보고서[전환사채]", "전환사채"),
    ("주요사항보고서[교환사채]", "전환사채"),
    ("자기주식취득", "자기주식"), ("자기주식처분", "자기주식"), ("주요사항보고서[자기주식취득]", "자기주식"), ("주요사항보고서[자기주식처분]", "자기주식"),
    ("주요사항보고서[합병]", "합병·분할"), ("주요사항보고서[분할]", "합병·분할"), ("주요사항보고서[주식교환]", "합병·분할"),
    ("주요사항보고서[영업양수]", "합병·분할"), ("주요사항보고서[영업양도]", "합병·분할"), ("합병", "합병·분할"), ("분할", "합병·분할"),
    ("영업양수도", "합병·분할"),
)


def label_reports(df: DataFrame, title: str = "report_nm", rules=REPORT_LABELS) -> DataFrame:
    """Add the label of each report title, null where no keyword occurs."""
    return df.withColumn("label", first_keyword(F.col(title), rules))


@F.pandas_udf(T.StringType())
def html_to_text_exact(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Same as the expression form, through the standard HTML parser: every entity is decoded."""
    from html.parser import HTMLParser

    class Visible(HTMLParser):
        skip = {"script", "style", "head"}

        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.parts, self.depth = [], 0

        def handle_starttag(self, tag, attrs):
            self.depth += tag in self.skip

        def handle_endtag(self, tag):
            self.depth -= tag in self.skip and self.depth > 0

        def handle_data(self, data):
            if not self.depth:
                self.parts.append(data)

    def one(html):
        if html is None:
            return None
        parser = Visible()
        parser.feed(html)
        parser.close()
        return " ".join(" ".join(parser.parts).split())

    for batch in pages:
        yield batch.map(one)


def split_pages(df: DataFrame, key: str, text: str, separator: str = "\n") -> DataFrame:
    """One row per page of a text: (key, page_num from 1, text)."""
    return df.select(key, F.posexplode(F.split(text, separator, -1)).alias("_p", "text")).select(
        key, (F.col("_p") + 1).cast("bigint").alias("page_num"), "text")


def with_sections(pages: DataFrame, key: str = "doc_id", pattern: str = X.HEADINGS) -> DataFrame:
    """Section of each page: its own heading, else the last heading before it, else 'General' (W11).

    Only headings run through the ordered scan; the page texts meet them by key and page, once.
    """
    heads = pages.groupBy(key, "page_num").agg(F.max(X.heading("text", pattern)).alias("_head"))
    named = carry_forward(heads, [key], "page_num", F.col("_head"), "General", "section").select(key, "page_num", "section")
    return pages.join(named, [key, "page_num"])


def build_chunks(pages: DataFrame, key: str = "doc_id", letters: str = X.LETTERS, headings: str = X.HEADINGS,
                 separator: str = r"\n{2,}", size: int = 1200, overlap: int = 200) -> DataFrame:
    """Chunk table out of pages: ids, section, title, text, page."""
    filled = pages.withColumn("text", X.strip("text")).where(F.col("text") != "")
    chunks = X.packed_chunks(X.remove_noise("text", letters), size, overlap, separator=separator)
    rows = with_sections(filled, key, headings).select(key, "page_num", "section", F.posexplode(chunks).alias("_i", "chunk"))
    page = F.lpad(F.col("page_num").cast("string"), 4, "0")
    local = F.lpad((F.col("_i") + 1).cast("string"), 2, "0")
    return rows.select(
        F.concat(F.col(key).cast("string"), F.lit("_p"), page, F.lit("_c"), local).alias("chunk_id"), key, "section",
        X.chunk_title(F.col("chunk"), F.col("page_num")).alias("title"), F.col("chunk").alias("text"), "page_num",
    )


def fixed_chunk_table(df: DataFrame, key: str, text: str, size: int = 800, overlap: int = 100) -> DataFrame:
    """Fixed chunks with ids ``{key}_{0000}``."""
    rows = df.select(key, F.posexplode(X.fixed_chunks(text, size, overlap)).alias("_i", "content"))
    return rows.select(
        F.concat(F.col(key).cast("string"), F.lit("_"), F.lpad(F.col("_i").cast("string"), 4, "0")).alias("chunk_id"),
        key, F.col("_i").cast("bigint").alias("chunk_no"), "content")


def _merge(pieces: Sequence[str], size: int, overlap: int) -> list[str]:
    out, cur, total = [], [], 0
    for p in pieces:
        if cur and total + len(p) > size:
            out.append("".join(cur).strip())
            while cur and (total > overlap or total + len(p) > size):
                total -= len(cur.pop(0))
        cur.append(p)
        total += len(p)
    if cur:
        out.append("".join(cur).strip())
    return [c for c in out if c]


def split_by_separators(text: str, size: int = 800, overlap: int = 100, separators: Sequence[str] = ("\n\n", "\n", " ", "")) -> list[str]:
    """Split on the coarsest separator present, split long pieces further, merge with overlap."""
    sep = next(s for s in separators if s == "" or s in text)
    finer = separators[separators.index(sep) + 1:]
    parts = list(text) if sep == "" else text.split(sep)
    pieces = parts if sep == "" else [parts[0], *[sep + p for p in parts[1:]]]
    out: list[str] = []
    small: list[str] = []
    for p in filter(None, pieces):
        if len(p) < size:
            small.append(p)
            continue
        out += _merge(small, size, overlap)
        small = []
        out += split_by_separators(p, size, overlap, finer) if finer else [p]
    return out + _merge(small, size, overlap)


def section_chunks(df: DataFrame, key: str, text: str, sources: dict[str, str], other: str, size: int = 800, overlap: int = 100) -> DataFrame:
    """Sections written as ``[[name]] body``, tagged by source and split by separators."""
    parts = F.transform(F.split(text, r"\[\[", -1), X.strip)
    usable = F.filter(parts, lambda p: p.contains("]]"))
    cells = F.transform(usable, lambda p: F.struct(
        X.strip(F.substring_index(p, "]]", 1)).alias("header"),
        X.strip(F.substring(p, F.instr(p, "]]") + 2, F.length(p))).alias("body")))
    rows = df.select(key, F.posexplode(cells).alias("section_no", "c")).select(key, "section_no", "c.*").where("body <> ''")
    source = F.lit(other)
    for word, name in sources.items():
        source = F.when(F.col("header").contains(word), name).otherwise(source)

    @F.pandas_udf("array<string>")
    def pieces(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: split_by_separators(b, size, overlap))

    return rows.select(key, "section_no", source.alias("source"), F.posexplode(pieces("body")).alias("order", "content"))


REPORT_SCHEMA = "doc_id string, sections array<struct<section: string, items: array<struct<title: string, text: string, keywords: array<string>>>>>"


def unnest_report(df: DataFrame, column: str) -> DataFrame:
    """Nested report JSON to flat chunks (section, title, text, keywords) with running ids."""
    doc = df.select(F.from_json(column, REPORT_SCHEMA).alias("d"))
    sections = doc.select("d.doc_id", F.inline("d.sections"))
    items = sections.select("doc_id", "section", F.posexplode("items").alias("_i", "item"))
    number = F.lpad((F.col("_i") + 1).cast("string"), 3, "0")
    return items.select(F.concat_ws("_", "section", number).alias("chunk_id"), "doc_id", "section", "item.*")


def context_lines(docs: DataFrame, group: str, position: str, text: str, letters: str = X.LETTERS,
                  names: Column | None = None, max_lines: int = 60, fallback: str | None = None) -> DataFrame:
    """First lines with letters (and, if given, one of the names) over a group's documents (X11).

    No document contributes more than ``max_lines``, so a group never holds more than the answer needs
    once the rank filter has run on the map side. A group without such a line gets ``fallback`` and no lines;
    without a fallback it has no row.
    """
    lines = F.transform(F.split(text, "\n", -1), X.strip)
    wanted = F.filter(lines, lambda s: s.rlike(f"[{letters}]"))
    if names is not None:
        wanted = F.filter(wanted, lambda s: F.exists(names, lambda n: s.contains(n)))
    rows = docs.select(group, position, F.posexplode(F.slice(wanted, 1, max_lines)).alias("_i", "line"))
    w = W.partitionBy(group).orderBy(position, "_i")
    first = rows.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= max_lines)
    ordered = F.array_sort(F.collect_list(F.struct("rk", "line")))
    found = first.groupBy(group).agg(
        F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("context"), F.count("*").alias("n_lines"))
    if fallback is None:
        return found
    every = docs.select(group, F.lit(None).cast("string").alias("context"), F.lit(0).cast("long").alias("n_lines"))
    both = found.unionByName(every).groupBy(group).agg(F.max("context").alias("context"), F.max("n_lines").alias("n_lines"))
    return both.withColumn("context", F.coalesce("context", F.lit(fallback)))


def quality_counts(measured: DataFrame) -> DataFrame:
    """Chunks beyond each quality cut."""
    return measured.agg(
        F.count("*").alias("chunks"), F.count_if(F.col("letter_ratio") < 0.3).alias("few_letters"),
        F.count_if(F.col("length") < 100).alias("short"), F.count_if(F.col("noise_line_ratio") > 0.3).alias("noisy"),
        F.count_if(F.col("score") >= 0.6).alias("good"))
