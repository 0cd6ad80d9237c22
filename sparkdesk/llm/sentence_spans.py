"""Substring dedup on sliding runs of sentences and of words.

Every run of ``width`` consecutive sentences of a document is hashed; equal hashes meet across all documents, the first
run (smallest doc_id, then place) stays, and each sentence that a later run covers is removed. Sentences end at ``.``,
``!``, ``?`` or a line break; a longer one is cut after 16 words. Case and white space don't count. Runs of fewer than
``least_words`` words are no passages and are not compared.

Runs of sentences miss a passage whose sentences are cut or grouped otherwise in another document. With ``passage_words``
runs of ``RUN_WORDS`` words are compared the same way, from content-selected places: the least hash of each ``passage_words`` -
``RUN_WORDS`` + 1 consecutive ones. Every passage of ``passage_words`` words holds such a run, the same one in each copy,
and a run of so many words covers a whole sentence wherever it starts. Each later copy thus loses a sentence at least, and
all the sentences that its runs cover together.

Rows: a null text stays null and an empty one empty; a document of fewer sentences than ``width`` is one run. A null id
sorts first. Fully equal rows are copies of one another: the first row by place in the input stays. Other columns travel
along; columns of the names ``kept``, ``removed`` and ``first_docs`` are replaced.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.textbytes import mix, slices, span_hashes, spaced_words
from sparkdesk.session import materialize

WIDTH = 3
LEAST_WORDS = 12
CUT_WORDS = 16
PASSAGE_WORDS = 50
RUN_WORDS = 2 * CUT_WORDS - 1  # covers a whole sentence wherever it starts
WORD_PLACES = 1 << 30  # places from here on count words and not sentences
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")
_WORD = re.compile(r"[^ \t-\r]+[ \t-\r]*")  # words as in spaced_words


def sentences(text: str, cut_words: int = CUT_WORDS) -> list[str]:
    """The sentences of a text; together they are the text."""
    out = []
    for s in _SENTENCE.findall(text):
        words = _WORD.findall(s) if len(s) > 2 * cut_words else ()
        if len(words) > cut_words:
            lead = s[: len(s) - sum(map(len, words))]
            words[0] = lead + words[0]
            out += ["".join(words[i : i + cut_words]) for i in range(0, len(words), cut_words)]
        else:
            out.append(s)
    return out


def _word_runs(words: np.ndarray, passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each selected run of ``RUN_WORDS`` words; fewer words than a passage have none."""
    if len(words) < passage_words:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    start = np.arange(len(words) - RUN_WORDS + 1)
    hashes = span_hashes(words, start, start + RUN_WORDS)
    least = np.lib.stride_tricks.sliding_window_view(hashes, passage_words - RUN_WORDS + 1).argmin(axis=1)
    start = np.unique(least + np.arange(len(least)))
    return start, mix(hashes[start])  # other hashes than those of sentences


def _runs(texts: list[str | None], width: int, least_words: int, passage_words: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place (first sentence, or first word from ``WORD_PLACES`` on) and hash of each run that counts, for a slice of texts."""
    split = [sentences(t) if t else [] for t in texts]
    many = np.array([len(x) for x in split], np.int64)
    begin = np.cumsum(many) - many  # of each text, in sentences
    words, first = spaced_words(pa.array(list(chain.from_iterable(split)), pa.large_string()))
    hashes = span_hashes(words, first[:-1], first[1:])
    long = many >= width
    start = np.flatnonzero(np.repeat(long, many) & (np.arange(len(hashes)) + width <= np.repeat(begin + many, many)))
    end = start + width
    short = np.flatnonzero(~long & (many > 0))
    start, end = np.concatenate([start, begin[short]]), np.concatenate([end, begin[short] + many[short]])
    keep = first[end] - first[start] >= least_words
    start, end = start[keep], end[keep]
    text = np.searchsorted(begin + many, start, "right")
    out = [(text, start - begin[text], span_hashes(hashes, start, end))]
    for number, (a, b) in enumerate(zip(first[begin], first[begin + many], strict=True) if passage_words else ()):
        place, span = _word_runs(words[a:b], passage_words)
        if len(place):
            out.append((np.full(len(place), number), place + WORD_PLACES, span))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def repeated_spans(docs: DataFrame, width: int = WIDTH, least_words: int = LEAST_WORDS, passage_words: int | None = None) -> DataFrame:
    """(doc_id, row, place, first_doc, first_place): each run that stands earlier too, with its first occurrence; ``row`` numbers the rows of ``docs``.

    Places from ``WORD_PLACES`` on are those of runs of words.
    """

    def runs(batches):
        for batch in slices(batches):
            text, place, span = _runs(batch.column("text").to_pylist(), width, least_words, passage_words)
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("row").take(at), pa.array(place.astype(np.int32)), pa.array(span.view(np.int64))], ["doc_id", "row", "place", "span"])

    spans = docs.select("doc_id", "row", "text").mapInArrow(runs, "doc_id long, row long, place int, span long")
    where = F.struct("doc_id", "row", "place")
    firsts = spans.groupBy("span").agg(F.min(where).alias("first"), F.count("*").alias("n")).where("n > 1").select("span", "first")
    return spans.join(firsts, "span").where(~where.eqNullSafe(F.col("first"))).select(
        "doc_id", "row", "place", F.col("first.doc_id").alias("first_doc"), F.col("first.place").alias("first_place"))


def _covered(found: list[str], places: np.ndarray, width: int) -> list[int]:
    """The sentences that runs at ``places`` cover."""
    words = places[places >= WORD_PLACES] - WORD_PLACES
    gone = {i for a in places[places < WORD_PLACES].tolist() for i in range(a, min(a + width, len(found)))}
    if len(words):
        _, first = spaced_words(pa.array(found, pa.large_string()))
        edges = np.zeros(first[-1] + 1, np.int64)
        np.add.at(edges, words, 1)
        np.add.at(edges, words + RUN_WORDS, -1)
        held = np.concatenate(([0], np.cumsum(np.cumsum(edges[:-1]) > 0)))  # covered words before each word
        many = np.diff(first)
        gone.update(np.flatnonzero((many > 0) & (held[first[1:]] - held[first[:-1]] == many)).tolist())
    return sorted(gone)


def without_repeats(docs: DataFrame, width: int = WIDTH, least_words: int = LEAST_WORDS, passage_words: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with ``kept`` (the text without covered sentences), ``removed`` (its sentences'
    numbers) and ``first_docs`` (the documents that hold the first occurrences)."""
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"))  # numbers the rows of one scan
    spans = materialize(repeated_spans(whole, width, least_words, passage_words), "spans")
    lists = spans.groupBy("row").agg(F.collect_set("place").alias("places"), F.collect_set("first_doc").alias("first_docs"))

    @F.pandas_udf("struct<kept string, removed array<int>>")
    def cut(text, places):
        import pandas as pd

        out = []
        for t, p in zip(text, places, strict=True):
            if t is None or p is None or not len(p):
                out.append((t, []))
                continue
            found = sentences(t)
            gone = _covered(found, np.asarray(p), width)
            lost = set(gone)
            out.append(("".join(s for i, s in enumerate(found) if i not in lost), gone))
        return pd.DataFrame(out, columns=["kept", "removed"])

    done = whole.join(lists, "row", "left").withColumn("x", cut("text", "places"))
    kept = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("kept", "removed", "first_docs")]
    return done.select(*kept, "x.kept", "x.removed", F.coalesce("first_docs", F.array().cast("array<bigint>")).alias("first_docs"))
