"""Repeated passages with a sparse suffix array.

Only suffixes (of the word sequence of a text) that start at content-selected places are kept: the least of each ``window``
consecutive 8-word hashes. A passage of ``least_words`` words holds such a place early enough that ``KEY_WORDS`` words of it
follow, and every copy of it selects the same place. How many words of the passage stand ahead of the place is not known, so
a place has a key for each ``STEP`` words it may be: the words from there on, as many as every such passage holds. The
suffixes of all documents are sorted by key, then by the words beyond it to the left and to the right; neighbours of one key
are extended to the left and to the right on the texts, and what reaches ``least_words`` is a repeat. Words are compared as
hashes (white space and A-Z case don't count).

With 50 words and steps of 7 neighbours of a key share 44 words of a passage. Copies of one passage stand side by side, but
for the case that further texts hold those 44 words, and not the other 6, between them in the order.

The sort is by ranges, so a passage that a third of all documents hold is spread over many tasks; neighbours are as many as
keys, whatever the groups' sizes.

Rows: null, empty and short texts have no passage; a very long text is read like any other. Rows with a null doc_id are not
compared. A doc_id names one text: of rows of one id the one of the smallest text is read, so they don't repeat each other.
Ties in the sort go by doc_id and place. An empty table gives an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkdesk.llm.common import keep_ids
from sparkdesk.llm.textbytes import mix, slices, span_hashes, spaced_words, windows
from sparkdesk.session import materialize

LEAST_WORDS = 50
GRAM = 8
KEY_WORDS = 16
STEP = 7


def selected(words: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash (the first of equal ones) of each ``window`` consecutive 8-word hashes."""
    grams = windows(words, GRAM)
    if len(grams) < window:
        return np.empty(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def keyed(words: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, side, start) of a text: for each number of words that may stand ahead of a selected place the words from there on."""
    window = least_words - KEY_WORDS + 1 - (GRAM - 1)
    places = selected(words, window) if len(words) >= least_words else np.empty(0, np.int64)
    held = least_words - STEP + 1  # words that every passage of a step holds
    start = np.unique(np.concatenate([places - ahead for ahead in range(0, window, STEP)]))
    start = start[(start >= 0) & (start + held <= len(words))]
    left = span_hashes(words, np.maximum(start - STEP + 1, 0), start)
    right = span_hashes(words, start + held, np.minimum(start + held + STEP - 1, len(words)))
    return span_hashes(words, start, start + held), mix(left) + right, start


def suffixes(docs: DataFrame, least_words: int) -> DataFrame:
    """(key, next, doc_id, place): the selected suffixes under each of their keys."""

    def run(batches):
        for batch in slices(batches):
            words, first = spaced_words(batch.column("text"))
            out = [[], [], [], []]
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), first[:-1], first[1:], strict=True):
                if b - a >= least_words:
                    key, side, place = keyed(words[a:b], least_words)
                    for column, values in zip(out, (key, side, np.full(len(key), doc_id), place), strict=True):
                        column.append(values)
            key, side, doc, place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in out)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(side.view(np.int64)), pa.array(doc.astype(np.int64)), pa.array(place.astype(np.int32))], ["key", "next", "doc_id", "place"])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "key long, next long, doc_id long, place int")


def neighbours(kept: DataFrame, name: str) -> DataFrame:
    """(a, a_place, b, b_place): each suffix and the next one in the order, where both begin with the same words."""
    names = ["a_key", "a", "a_place", "b_key", "b", "b_place", "part"]
    kinds = "a_key long, a long, a_place int, b_key long, b long, b_place int, part int"

    def run(batches):
        part, last, first = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c) for c in ("key", "doc_id", "place")]
            if last is None:
                first = [c[:1] for c in rows]
            else:
                rows = [pa.concat_arrays([x, c]) for x, c in zip(last, rows, strict=True)]
            same = pc.equal(rows[0][:-1], rows[0][1:])
            pairs = pa.RecordBatch.from_arrays([*(c[:-1] for c in rows), *(c[1:] for c in rows), pa.array(np.full(len(rows[0]) - 1, -1, np.int32))], names)
            yield pairs.filter(same)
            last = [c[-1:] for c in rows]
        if last is not None:  # the part's last and first suffix, for the edges
            yield pa.RecordBatch.from_arrays([*last, *first, pa.array([part], pa.int32())], names)

    found = kept.repartitionByRange("key", "next", "doc_id", "place").sortWithinPartitions("key", "next", "doc_id", "place")
    found = materialize(found.mapInArrow(run, kinds), name)
    by_part = Window.orderBy("part")  # one row for each part of the sort
    edges = found.where("part >= 0")
    for c in ("key", "", "place"):
        column = f"b_{c}" if c else "b"
        edges = edges.withColumn(column, F.lead(column).over(by_part))
    return found.where("part < 0").union(edges.where("a_key = b_key")).select("a", "a_place", "b", "b_place")


def extended(x: np.ndarray, y: np.ndarray, places: list[int], shift: int, least_words: int) -> list[tuple[int, int]]:
    """(begin, words) in ``x`` of the maximal equal stretches around ``places`` where ``x`` at i is held against ``y`` at i - shift."""
    low, high = max(0, shift), min(len(x), len(y) + shift)
    equal = np.concatenate(([False], x[low:high] == y[low - shift : high - shift], [False]))
    breaks, out, done = np.flatnonzero(~equal) - 1 + low, [], -1
    for place in sorted(places):
        if place < done:
            continue
        at = int(np.searchsorted(breaks, place, "right"))
        begin, done = int(breaks[at - 1]) + 1, int(breaks[at]) if at < len(breaks) else place
        if done - begin >= least_words:
            out.append((begin, done - begin))
    return out


def repeated_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, begin, other_id, other_begin, words): stretches of at least ``least_words`` words that also stand elsewhere.

    ``doc_id`` is the later document of a pair and ``other_id`` the earlier one (or the same); begins count words. Each copy
    of a passage is tied to a neighbour in the sort, so the copies of one passage form a chain.
    """
    pairs = neighbours(suffixes(docs, least_words), "suffix-neighbours").where("a <> b or a_place <> b_place")
    turn = F.expr("a < b or (a = b and a_place < b_place)")
    x, y, i, j = (F.when(turn, F.col(q)).otherwise(F.col(p)) for p, q in (("a", "b"), ("b", "a"), ("a_place", "b_place"), ("b_place", "a_place")))
    pairs = pairs.select(x.alias("x"), y.alias("y"), i.alias("i"), (i - j).alias("shift")).groupBy("x", "y", "shift").agg(F.collect_set("i").alias("places"))
    pairs = materialize(pairs.groupBy("x", "y").agg(F.collect_list(F.struct("shift", "places")).alias("lines")), "suffix-pairs")  # of two texts, not of a group
    ids = materialize(pairs.select(F.col("x").alias("doc_id")).union(pairs.select("y")).distinct(), "suffix-ids")
    texts = keep_ids(docs.select("doc_id", "text"), ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = materialize(texts, "suffix-texts")

    def verify(batches):
        for batch in slices(slices(batches, "x_text"), "y_text"):
            (xw, xf), (yw, yf) = spaced_words(batch.column("x_text")), spaced_words(batch.column("y_text"))
            out = []
            for k, row in enumerate(batch.select(["x", "y", "lines"]).to_pylist()):
                a, b = xw[xf[k] : xf[k + 1]], yw[yf[k] : yf[k + 1]]
                for line in row["lines"]:
                    out += [(row["x"], begin, row["y"], begin - line["shift"], n) for begin, n in extended(a, b, line["places"], line["shift"], least_words)]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "begin", "other_id", "other_begin", "words"])

    at = pairs.join(texts.select(F.col("doc_id").alias("x"), F.col("text").alias("x_text")), "x")
    at = at.join(texts.select(F.col("doc_id").alias("y"), F.col("text").alias("y_text")), "y")
    return at.select("x", "y", "lines", "x_text", "y_text").mapInArrow(verify, "doc_id long, begin long, other_id long, other_begin long, words long").distinct()
