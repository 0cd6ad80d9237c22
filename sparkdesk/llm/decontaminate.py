"""Benchmark passages in documents, found by pigeonhole pieces and verified by edit distance.

A test item of n characters may stand in a document with up to ``budget`` edits. Cut into budget + 1 pieces, at least one
piece then stands there unchanged: an automaton of all pieces reads each text once, and every piece hit is verified in
the stretch around it with bit-parallel edit distance. The items travel to the tasks in blocks of a fixed size; more items
mean more blocks over all documents, not larger ones.

Rows: upper and lower case and kinds of white space count as equal. Items that are null, empty or shorter than
``least_chars`` are not searched (two of equal text are both reported). A null or empty text has no match. Repeated rows
match as often as they come; a null doc_id is kept in the result. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.textbytes import slices
from sparkdesk.session import materialize

EDIT_SHARE = 0.05
LEAST_CHARS = 40
BLOCK_CHARS = 4_000_000
MATCHES = "doc_id long, item_id long, begin long, end long, edits int"
_SPACE = {ord(c): " " for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0  　"}


def plain(text: str) -> str:
    """Lower case and plain spaces, character for character (a letter whose lower case is longer stays)."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.translate(_SPACE)


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(start, piece) of ``budget`` + 1 pieces of nearly equal length."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def nearest(pattern: str, text: str) -> tuple[int, int]:
    """(edits, end): the least edit distance between the whole pattern and a stretch of the text, and where the first best stretch ends.

    Each column of the distance table is two bit vectors of vertical steps (up, down), as in Myers' method.
    """
    m = len(pattern)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | (1 << i)
    up, down, edits = ones, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        same = where.get(c, 0)
        diagonal = ((((same & up) + up) ^ up) | same | down) & ones
        right_up = down | (ones & ~(diagonal | up))
        right_down = up & diagonal
        edits += bool(right_up & top) - bool(right_down & top)
        right_up = (right_up << 1) & ones
        right_down = (right_down << 1) & ones
        up = right_down | (ones & ~(diagonal | right_up))
        down = right_up & diagonal
        if edits < best:
            best, end = edits, at
    return best, end


def search(text: str, automaton, items: list[tuple[int, str, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(item_id, begin, end, edits) of each stretch of a plain text that is an item within its budget."""
    seen: dict[int, int] = {}
    for last, hits in automaton.iter(text):
        for number, start, length in hits:
            item_id, item, budget = items[number]
            at = last + 1 - length - start  # where the item begins if nothing was inserted or left out before the piece
            free = seen.get(number, 0)  # where the last match of the item ended
            if at + budget < free:
                continue
            if at >= free and text.startswith(item, at):
                begin, end, edits = at, at + len(item), 0
            else:
                low = max(free, at - budget)
                edits, end = nearest(item, text[low : at + len(item) + budget])
                if edits > budget:
                    continue
                end += low
                _, back = nearest(item[::-1], text[max(low, end - len(item) - budget) : end][::-1])
                begin = end - back
            seen[number] = end
            yield item_id, begin, end, edits


def contaminated(docs: DataFrame, benchmark: DataFrame, edit_share: float = EDIT_SHARE, least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, begin, end, edits): stretches of documents that are test items within floor(edit_share * n) edits."""
    usable = benchmark.select("item_id", "text").where(F.length("text") >= least_chars)
    chars = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    found = None
    for block in range(blocks):
        mine = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)  # about block_chars characters
        items = [(r["item_id"], r["text"]) for r in mine.collect()]
        if not items:
            continue
        part = docs.select("doc_id", "text").mapInArrow(_searcher(items, edit_share), MATCHES)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], MATCHES) if found is None else found


def _searcher(rows: list[tuple[int, str]], edit_share: float):
    def run(batches):
        items = [(i, p, int(len(p) * edit_share)) for i, p in ((i, plain(t)) for i, t in rows)]
        by_piece: dict[str, list[tuple[int, int, int]]] = {}
        for number, (_, item, budget) in enumerate(items):
            for start, piece in pieces(item, budget):
                by_piece.setdefault(piece, []).append((number, start, len(piece)))
        automaton = ahocorasick.Automaton()
        for piece, hits in by_piece.items():
            automaton.add_word(piece, hits)
        automaton.make_automaton()
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    out += [(doc_id, *x) for x in search(plain(text), automaton, items)]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "begin", "end", "edits"])

    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no test item; all columns and rows (a null id stays)."""
    lost = materialize(contaminated(docs, benchmark, **options).select("doc_id").distinct(), "contaminated")
    return docs.join(lost, "doc_id", "left_anti").select(docs.columns)
