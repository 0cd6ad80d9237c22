"""Document fingerprints: a Merkle tree over sections, paragraphs and short runs of words.

Sections end at a blank line, paragraphs at a line break, and leaves at the end of a sentence or after eight words; the
cuts keep every character, so the root (a hash of hashes) is equal exactly for equal texts. Where two trees differ, only
the branches whose hashes differ hold an edit. All steps are column expressions.

Rows: a null text is an empty one, whose tree has one section of one empty paragraph. Very long texts are one tree like
any other. Repeated rows give equal trees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import following

_NO_ID = -(1 << 63)  # stands for a null id in joins
_SECTIONS = r"(?<=\n[ \t]{0,8}\n)(?=[^\n])"
_PARAGRAPHS = r"(?<=\n)"
_LEAVES = r"\s*(?:\S*[^\s.!?]\s+){0,7}\S+\s*|\s+"
LEAF_DIGITS, NODE_DIGITS = 16, 20


def _digest(text: Column, digits: int) -> Column:
    return F.substring(F.sha2(text, 256), 1, digits)


def tree(text: Column) -> Column:
    """Sections of paragraphs of leaf hashes: array<array<array<string>>>."""

    def leaves(paragraph: Column) -> Column:
        return F.transform(F.regexp_extract_all(paragraph, F.lit(_LEAVES), F.lit(0)), lambda leaf: _digest(leaf, LEAF_DIGITS))

    sections = F.split(F.coalesce(text, F.lit("")), _SECTIONS)
    return F.transform(sections, lambda section: F.transform(F.split(section, _PARAGRAPHS), leaves))


def _named(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def fingerprint(text: Column) -> Column:
    """``root/section:paragraph.leaf.leaf,paragraph…`` with a hash for each node: equal texts, and only they, have equal roots."""

    def paragraph(leaves: Column) -> Column:
        return _named(F.array_join(leaves, "."), lambda x: F.concat(_digest(x, NODE_DIGITS), F.lit("."), x))

    def section(paragraphs: Column) -> Column:
        return _named(F.array_join(F.transform(paragraphs, paragraph), ","), lambda x: F.concat(_digest(x, NODE_DIGITS), F.lit(":"), x))

    return _named(F.array_join(F.transform(tree(text), section), "/"), lambda x: F.concat(_digest(x, 64), F.lit("/"), x))


def root(print_: Column) -> Column:
    return F.substring_index(print_, "/", 1)


def leaf_set(print_: Column) -> Column:
    """The distinct leaf hashes of a fingerprint (they alone have their number of digits)."""
    parts = F.split(print_, r"[./:,]")
    return F.array_distinct(F.filter(parts, lambda x: F.length(x) == LEAF_DIGITS))


def likeness(left: Column, right: Column) -> Column:
    """Twice the shared distinct leaves over all distinct leaves of both, from two leaf sets; two empty ones are alike."""
    both = F.size(left) + F.size(right)
    return F.when(both == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(left, right)) / both)


def differing_paragraphs(left: Column, right: Column) -> Column:
    """Which paragraphs of ``left`` ("section.paragraph", from 0) have a hash that ``right`` lacks; sections that match as a whole are not entered."""

    def parts(print_: Column) -> Column:
        return F.slice(F.split(print_, "/"), 2, 1 << 30)

    known = F.transform(parts(right), lambda s: F.substring_index(s, ":", 1))
    lines = F.flatten(F.transform(parts(right), lambda s: F.transform(F.split(F.substring_index(s, ":", -1), ","), lambda p: F.substring_index(p, ".", 1))))
    found = F.transform(parts(left), lambda s, i: F.when(F.array_contains(known, F.substring_index(s, ":", 1)), F.array().cast("array<string>")).otherwise(
        F.filter(F.transform(F.split(F.substring_index(s, ":", -1), ","), lambda p, j: F.when(
            ~F.array_contains(lines, F.substring_index(p, ".", 1)), F.concat_ws(".", i, j))), lambda x: x.isNotNull())))
    return F.flatten(found)


def with_edited(docs: DataFrame) -> DataFrame:
    """(doc_id, text, edited, after_print) of every row: ``edited`` has the last floor(n/4) characters replaced by the
    first as many (or all) of the next document, by ascending doc_id (nulls first; after the last comes the first), and
    ``after_print`` is the fingerprint of that next document.

    The order is found on ids alone. Then the start of each next document travels to its predecessor; both joins read the
    same exchange of texts. Rows of equal id and text are one document in the order, and each of them gets its result.
    """
    docs = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("i"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ids = docs.select("i", "h", F.floor(F.length("text") / 4).cast("int").alias("quarter")).distinct()
    ids = following(ids, ["i", "h"], ["i", "h"], "merkle-order", ring=True)
    sent = ids.select(F.col("i").alias("to_i"), F.col("h").alias("to_h"), "quarter", F.col("after.i").alias("i"), F.col("after.h").alias("h"))
    sent = docs.join(sent, ["i", "h"]).select("to_i", "to_h", "quarter", F.expr("substring(text, 1, quarter)").alias("start"), fingerprint(F.col("text")).alias("after_print"))
    sent = sent.groupBy(F.col("to_i").alias("i"), F.col("to_h").alias("h")).agg(F.first(F.struct("quarter", "start", "after_print")).alias("x"))
    return docs.join(sent, ["i", "h"]).select(
        F.nullif("i", F.lit(_NO_ID)).alias("doc_id"), "text",
        F.concat(F.expr("substring(text, 1, length(text) - x.quarter)"), "x.start").alias("edited"), "x.after_print")
