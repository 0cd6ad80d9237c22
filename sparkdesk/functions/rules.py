"""Ordered rules written as data and compiled to one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule whose condition holds."""
    out = None
    for cond, value in rules:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default)


def first_keyword(text: Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first keyword, in list order, that occurs in the text."""
    return first_match([(text.contains(word), label) for word, label in rules], default)


def any_keyword(text: Column, words: Sequence[str]) -> Column:
    """True where any of the words occurs, taken literally."""
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit
