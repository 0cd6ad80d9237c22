"""Cleaning, ratio and display expressions. Text is always converted with try_cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for "no amount", subtotal row names, unit words.
NULL_TOKENS = ("", "-", "N/A", "None", "nan")
SUBTOTAL_NAMES = ("소계", "합계", "동별(2)", "nan")
TRILLION, HUNDRED_MILLION = 1_0000_0000_0000, 1_0000_0000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def finite(col: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(~F.isnan(col) & (F.abs(col) != F.lit(float("inf"))), col)


def fixed(col: Column | str, digits: int) -> Column:
    """Number with a fixed count of decimals, half to even; null stays null, a small loss shows as -0.0."""
    v = _c(col).cast("double")
    text = F.format_string(f"%.{digits}f", F.bround(F.abs(v), digits))
    return F.when(v.isNotNull(), F.concat(F.when(v < 0, "-").otherwise(""), text))


def clean_number(col: Column | str, every_dash: bool = False) -> Column:
    """Number out of text with grouping commas; a lone dash is 0, anything else unreadable null.

    ``every_dash=True`` turns each dash into 0, so "-5" becomes 5.
    """
    text = F.replace(_c(col).cast("string"), F.lit(","), F.lit(""))
    if every_dash:
        text = F.trim(F.replace(text, F.lit("-"), F.lit("0")))
    else:
        text = F.trim(text)
        text = F.when(text == "-", "0").otherwise(text)
    return finite(text.try_cast("double"))


def parse_money(col: Column | str) -> Column:
    """Amount text to double: null words, "(x)" for losses, grouping and unit signs removed (P10)."""
    text = F.trim(_c(col).cast("string"))
    loss = text.startswith("(") & text.endswith(")")
    digits = F.regexp_replace(text, r"[^0-9.\-]", "").try_cast("double")
    return F.when(text.isin(*NULL_TOKENS), None).when(loss, -digits).otherwise(digits)


def safe_ratio(num: Column | str, den: Column | str, digits: int = 6) -> Column:
    """num/den rounded; null where the denominator is absent or 0 or the result is not finite."""
    return F.round(finite(_c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))), digits)


def share_pct(part: Column | str, total: Column | str, digits: int = 1) -> Column:
    """Percentage share, 0 where the total is not positive."""
    return F.when(_c(total) > 0, F.bround(_c(part) / _c(total) * 100, digits)).otherwise(0.0)


def grouped(col: Column | str, unit: str = "", missing: str = "-") -> Column:
    """Whole number with grouping commas."""
    return F.coalesce(F.concat(F.format_number(F.bround(_c(col).cast("double"), 0), 0), F.lit(unit)), F.lit(missing))


def ratio_text(col: Column | str, missing: str = "-") -> Column:
    """Ratio with four decimals."""
    return F.coalesce(fixed(col, 4), F.lit(missing))


def amount_text(col: Column | str, missing: str = "N/A") -> Column:
    """Large money amounts in trillions or hundred millions (P25)."""
    v = _c(col).cast("double")
    size, sign = F.abs(v), F.when(v < 0, "-").otherwise("")
    scaled = lambda unit, word: F.concat(sign, fixed(size / unit, 2), F.lit(word))
    return (
        F.when(v.isNull() | F.isnan(v), missing)
        .when(size >= TRILLION, scaled(float(TRILLION), "조원"))
        .when(size >= HUNDRED_MILLION, scaled(float(HUNDRED_MILLION), "억원"))
        .otherwise(F.concat(sign, F.format_number(F.bround(size, 0), 0), F.lit("원")))
    )


def hundred_millions(col: Column | str, missing: str = "정보없음") -> Column:
    """Amount in hundred millions with one decimal (P25)."""
    v = _c(col).cast("double") / float(HUNDRED_MILLION)
    sign = F.when(v < 0, "-").otherwise("")  # a small loss shows as -0.0
    return F.coalesce(F.concat(sign, F.format_number(F.bround(F.abs(v), 1), 1), F.lit("억원")), F.lit(missing))


def yoy(cur: Column | str, prev: Column | str) -> Column:
    """Change in percent of the size of the earlier value; null on null or 0."""
    return (_c(cur) - _c(prev)) / F.nullif(F.abs(_c(prev).cast("double")), F.lit(0.0)) * 100
