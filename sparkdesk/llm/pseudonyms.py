"""Format-preserving pseudonyms for personal data, by keyed Feistel networks.

Found values are replaced by others of the same format: digits by digits, letters by letters of the same case, all else
kept. The characters of a value are split in halves; in each round one half is shifted by key-dependent digits made from the
other half, which is undone by the same rounds backwards, so values map one to one and equal values stay equal across documents.

Validated values keep what makes them valid: a payment number its check digit, an IPv4 address its range per part, an ISO
date a real date (days from 1900 on, permuted by a Feistel network on two digits of base 270). E-mail addresses (the local part),
phone numbers (after the country code) and quoted secrets (hexadecimal, 32 digits or more) keep their shape. Long numbers
whose check digit is wrong, and dates that don't exist, are left alone unless ``strict`` is false.

All steps are column expressions. Rows: null and empty texts stay, with no values. Very long texts are scanned like others.
Repeated rows change alike. Other columns travel along; columns of the names ``replaced``, ``found`` and ``pseudonyms`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
EPOCH, BASE = "1900-01-01", 270  # 270 * 270 days: to 2099-08-04

# One pattern for every kind; the look-arounds keep a value from being part of a longer number or word.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
PHONE = r"(?<![\w.+-])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w-])"
ADDRESS = r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}(?!\.?\w)"
DATE = r"(?<![\w-])(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?![\w-])"
CARD = r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])"
SECRET = r"(?<=[\"'])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?=[\"'])"
PATTERN = "|".join((EMAIL, PHONE, ADDRESS, DATE, CARD, SECRET))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _stream(key: Column, round_: Column, half: Column) -> Column:
    """128 hexadecimal digits that the key, the round and a half decide."""
    return F.sha2(F.concat_ws("|", key, round_.cast("string"), half), 512)


def _number(hex_digits: Column, at: Column, width: int) -> Column:
    return F.conv(F.substr(hex_digits, at, F.lit(width)), 16, 10).cast("long")


_SETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _shift(half: Column, stream: Column, sign: int, sets: tuple[str, ...]) -> Column:
    """Each character moved within its set by the stream's number for its place; others stay."""

    def one(i: Column) -> Column:
        char = F.substr(half, i + 1, F.lit(1))
        by = _number(stream, (i % 32) * 4 + 1, 4) * sign
        moved = char
        for chars in reversed(sets):
            place = F.instr(F.lit(chars), char)
            moved = F.when(place > 0, F.substr(F.lit(chars), (F.pmod(place - 1 + by, F.lit(len(chars))) + 1).cast("int"), F.lit(1))).otherwise(moved)
        return moved

    return F.when(F.length(half) == 0, half).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(F.length(half) - 1, F.lit(0))), one), ""))


def permuted(value: Column, key: Column, sets: tuple[str, ...] = _SETS, back: bool = False) -> Column:
    """A keyed permutation of the strings of one format; ``back`` undoes it. One character alone is shifted by the key."""
    size = F.floor(F.length(value) / 2).cast("int")
    halves = F.struct(F.substr(value, F.lit(1), size).alias("l"), F.substr(value, size + 1, F.length(value)).alias("r"))

    def go(held: Column, round_: Column) -> Column:
        other, mine = F.when(round_ % 2 == 1, held["l"]).otherwise(held["r"]), F.when(round_ % 2 == 1, held["r"]).otherwise(held["l"])
        moved = _shift(mine, _stream(key, round_, other), -1 if back else 1, sets)
        return F.when(round_ % 2 == 1, F.struct(held["l"].alias("l"), moved.alias("r"))).otherwise(F.struct(moved.alias("l"), held["r"].alias("r")))

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, halves, go, lambda held: F.concat(held["l"], held["r"]))


def permuted_number(value: Column, key: Column, base: int, back: bool = False) -> Column:
    """A keyed permutation of 0 … base * base - 1: a Feistel network on two digits of that base."""
    halves = F.struct(F.floor(value / base).alias("l"), (value % base).cast("long").alias("r"))

    def go(held: Column, round_: Column) -> Column:
        odd = round_ % 2 == 1
        by = _number(_stream(key, round_, F.when(odd, held["l"]).otherwise(held["r"]).cast("string")), F.lit(1), 12) * (-1 if back else 1)
        return F.struct(F.when(odd, held["l"]).otherwise(F.pmod(held["l"] + by, F.lit(base))).alias("l"), F.when(odd, F.pmod(held["r"] + by, F.lit(base))).otherwise(held["r"]).alias("r"))

    rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, halves, go, lambda held: held["l"] * base + held["r"])


def check_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits where, from the right, those at odd (1) or even (0) places count double, less 9 above 9."""
    n = F.length(digits)

    def one(i: Column) -> Column:
        digit = F.substr(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == doubled, F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)).otherwise(digit)

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), one), F.lit(0), lambda a, b: a + b)


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""

    def one(i: Column) -> Column:
        char = F.substr(shape, i + 1, F.lit(1))
        number = F.length(F.regexp_replace(F.substr(shape, F.lit(1), i + 1), r"\D", ""))
        return F.when(char.rlike(r"\d"), F.substr(digits, number, F.lit(1))).otherwise(char)

    return F.array_join(F.transform(F.sequence(F.lit(0), F.length(shape) - 1), one), "")


def pseudonym(value: Column, key: Column, strict: bool = True, back: bool = False) -> Column:
    """The pseudonym of one found value (``back``: the value of a pseudonym)."""
    digits = F.regexp_replace(value, r"\D", "")

    def card() -> Column:
        body = permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), F.concat(key, F.lit("card")), _SETS[:1], back)
        valid = _let(body, lambda b: F.concat(b, F.pmod(10 - check_sum(b, 0) % 10, F.lit(10)).cast("int").cast("string")))
        changed = _let(valid, lambda d: _refilled(value, d))
        loose = value if strict else _let(permuted(digits, F.concat(key, F.lit("number")), _SETS[:1], back), lambda d: _refilled(value, d))
        return F.when(check_sum(digits, 1) % 10 == 0, changed).otherwise(loose)

    def address() -> Column:
        parts = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
        number = _let(parts, lambda p: ((p[0] * 256 + p[1]) * 256 + p[2]) * 256 + p[3])
        moved = permuted_number(number, F.concat(key, F.lit("address")), 65536, back)
        return _let(moved, lambda x: F.concat_ws(".", *[F.pmod(F.floor(x / 256**k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)]))

    def date() -> Column:
        day = F.try_to_date(value, "yyyy-MM-dd")
        number = F.datediff(day, F.lit(EPOCH).cast("date")).cast("long")
        moved = F.date_format(F.date_add(F.lit(EPOCH).cast("date"), permuted_number(number, F.concat(key, F.lit("date")), BASE, back).cast("int")), "yyyy-MM-dd")
        return F.when(day.isNotNull() & (number < BASE * BASE), moved).otherwise(value)

    def phone() -> Column:
        code = F.length(F.regexp_extract(value, r"^\+(\d{1,3}?)(?=[ .(-]|\d{10}$|$)", 1))
        moved = permuted(F.substr(digits, code + 1, F.length(digits)), F.concat(key, F.lit("phone")), _SETS[:1], back)
        return _refilled(value, F.concat(F.substr(digits, F.lit(1), code), moved))

    def email() -> Column:
        return F.concat(permuted(F.substring_index(value, "@", 1), F.concat(key, F.lit("mail")), _SETS, back), F.lit("@"), F.substring_index(value, "@", -1))

    hexes = ("0123456789abcdef", "ABCDEF")
    secret = F.when(value == F.upper(value), F.upper(permuted(F.lower(value), F.concat(key, F.lit("secret")), hexes, back))).otherwise(permuted(value, F.concat(key, F.lit("secret")), hexes, back))
    return (F.when(F.instr(value, "@") > 0, email()).when(F.startswith(value, F.lit("+")), phone()).when(value.rlike(r"^\d+\.\d+\.\d+\.\d+$"), address())
            .when(value.rlike(f"^{DATE}$"), date()).when(value.rlike(r"^[0-9A-Fa-f]{32,128}$"), secret).otherwise(card()))


def pseudonymised(docs: DataFrame, key: str, strict: bool = True, back: bool = False) -> DataFrame:
    """All rows of ``docs`` with ``text`` changed, ``found`` (the values replaced), ``pseudonyms`` (in the same order) and ``replaced`` (their number)."""
    names = [c for c in docs.columns if c not in ("found", "pseudonyms", "replaced")]
    hit = F.col("text").rlike("[0-9]") | F.contains("text", F.lit("@"))
    none = F.array().cast("array<string>")
    rows = docs.select(*names, F.when(hit, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(none).alias("_values"))
    rows = rows.select(*names, "_values", F.transform("_values", lambda v: pseudonym(v, F.lit(key), strict, back)).alias("_new"))
    gaps = F.split("text", PATTERN)
    whole = F.array_join(F.zip_with(gaps, F.concat("_new", F.array(F.lit(""))), lambda gap, new: F.concat(gap, new)), "")
    pairs = F.filter(F.arrays_zip(F.col("_values").alias("a"), F.col("_new").alias("b")), lambda x: x["a"] != x["b"])
    text = F.when(F.size("_values") > 0, whole).otherwise(F.col("text"))
    done = rows.select(*[text.alias("text") if c == "text" else F.col(c) for c in names], pairs.alias("_pairs"))
    return done.select(*names, F.transform("_pairs", lambda x: x["a"]).alias("found"), F.transform("_pairs", lambda x: x["b"]).alias("pseudonyms"), F.coalesce(F.size("_pairs"), F.lit(0)).alias("replaced"))
