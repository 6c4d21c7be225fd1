"""Lenient readers of vendor fields, as Column expressions (nulls instead of errors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def stripped(text: Column) -> Column:
    """text without white space, Unicode's included, at either end."""
    return F.regexp_replace(text, f"^{_BLANK}|{_BLANK}$", "")


def _double(text: Column) -> Column:
    """A float literal as a number, else null: digits may be grouped by single underscores."""
    bare = stripped(text)
    plain = F.regexp_replace(bare, r"(?<=\d)_(?=\d)", "")
    numeric = plain.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$")
    special = F.lower(plain)
    return (
        F.when(numeric, plain.try_cast("double"))
        .when(special.rlike(r"^\+?inf(?:inity)?$"), F.lit(float("inf")))
        .when(special.rlike(r"^-inf(?:inity)?$"), F.lit(float("-inf")))
        .when(special.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
    )


def float_of(text: Column, kind: Column) -> Column:
    """A JSON value as a float, or null: strings by their text, booleans as 0 or 1."""
    return F.when(kind == "BOOLEAN", (text == "true").cast("double")).when(kind.rlike("^(?:ARRAY|OBJECT|VOID)"), F.lit(None).cast("double")).otherwise(_double(text))


def int_of(text: Column, kind: Column) -> Column:
    """A JSON value as an integer, or null: numbers are cut off towards zero, strings have to be integers."""
    plain = F.regexp_replace(stripped(text), r"(?<=\d)_(?=\d)", "")
    whole = F.when(plain.rlike(r"^[+-]?\d+$"), plain.try_cast("bigint"))
    return (
        F.when(kind == "STRING", whole)
        .when(kind == "BOOLEAN", (text == "true").cast("bigint"))
        .when(kind.rlike("^(?:ARRAY|OBJECT|VOID)"), F.lit(None).cast("bigint"))
        .otherwise(F.coalesce(whole, text.try_cast("double").try_cast("bigint")))
    )


def duration_ms(text: Column) -> Column:
    """Seconds, M:S or H:M:S as milliseconds, cut off; 0 for anything else."""
    parts = F.transform(F.split(stripped(text), ":"), _double)
    at = lambda i: F.get(parts, i)
    seconds = F.when(F.size(parts) == 3, at(0) * 3600 + at(1) * 60 + at(2)).when(F.size(parts) == 2, at(0) * 60 + at(1)).when(F.size(parts) == 1, at(0))
    good = ~F.exists(parts, lambda x: x.isNull() | F.isnan(x))
    return F.coalesce(F.when(good, (seconds * 1000).try_cast("bigint")), F.lit(0))


def resolution(text: Column) -> Column:
    """(width, height): from WxH, or from a height as 16:9 with an even width; zeros for anything else."""
    bare = F.lower(stripped(text))
    both, single = r"^(\d{3,5})\s*[x×]\s*(\d{3,5})", r"^(\d{3,4})p?"
    height = F.regexp_extract(bare, single, 1).try_cast("int")
    width = (F.floor(height.cast("double") * 16 / 9 / 2) * 2).cast("int")
    pair = lambda w, h: F.struct(w.alias("width"), h.alias("height"))
    return (
        F.when(bare.rlike(both), pair(F.regexp_extract(bare, both, 1).try_cast("int"), F.regexp_extract(bare, both, 2).try_cast("int")))
        .when(bare.rlike(single), pair(width, height))
        .otherwise(pair(F.lit(0), F.lit(0)))
    )


def declared_fps(text: Column) -> Column:
    return F.coalesce(_double(text), F.lit(0.0))


def rate(text: Column) -> Column:
    """A frame rate as a/b or a number; 0 if it can't be read or b is 0."""
    parts = F.split(text, "/")
    pair = F.try_divide(_double(F.get(parts, 0)), _double(F.get(parts, 1)))
    return F.coalesce(F.when(F.contains(text, F.lit("/")), F.when(F.size(parts) == 2, pair)).otherwise(_double(text)), F.lit(0.0))


def is_url(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^(?i)https?://[^/?#]+"), F.lit(False))


def tenths(ms: Column) -> Column:
    """Whole milliseconds as seconds, rounded to tenths: of the binary number next to ms / 1000, half to even where it lies in the middle.

    1000 * q for that number q is worked out without an error, as a product and its
    rest, so that a number in the middle of two tenths is told from one beside it.
    """
    exact = ms.cast("double")
    q = exact / F.lit(1000.0)
    split = q * F.lit(134217729.0)
    high = split - (split - q)
    product = q * F.lit(1000.0)
    rest = (high * F.lit(1000.0) - product) + (q - high) * F.lit(1000.0)
    over = (product - exact) + rest
    whole = (ms - F.pmod(ms, F.lit(100))) / 100  # of numbers under 2^53, without an error
    left = F.pmod(ms, F.lit(100))
    up = F.when(left != 50, (left > 50).cast("int")).when(over != 0, (over > 0).cast("int")).otherwise(F.pmod(whole, F.lit(2.0)).cast("int"))
    return (whole + up) / F.lit(10.0)
