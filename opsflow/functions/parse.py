"""Parsing of text fields (S13, S19-S22): pure column expressions, no UDF.

Each parser returns NULL for a bad value, so a row's rejection reason is a
``when`` chain over the parsed columns instead of a Python exception.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_ws

# Fixed value: accepted date layouts (S21): yyyy-M-d, M/d/yyyy, d-M-yyyy, by their text shape (4-digit year, 1-2 digit
# month/day). The shapes are disjoint, so each value has the one layout it can match; its parts are put in the first
# layout's order and cast, which costs a fraction of a parse by pattern.
DATE_SHAPES = [r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$",
               r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"]

# Python int(): optional sign, digits, optional single underscores between
# digits are accepted by int() but never occur in the files; we accept only
# plain digits like the documented contract.
_INT_RE = r"^[+-]?[0-9]+$"
# Python Decimal(): digits with optional fraction and exponent; NaN/Infinity
# are rejected on purpose (quirk Q20).
_DEC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def hhmm_minutes(x: Column) -> Column:
    """``left(trim(x),2)*60 + right(trim(x),2)`` as INT."""
    t = F.trim(x)
    return (F.left(t, F.lit(2)).try_cast("int") * 60
            + F.right(t, F.lit(2)).try_cast("int"))


def parse_int_stripped(s: Column) -> Column:
    """``int(s)`` on already-stripped text: '5.0' and '1,000' are rejected."""
    return F.when(s.rlike(_INT_RE), s.try_cast("bigint")).cast("bigint")


def parse_decimal_stripped(s: Column, precision: int = 38, scale: int = 10) -> Column:
    """``Decimal(s.replace(',', ''))`` on already-stripped text."""
    s = F.replace(s, F.lit(","), F.lit(""))
    return F.when(s.rlike(_DEC_RE), s.try_cast(f"decimal({precision},{scale})"))


def parse_date_stripped(s: Column) -> Column:
    """First layout that parses wins (S21); invalid calendar days fail."""
    year, rest = F.right(s, F.lit(4)), F.substring(s, F.lit(1), F.length(s) - 5)
    day_first = F.concat_ws("-", year, F.substring_index(rest, "-", -1), F.substring_index(rest, "-", 1))
    month_first = F.concat_ws("-", year, F.replace(rest, F.lit("/"), F.lit("-")))
    iso = F.when(s.rlike(DATE_SHAPES[0]), s).when(s.rlike(DATE_SHAPES[1]), month_first).when(s.rlike(DATE_SHAPES[2]), day_first)
    return iso.try_cast("date")


def parse_int(x: Column) -> Column:
    """Python ``int(s.strip())``."""
    return parse_int_stripped(strip_ws(x))


def parse_decimal(x: Column, precision: int = 38, scale: int = 10) -> Column:
    """Python ``Decimal(s.strip().replace(',', ''))``."""
    return parse_decimal_stripped(strip_ws(x), precision, scale)


def parse_date(x: Column) -> Column:
    """Python ``strptime`` over the accepted layouts, after ``strip()``."""
    return parse_date_stripped(strip_ws(x))


def round_half_even(x: Column, scale: int = 2) -> Column:
    """``Decimal.quantize(Decimal('0.01'))`` default rounding."""
    return F.bround(x, scale)
