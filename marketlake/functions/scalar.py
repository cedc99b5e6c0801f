"""Scalar expressions over columns. None of them fails on bad input: it becomes null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that landed files use for a missing value (fixed values).
NULL_TOKENS = ("NULL", "null", "", "None", "N/A", "n/a")


def null_tokens(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text; null where it is one of the tokens."""
    text = F.trim(c)
    return F.when(~text.isin(*tokens), text)


def to_decimal(c: Column, precision: int = 18, scale: int = 4) -> Column:
    """Rounds half up, accepts exponents; garbage and overflow become null."""
    return c.try_cast(f"decimal({precision},{scale})")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_date(c: Column, form: str = "yyyy-MM-dd") -> Column:
    """Strict: a date in another form, or one that doesn't exist, becomes null."""
    return F.try_to_date(c, form)


def symbol_id(symbol: Column) -> Column:
    """A number below 10**9 for each symbol. Numbers can collide, so join on the symbol."""
    return F.conv(F.substring(F.md5(symbol), 1, 15), 16, 10).cast("long") % 1_000_000_000


def quarter_end(quarter: Column) -> Column:
    """Last day of a quarter written ``2022Q3``; null in any other form."""
    fits = F.regexp_extract(quarter, r"^(\d{4})Q([1-4])$", 1) != ""
    year, q = F.substring(quarter, 1, 4).try_cast("int"), F.substring(quarter, 6, 1).try_cast("int")
    return F.when(fits, F.last_day(F.make_date(year, q * 3, F.lit(1))))


def quarter_end_of(day: Column) -> Column:
    return F.last_day(F.make_date(F.year(day), F.quarter(day) * 3, F.lit(1)))


def days_between(earlier: Column, later: Column) -> Column:
    """Calendar days."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


#: Seconds in a unit.
UNITS = {"second": 1, "minute": 60, "hour": 3600}


def units_between(unit: str, earlier: Column, later: Column) -> Column:
    """Boundaries of the unit crossed: 00:59 to 02:00 is two hours."""
    at = lambda c: F.unix_timestamp(F.date_trunc(unit, c))
    return ((at(later) - at(earlier)) / UNITS[unit]).cast("long")


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage in double, rounded; null if the whole is 0 or null."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def older_than(day: Column, as_of: Column, days: int) -> Column:
    """Never, or more than so many days before ``as_of``: a date exactly that old is not."""
    return day.isNull() | (day < F.date_sub(as_of, days))


def preview(text: Column, n: int) -> Column:
    """The first n characters, with dots where more follow."""
    return F.when(F.char_length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def clean_date(c: Column) -> Column:
    """The date that a text begins with, once space around it and tags are gone; null if it begins otherwise."""
    plain = F.regexp_replace(F.trim(c), "<.*?>", "")
    return to_date(F.nullif(F.regexp_extract(plain, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")))
