"""Strict typing of raw strings, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted forms.
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
MONEY = r"^-?\d+(\.\d{1,2})?$"
#: White space of any alphabet, and the byte order mark.
SPACE = "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
MONEY_TYPE = "decimal(14,2)"


def trimmed(c: Column) -> Column:
    """c without white space of any alphabet around it."""
    return F.trim(c, F.lit(SPACE))


def present(c: Column) -> Column:
    """The trimmed value, null if that is blank."""
    return F.nullif(trimmed(c), F.lit(""))


def timestamp(c: Column) -> Column:
    return F.when(c.rlike(TIMESTAMP), F.try_to_timestamp(c))


def date(c: Column) -> Column:
    return F.when(c.rlike(DATE), c.try_cast("date"))


def money(c: Column) -> Column:
    return F.when(c.rlike(MONEY), c.try_cast(MONEY_TYPE))


def typed(c: Column, kind: str) -> Column:
    """The typed value of a present string, null if it is bad."""
    return {"string": lambda x: x, "timestamp": timestamp, "date": date, "money": money}[kind](c)


def problem(c: Column, kind: str) -> Column:
    """Why a value isn't of its kind."""
    wanted = {"timestamp": "UTC time like 2026-01-31T09:30:00Z", "date": "day like 2026-01-31", "money": "amount with two decimals at most"}
    return F.concat(F.lit(f"want a {wanted[kind]}, got "), c) if kind in wanted else F.lit("")


def utc_day(c: Column) -> Column:
    """The day of a timestamp or date string."""
    return F.to_date(F.substring(c, 1, 10))


def label(c: Column, labels: dict[str, str]) -> Column:
    """The canonical label of a raw one, letters in any case; null if the map has none."""
    if not labels:
        return F.lit(None).cast("string")
    return F.create_map(*[F.lit(x) for pair in sorted(labels.items()) for x in pair])[F.lower(c)]


def content_hash(columns: list[Column]) -> Column:
    """SHA-256 of the JSON array of canonical strings, nulls included."""
    return F.sha2(F.to_json(F.array(*[c.cast("string") for c in columns])), 256)


def natural_key(columns: list[Column]) -> Column:
    return F.concat_ws("|", *columns)


def first_of(options: list[Column]) -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), options)
