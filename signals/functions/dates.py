"""Date parsing and calendar helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signals.functions.text import literal_array

# French month names in calendar order.
MONTHS = [
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
]
MONTHS_PLAIN = [
    "janvier", "fevrier", "mars", "avril", "mai", "juin",
    "juillet", "aout", "septembre", "octobre", "novembre", "decembre",
]
TIMESTAMP_LAYOUTS = ["yyyy-M-d H:m", "d/M/yyyy H:m", "yyyy-M-d", "d/M/yyyy"]


def _month_number(name: Column, names: list[str]) -> Column:
    position = F.array_position(literal_array(names), name)
    return F.nullif(position, F.lit(0))


def _date_of(year: Column, month: Column, day: Column) -> Column:
    # NULL for an impossible calendar date, where make_date would raise.
    text = F.concat(year, F.lit("-"), month.cast("string"), F.lit("-"), day)
    return F.try_to_date(text, "yyyy-M-d")


def parse_mixed_date(raw: Column) -> Column:
    """ISO, d/m/Y or "<day> <french month> <year>" (accents required), else NULL."""
    text = F.trim(raw)
    worded = r"^([0-9]{1,2}) (\p{L}+) ([0-9]{4})$"
    low = F.lower(text)
    day, name, year = (F.regexp_extract(low, worded, i) for i in (1, 2, 3))
    return F.coalesce(
        F.try_to_date(text, "yyyy-M-d"),
        F.try_to_date(text, "d/M/yyyy"),
        _date_of(year, _month_number(name, MONTHS), day),
    )


def parse_french_month(raw: Column) -> Column:
    """"<month> <year>", accents optional -> first day of that month, else NULL."""
    low = F.lower(F.trim(raw))
    worded = r"^(\p{L}+)\s+([0-9]{4})$"
    name, year = (F.regexp_extract(low, worded, i) for i in (1, 2))
    number = F.coalesce(_month_number(name, MONTHS), _month_number(name, MONTHS_PLAIN))
    return _date_of(year, number, F.lit("1"))


def parse_mixed_timestamp(raw: Column) -> Column:
    """First layout that reads: ISO then d/m/Y, with then without a time."""
    text = F.trim(raw)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in TIMESTAMP_LAYOUTS])


def month_floor(d: Column) -> Column:
    return F.trunc(d, "MM")


def week_floor(d: Column) -> Column:
    return F.trunc(d, "week")
