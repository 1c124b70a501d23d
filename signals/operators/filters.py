"""Row filters over closed lists and months."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_month(text: str) -> date:
    """First day of a "YYYY-MM" month; anything else is an error."""
    year, _, number = text.partition("-")
    if not (len(year) == 4 and len(number) == 2 and (year + number).isdigit()):
        raise ValueError(f"month must be YYYY-MM, got {text!r}")
    return date(int(year), int(number), 1)


def resolve_members(values: str | Iterable[str], aliases: Mapping[str, str]) -> list[str]:
    """Members named by the values; an unknown name is an error that lists the choices."""
    names = [values] if isinstance(values, str) else list(values)
    out = []
    for name in names:
        key = name.strip().lower()
        if key not in aliases:
            choices = ", ".join(sorted(set(aliases.values())))
            raise ValueError(f"unknown value {name!r}, expected one of: {choices}")
        out.append(aliases[key])
    return out


def member_condition(column: str, values, aliases: Mapping[str, str]) -> Column:
    return F.col(column).isin(*resolve_members(values, aliases))


def members_in_closed_list(df: DataFrame, column: str, values, aliases) -> DataFrame:
    return df.where(member_condition(column, values, aliases))


def rows_in_months(df: DataFrame, months: Iterable[str]) -> DataFrame:
    """Rows of the selected "YYYY-MM" months; no selection keeps everything."""
    wanted = [as_month(m) for m in months]
    return df.where(F.col("month").isin(*wanted)) if wanted else df


def month_window(month: str) -> Column:
    """Half-open [month, next month)."""
    start = F.lit(as_month(month))
    return (F.col("month") >= start) & (F.col("month") < F.add_months(start, 1))
