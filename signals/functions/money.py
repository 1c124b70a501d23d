"""Amounts, ratios and rounding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def detect_currency(raw: Column) -> Column:
    return F.when(F.upper(raw).contains("EUR"), "EUR").otherwise("FCFA")


def parse_money(raw: Column) -> Column:
    """Number of a written amount: currency words and spacing dropped, comma as point."""
    bare = F.regexp_replace(F.upper(raw), "FCFA|EUR", "")
    digits = F.regexp_replace(bare, "[^0-9,.-]", "")
    return F.translate(digits, ",", ".").try_cast("double")


def fx_rate(currency: Column, eur_rate: float) -> Column:
    return F.when(currency == "EUR", F.lit(float(eur_rate))).otherwise(F.lit(1.0))


def convert_fx(amount: Column, currency: Column, eur_rate: float) -> Column:
    return F.round(
        F.when(currency == "EUR", amount * F.lit(float(eur_rate))).otherwise(amount), 2
    )


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when the denominator is 0 or missing."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_if_positive(num: Column, den: Column) -> Column:
    return F.when(den > 0, ratio(num, den))


def round_half_up(x: Column, digits: int) -> Column:
    """One rounding form for every reported figure: floor(x * 10^d + 0.5) / 10^d."""
    scale = float(10**digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    return round_half_up(ratio(num * F.lit(100.0), den), digits)


def variation(current: Column, previous: Column) -> Column:
    """(current - previous) / |previous|, NULL when unknown or previous is 0."""
    return ratio(current - previous, F.abs(previous))


def one_row(df: DataFrame) -> Column:
    """A one-row frame as a struct constant: a scalar subquery, run once, never a join."""
    return df.select(F.struct(*df.columns)).scalar()
