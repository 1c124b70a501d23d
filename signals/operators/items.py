"""Order text -> item lines -> order quality.

The lines of one order are kept as an array on the order's own row, so the order-level
figures need no shuffle. ``order_items`` explodes the array when the item grain itself is
wanted; both carry the order's ``row_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions.text import collapse_spaces
from signals.params import Params

# How products, formats and quantities are written in an order.
PRODUCT_PATTERNS = [
    ("bissap", r"bissap|bis[- ]?1l|bis[- ]?33\s*cl"),
    ("gingembre", "gingembre"),
    ("bouye", "bouye"),
]
FORMAT_PATTERNS = [("1L", r"1\s*l"), ("33cl", r"33\s*cl")]
LEADING_TIMES = r"^\s*([0-9]+)\s*x\s*[a-z]"
TRAILING_TIMES = r"x([0-9]+)$"
LEADING_NUMBER = r"^\s*([0-9]+)\s+"


def _first_match(segment: Column, patterns: list[tuple[str, str]]) -> Column:
    out = F.lit(None).cast("string")
    for value, pattern in reversed(patterns):
        out = F.when(segment.rlike(pattern), value).otherwise(out)
    return out


def _quantity(segment: Column) -> Column:
    # A multiplier too large for an int is NULL, it does not fall to the next layout.
    out = F.lit(1)
    for pattern in (LEADING_NUMBER, TRAILING_TIMES, LEADING_TIMES):
        number = F.regexp_extract(segment, pattern, 1).try_cast("int")
        out = F.when(segment.rlike(pattern), number).otherwise(out)
    return out


def split_order_items(text: Column) -> Column:
    """Array of item segments; NULL text gives NULL, so exploding it gives no row."""
    low = F.lower(collapse_spaces(F.regexp_replace(text, r"\([^)]*\)", "")))
    plus = F.regexp_replace(low, r"\s+et\s+", "+")
    return F.transform(F.split(plus, r"\+"), lambda s: F.trim(s))


def parse_order_item(segment: Column) -> Column:
    """Struct of segment, product, format, quantity, parse_status, parse_failed."""
    product = _first_match(segment, PRODUCT_PATTERNS)
    size = _first_match(segment, FORMAT_PATTERNS)
    return F.struct(
        segment.alias("segment"),
        product.alias("product"),
        size.alias("format"),
        _quantity(segment).alias("quantity"),
        F.when(product.isNull(), "unknown_product")
        .when(size.isNull(), "missing_format")
        .otherwise("parsed")
        .alias("parse_status"),
        product.isNull().alias("parse_failed"),
    )


def with_items(orders: DataFrame) -> DataFrame:
    """Orders with an ``items`` array of parsed lines; orders without text drop out."""
    segments = split_order_items(F.col("items_text"))
    return orders.where(F.col("items_text").isNotNull()).withColumn(
        "items", F.transform(segments, parse_order_item)
    )


def order_items(orders: DataFrame) -> DataFrame:
    """One row per item line, parsed after the explode where the expressions compile."""
    lines = orders.where(F.col("items_text").isNotNull()).select(
        "row_id",
        "order_ref",
        "received_at",
        "customer_phone",
        "items_text",
        "amount_fcfa",
        "status",
        "delivery_zone",
        F.explode(split_order_items(F.col("items_text"))).alias("line"),
    )
    parsed = lines.withColumn("item", parse_order_item(F.col("line"))).drop("line")
    return parsed.select(*[c for c in parsed.columns if c != "item"], "item.*")


def _units(field: str | None = None, value: str | None = None) -> Column:
    """Sum of quantities over the lines, or over those whose field has the value."""
    lines = F.col("items")
    if field is not None:
        lines = F.filter(lines, lambda i: i[field] == value)
    return F.aggregate(
        lines,
        F.lit(0).cast("long"),
        lambda total, item: total + F.coalesce(item["quantity"], F.lit(0)),
    )


def _lines(status: str) -> Column:
    return F.size(F.filter("items", lambda i: i["parse_status"] == status)).cast("long")


def order_quality(orders: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per order that has text: amount plausibility and parse quality."""
    amount, limit = F.col("amount_fcfa"), F.lit(float(params.max_plausible_amount))
    counted = with_items(orders).select(
        "row_id",
        "order_ref",
        "received_at",
        "amount_fcfa",
        "status",
        "month",
        amount.isNull().alias("amount_missing"),
        F.coalesce(amount > limit, F.lit(False)).alias("amount_outlier"),
        F.when(amount <= limit, amount).alias("amount_plausible_fcfa"),
        F.size("items").cast("long").alias("item_line_count"),
        _lines("parsed").alias("parsed_item_lines"),
        _lines("unknown_product").alias("unresolved_item_lines"),
        _lines("missing_format").alias("missing_format_lines"),
        _units().alias("quantity_total"),
        *[_units("product", p).alias(f"{p}_units") for p, _ in PRODUCT_PATTERNS],
        _units("format", "1L").alias("format_1l_units"),
        _units("format", "33cl").alias("format_33cl_units"),
    )
    lines, parsed = F.col("item_line_count"), F.col("parsed_item_lines")
    unresolved, unsized = F.col("unresolved_item_lines"), F.col("missing_format_lines")
    return counted.select(
        "*",
        (unresolved > 0).alias("has_unknown_product"),
        (unsized > 0).alias("has_missing_format"),
        F.when(parsed == lines, "fully_parsed")
        .when((parsed > 0) & (unresolved > 0), "partially_parsed")
        .when(unsized == lines, "missing_format_only")
        .otherwise("unresolved")
        .alias("order_parse_status"),
    )
