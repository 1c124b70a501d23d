"""Known faults planted in sources and tables, so that every check can be seen to find something.

Each function takes a good frame and returns it with one kind of fault in it. Source faults add
rows; table faults change a table that was built right, as a wrong job would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARED_NAME = "Kiosque du coin"
DOUBLE_COUNT = "2 bissap 1L x3"


def shared_store_names(sales: DataFrame) -> DataFrame:
    """Lines of many stores once more under one and the same store name."""
    again = sales.where("units_sold = 13").withColumn("pos_name", F.lit(SHARED_NAME))
    return sales.unionByName(again)


def double_multipliers(orders: DataFrame) -> DataFrame:
    """Orders without an amount once more, with two quantities written in one item."""
    again = orders.where("amount_fcfa is null").withColumn("items_text", F.lit(DOUBLE_COUNT))
    return orders.unionByName(again)


def short_calendar(calendar: DataFrame) -> DataFrame:
    """The first and the last day are missing."""
    first, last = (calendar.agg(f("sale_date")).scalar() for f in (F.min, F.max))
    return calendar.where((F.col("sale_date") != first) & (F.col("sale_date") != last))


def wrong_flags(calendar: DataFrame) -> DataFrame:
    """The first of each month says the opposite."""
    first = F.dayofmonth("sale_date") == 1
    return calendar.withColumn(
        "is_missing_sales_day",
        F.when(first, ~F.col("is_missing_sales_day")).otherwise(F.col("is_missing_sales_day")),
    )


def heavy_mix(mix: DataFrame) -> DataFrame:
    """One product counts a unit too many."""
    return mix.withColumn(
        "net_units", F.col("net_units") + F.when(F.col("product") == "bissap", 1).otherwise(0)
    )


def drifted_amounts(chat: DataFrame) -> DataFrame:
    """Amounts of even months are off by one."""
    odd = F.month("month") % 2
    return chat.withColumn("known_order_amount_fcfa", F.col("known_order_amount_fcfa") + 1 - odd)


def raised_budget(recommendation: DataFrame) -> DataFrame:
    """One channel gets more than the total allows."""
    more = F.when(F.col("channel") == "Meta", 1000.0).otherwise(0.0)
    return recommendation.withColumn("proposed_budget_fcfa", F.col("proposed_budget_fcfa") + more)


def lost_channels(recommendation: DataFrame) -> DataFrame:
    return recommendation.where(~F.col("channel").isin("Radio", "TikTok"))


#: Faults by the source or table they are planted in.
SOURCE_FAULTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "pos_sales_daily": shared_store_names,
    "whatsapp_orders": double_multipliers,
}
TABLE_FAULTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sales_calendar": lambda df: wrong_flags(short_calendar(df)),
    "product_mix_monthly": heavy_mix,
    "chat_orders_monthly": drifted_amounts,
    "budget_recommendation": lambda df: lost_channels(raised_budget(df)),
}


def damaged(tables: Callable[[str], DataFrame]) -> Callable[[str], DataFrame]:
    """`tables` with the table faults in them."""

    def read(name: str) -> DataFrame:
        return TABLE_FAULTS.get(name, lambda df: df)(tables(name))

    return read
