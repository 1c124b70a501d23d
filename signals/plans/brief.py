"""The monthly brief and the page-level figures, for every month at once.

Each section is one DataFrame keyed by month; a reader filters the month wanted. Figures
that are percentages of reported values are rounded to one decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from signals.functions.money import percent, ratio, round_half_up
from signals.operators.trends import top_labels, wide_to_long
from signals.plans.marts import PRODUCT_COLUMNS, SENTIMENT_COLUMNS, THEME_COLUMNS

# Codes of the brief's points.
ATTENTION = ["revenue_down", "sales_days_missing", "negative_over_positive", "amounts_missing"]
POSITIVE = ["revenue_up", "positive_over_negative"]


def brief_sales(performance: DataFrame) -> DataFrame:
    """Month revenue against the latest earlier month present, with its coverage."""
    point = F.struct("month", "net_revenue_fcfa")
    series = performance.agg(F.array_sort(F.collect_list(point)).alias("s"))
    previous = series.select(F.posexplode("s").alias("i", "r"), "s").select(
        F.col("r.month").alias("month"),
        F.when(F.col("i") > 0, F.get("s", F.col("i") - 1)).alias("p"),
    )
    now, before = F.col("net_revenue_fcfa"), F.col("p.net_revenue_fcfa")
    growth = round_half_up(ratio(now - before, before) * 100, 1)
    return (
        performance.join(previous, "month")
        .withColumn("revenue_growth_pct", growth)
        .select(
            "month",
            F.col("net_revenue_fcfa").alias("revenue_fcfa"),
            F.col("p.month").alias("previous_month"),
            before.alias("previous_revenue_fcfa"),
            "revenue_growth_pct",
            F.when(F.col("revenue_growth_pct") > 0, "up")
            .when(F.col("revenue_growth_pct") < 0, "down")
            .when(F.col("revenue_growth_pct") == 0, "flat")
            .otherwise("unknown")
            .alias("revenue_direction"),
            "net_units_sold",
            "active_pos",
            "active_communes",
            "observed_sales_days",
            "calendar_days",
            "missing_sales_days",
            "return_rate_revenue",
        )
    )


def brief_channels(marketing: DataFrame) -> DataFrame:
    """Channels of each month by spend, with share, plan, invoice and coverage.

    A missing invoice stays missing. ``spend_position`` 1 is the month's top channel.
    """
    totals = marketing.groupBy("month").agg(F.sum("campaign_spend_fcfa").alias("month_spend"))
    order = W.partitionBy("month").orderBy(F.desc("campaign_spend_fcfa"), "channel")
    return marketing.join(totals, "month").select(
        "month",
        "channel",
        F.col("campaign_spend_fcfa").alias("spend_fcfa"),
        F.when(
            F.col("month_spend") > 0, percent(F.col("campaign_spend_fcfa"), F.col("month_spend"))
        ).alias("share_pct"),
        "planned_budget_fcfa",
        "invoiced_fcfa",
        F.col("campaign_vs_invoiced_variance_fcfa").alias("variance_fcfa"),
        "source_coverage",
        F.row_number().over(order).alias("spend_position"),
    )


def voice_sums(social: DataFrame) -> DataFrame:
    counts = [
        "comments_count", "unique_comments_count", "spam_comments_count",
        *SENTIMENT_COLUMNS.values(), *THEME_COLUMNS.values(),
    ]
    return social.groupBy("month").agg(*[F.sum(c).alias(c) for c in counts])


def brief_voice(social: DataFrame) -> DataFrame:
    """Month: comment counts, majority sentiment and sentiment shares."""
    good, bad, flat = (F.col(c) for c in SENTIMENT_COLUMNS.values())
    total = good + bad + flat
    # The first in this order wins a tie.
    majority = (
        F.when(total <= 0, "unknown")
        .when((good >= bad) & (good >= flat), "positive")
        .when(bad >= flat, "negative")
        .otherwise("neutral")
    )
    return voice_sums(social).select(
        "month",
        "comments_count",
        "unique_comments_count",
        "spam_comments_count",
        *SENTIMENT_COLUMNS.values(),
        majority.alias("sentiment_majority"),
        *[
            percent(F.col(c), total).alias(f"{s}_share_pct") for s, c in SENTIMENT_COLUMNS.items()
        ],
    )


def brief_themes(social: DataFrame) -> DataFrame:
    """Top three themes of each month; ties keep the declared theme order."""
    declared = [
        "taste", "price", "promotion", "availability", "packaging", "health", "delivery",
        "service", "product_question", "other",
    ]
    return top_labels(voice_sums(social), {t: THEME_COLUMNS[t] for t in declared}, 3, "month")


def top_named_themes(social: DataFrame) -> DataFrame:
    """Top three named themes over the whole input with their share of usable comments."""
    named = {t: c for t, c in THEME_COLUMNS.items() if t != "other"}
    sums = social.agg(
        *[F.sum(c).alias(c) for c in named.values()],
        F.sum("non_spam_comments_count").alias("usable"),
    )
    usable = sums.select("usable").scalar()
    return top_labels(sums, named, 3).withColumn("share", F.try_divide("comments", usable))


def brief_products(mix: DataFrame, n: int = 5) -> DataFrame:
    """Top SKUs of each month by net revenue; position 1 is the top product."""
    order = W.partitionBy("month").orderBy(F.desc("net_revenue_fcfa"), "product_sku")
    return (
        mix.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= n)
        .select(
            "month",
            "position",
            "product",
            "format",
            "product_sku",
            "net_units",
            "net_revenue_fcfa",
            round_half_up(F.coalesce("revenue_share_of_month", F.lit(0.0)) * 100, 1).alias(
                "revenue_share_pct"
            ),
        )
    )


def brief_chat_orders(chat: DataFrame) -> DataFrame:
    return chat.select(
        "month",
        "orders",
        "delivered_orders",
        "cancelled_orders",
        "pending_orders",
        "total_units",
        "bissap_units",
        "gingembre_units",
        "bouye_units",
        "delivered_known_amount_fcfa",
        "delivered_amount_missing_orders",
        "delivered_outlier_amount_orders",
    )


def brief_points(sales: DataFrame, voice: DataFrame, chat: DataFrame) -> DataFrame:
    """(month, kind, point) codes that hold for each sales month."""
    good, bad = F.col("positive_comments_count"), F.col("negative_comments_count")
    growth = F.col("revenue_growth_pct")
    holds = {
        "revenue_down": growth < 0,
        "sales_days_missing": F.col("missing_sales_days") > 0,
        "negative_over_positive": bad > good,
        "amounts_missing": F.col("delivered_amount_missing_orders") > 0,
        "revenue_up": growth > 0,
        "positive_over_negative": good > bad,
    }

    def codes(names: list[str], kind: str) -> list[Column]:
        return [
            F.when(holds[n], F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("point")))
            for n in names
        ]

    points = F.array_compact(
        F.array(*codes(ATTENTION, "attention"), *codes(POSITIVE, "positive"))
    )
    return (
        sales.join(voice.select("month", good, bad), "month", "left")
        .join(chat.select("month", "delivered_amount_missing_orders"), "month", "left")
        .select("month", F.inline(points))
    )


def period_kpis(performance: DataFrame) -> DataFrame:
    """Totals over the months given, and how many are incomplete or of unknown coverage."""
    missing = F.col("missing_sales_days")
    return performance.agg(
        F.count("*").alias("months"),
        F.sum("net_revenue_fcfa").alias("net_revenue_fcfa"),
        F.sum("net_units_sold").alias("net_units_sold"),
        F.sum("campaign_spend_fcfa").alias("campaign_spend_fcfa"),
        F.count_if(missing > 0).alias("incomplete_months"),
        F.count_if(missing.isNull()).alias("unknown_months"),
    )


def incomplete_months(performance: DataFrame) -> DataFrame:
    missing = F.col("missing_sales_days")
    return performance.where(missing.isNull() | (missing > 0)).select(
        "month", F.when(missing.isNull(), "unknown").otherwise("incomplete").alias("coverage")
    )


def coverage_by_month(sales: DataFrame) -> DataFrame:
    return sales.select(
        "month",
        "observed_sales_days",
        "calendar_days",
        percent(F.col("observed_sales_days"), F.col("calendar_days")).alias("coverage_pct"),
    )


def mix_by_product_format(mix: DataFrame) -> DataFrame:
    """Product x format over the period: units, revenue, litres, share, price per litre."""
    total = mix.agg(F.sum("net_revenue_fcfa")).scalar()
    rows = mix.groupBy("product", "format").agg(
        F.sum("net_units").alias("net_units"),
        F.sum("net_revenue_fcfa").alias("net_revenue_fcfa"),
        F.sum("net_litres").alias("net_litres"),
    )
    return rows.select(
        "product",
        "format",
        "net_units",
        "net_revenue_fcfa",
        round_half_up(F.col("net_litres"), 2).alias("net_litres"),
        ratio(F.col("net_revenue_fcfa"), total).alias("revenue_share"),
        round_half_up(ratio(F.col("net_revenue_fcfa"), F.col("net_litres")), 2).alias(
            "net_revenue_per_litre_fcfa"
        ),
    )


def mix_by_month_product(mix: DataFrame) -> DataFrame:
    return mix.groupBy("month", "product").agg(F.sum("net_revenue_fcfa").alias("net_revenue_fcfa"))


def channel_gap_flag(allocation: DataFrame) -> DataFrame:
    """Channels billed without any logged spend, and spend against the largest."""
    largest = allocation.agg(F.max("campaign_spend_fcfa")).scalar()
    cost = F.col("campaign_spend_fcfa")
    return allocation.select(
        "channel",
        cost,
        "invoiced_fcfa",
        ((cost == 0) & (F.col("invoiced_fcfa") > 0)).alias("billed_without_spend"),
        ratio(cost, F.when(largest != 0, largest).otherwise(1.0)).alias("spend_vs_largest"),
    )


def repeat_customers(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count_if("has_delivered_order").alias("delivered_customers"),
        F.count_if("is_repeat_customer").alias("repeat_customers"),
    )


def spend_kpis(allocation: DataFrame) -> DataFrame:
    return allocation.agg(
        F.sum("campaign_spend_fcfa").alias("campaign_spend_fcfa"),
        F.sum("planned_budget_fcfa").alias("planned_budget_fcfa"),
        F.sum("invoiced_fcfa").alias("invoiced_fcfa"),
    ).select("*", ratio(F.col("campaign_spend_fcfa"), F.col("planned_budget_fcfa")).alias(
        "spend_vs_plan"
    ))


def voice_totals(social: DataFrame) -> DataFrame:
    """(label, comments) totals of sentiment, theme, product and rule or model use."""
    columns = [
        *SENTIMENT_COLUMNS.values(), *THEME_COLUMNS.values(), *PRODUCT_COLUMNS.values(),
        "rules_complete_count", "model_used_count",
    ]
    return wide_to_long(social, columns, "label", "comments")
