"""Cleaning projections: one source in, one typed and flagged table out.

Raw text stays next to the parsed value, a value that cannot be read is NULL and flagged,
and nothing missing becomes zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signals.functions import dates, labels, money, text
from signals.operators.dedupe import (
    drop_exact_duplicates,
    drop_exact_duplicates_flagged,
    flag_repeated_key,
)
from signals.operators.identity import COPIES, counted_copies, numbered, row_digest
from signals.params import Params


def clean_campaigns(raw: DataFrame, params: Params = Params()) -> DataFrame:
    trimmed = drop_exact_duplicates(raw).select(
        labels.canon_platform(F.col("platform")).alias("platform"),
        F.trim("platform").alias("platform_raw"),
        F.trim("campaign_name").alias("campaign_name"),
        F.trim("campaign_name").alias("campaign_name_raw"),
        dates.parse_mixed_date(F.col("date_start")).alias("date_start"),
        dates.parse_mixed_date(F.col("date_end")).alias("date_end"),
        F.trim("date_start").alias("date_start_raw"),
        F.trim("date_end").alias("date_end_raw"),
        F.trim("spend").alias("spend_raw"),
        money.detect_currency(F.col("spend")).alias("spend_currency"),
        money.parse_money(F.col("spend")).alias("spend_amount"),
        "impressions",
        "clicks",
        F.trim("objective").alias("objective_raw"),
        labels.canon_objective(F.col("objective")).alias("objective_normalized"),
    )
    start, end = F.col("date_start"), F.col("date_end")
    amount, currency = F.col("spend_amount"), F.col("spend_currency")
    return trimmed.select(
        "*",
        dates.month_floor(start).alias("month"),
        money.fx_rate(currency, params.eur_rate).alias("fx_rate_to_fcfa"),
        money.convert_fx(amount, currency, params.eur_rate).alias("spend_fcfa"),
        start.isNull().alias("date_start_parse_failed"),
        end.isNull().alias("date_end_parse_failed"),
        amount.isNull().alias("spend_parse_failed"),
        F.coalesce(start > end, F.lit(False)).alias("invalid_date_range"),
        (currency == "EUR").alias("converted_from_eur"),
        F.col("impressions").isNull().alias("impressions_missing"),
        F.col("clicks").isNull().alias("clicks_missing"),
    )


def clean_media_plan(raw: DataFrame) -> DataFrame:
    planned, invoiced = F.col("planned_budget_fcfa"), F.col("invoiced_fcfa")
    return raw.select(
        F.trim("plan_id").alias("plan_id"),
        F.trim("month").alias("month_raw"),
        dates.parse_french_month(F.col("month")).alias("month_date"),
        F.trim("channel").alias("channel_raw"),
        labels.canon_channel(F.col("channel")).alias("channel"),
        planned,
        invoiced,
        # NULL when either side is missing: an absent invoice is not a zero invoice.
        (invoiced - planned).alias("variance_fcfa"),
        invoiced.isNotNull().cast("int").alias("invoiced_available"),
        invoiced.isNull().alias("invoiced_missing"),
        text.blank_to_null(F.col("objective")).alias("objective"),
        text.blank_to_null(F.col("owner")).alias("owner"),
        text.blank_to_null(F.col("notes")).alias("notes"),
    ).select(
        "*",
        F.col("month_date").isNull().alias("month_parse_failed"),
        planned.isNull().alias("planned_budget_missing"),
        (planned < 0).alias("invalid_planned_budget"),
    )


def clean_pos_sales(raw: DataFrame) -> DataFrame:
    """Point-of-sale lines. Identical lines are separate sales, so nothing is dropped."""
    units, revenue, zero = F.col("units_sold"), F.col("revenue_fcfa"), F.lit(0)
    return raw.select(
        F.col("sale_date").cast("date").alias("sale_date"),
        F.trim("pos_id").alias("pos_id"),
        F.trim("pos_name").alias("pos_name_raw"),
        F.trim("pos_name").alias("pos_name"),
        text.entity_key(F.col("pos_name")).alias("pos_key"),
        F.trim("commune").alias("commune_raw"),
        labels.canon_commune(F.col("commune")).alias("commune"),
        F.trim("channel").alias("channel_raw"),
        labels.canon_sales_channel(F.col("channel")).alias("channel"),
        F.trim("product_sku").alias("product_sku"),
        units,
        revenue,
        ((units < 0) | (revenue < 0)).alias("is_return"),
        # greatest/least skip NULL, so an unknown amount counts on neither side.
        F.greatest(units, zero).alias("gross_units"),
        F.least(units, zero).alias("return_units"),
        F.greatest(revenue, F.lit(0.0)).alias("gross_revenue_fcfa"),
        F.least(revenue, F.lit(0.0)).alias("return_revenue_fcfa"),
        F.coalesce(revenue, F.lit(0.0)).alias("net_revenue_fcfa"),
    )


def clean_comments(raw: DataFrame) -> DataFrame:
    body = F.trim("comment_text")
    return drop_exact_duplicates_flagged(raw).select(
        F.trim("comment_id").alias("comment_id"),
        F.trim("post_id").alias("post_id"),
        F.trim("author_handle").alias("author_handle"),
        F.trim("platform").alias("platform_raw"),
        labels.canon_social_platform(F.col("platform")).alias("platform"),
        "published_at",
        F.to_date("published_at").alias("published_date"),
        dates.month_floor(F.to_date("published_at")).alias("month"),
        body.alias("comment_text"),
        F.length(body).alias("comment_length"),
        "like_count",
        "reply_to_id",
        F.col("reply_to_id").isNotNull().alias("is_reply"),
        "was_exact_duplicate",
        (body == "").alias("is_empty_comment"),
    )


def clean_chat_orders(raw: DataFrame) -> DataFrame:
    """Free-text delivery orders, each with a reproducible ``row_id``.

    Exact copies are counted first; both the ids and the flag of repeated references come from
    that one table, so the source is read and shuffled whole once.
    """
    flagged = flag_repeated_key(counted_copies(raw), "order_ref", "order_ref_repeated", weight=COPIES)
    # After the join, which would shuffle the digests, and those shrink the least.
    digested = flagged.withColumn("_digest", row_digest(raw))
    phone = text.normalize_phone(F.col("customer_phone"))
    return numbered(digested, "_digest", "row_id").select(
        "row_id",
        F.trim("order_ref").alias("order_ref"),
        "order_ref_repeated",
        F.trim("received_at").alias("received_at_raw"),
        dates.parse_mixed_timestamp(F.col("received_at")).alias("received_at"),
        F.trim("customer_phone").alias("customer_phone_raw"),
        phone.alias("customer_phone"),
        text.blank_to_null(F.col("items_text")).alias("items_text"),
        "amount_fcfa",
        F.col("amount_fcfa").isNull().alias("amount_missing"),
        F.trim("delivery_zone").alias("delivery_zone_raw"),
        text.trimmed_lower(F.col("delivery_zone")).alias("delivery_zone"),
        F.trim("status").alias("status_raw"),
        labels.canon_status(F.col("status")).alias("status"),
    ).select(
        "*",
        F.to_date("received_at").alias("order_date"),
        dates.month_floor(F.to_date("received_at")).alias("month"),
        F.col("received_at").isNull().alias("received_at_parse_failed"),
        F.col("customer_phone").isNull().alias("phone_parse_failed"),
    )


# Month spellings accepted in a campaign name. The first six months match
# loosely anywhere in the name and are tried first, in this order; then every month is
# tried as a whole word with an optional two-digit year.
LOOSE_MONTHS = [
    (1, ["jan"]),
    (2, ["février", "fev"]),
    (3, ["mars"]),
    (4, ["avr"]),
    (5, ["mai"]),
    (6, ["juin", "jun"]),
]
WHOLE_WORD_MONTHS = [
    (3, "mar"),
    (7, "juillet|juil|jul"),
    (8, "août|aout|aou"),
    (9, "septembre|sept|sep"),
    (10, "octobre|oct"),
    (11, "novembre|nov"),
    (12, "décembre|decembre|dec"),
]


def campaign_attributes(campaigns: DataFrame) -> DataFrame:
    """Product and month read from the campaign name; the year comes from date_start."""
    name = F.col("campaign_name_search")
    product = F.lit(None).cast("string")
    for word in reversed(labels.PRODUCTS):
        product = F.when(name.contains(word), word).otherwise(product)
    number = F.lit(None).cast("int")
    for n, words in reversed(WHOLE_WORD_MONTHS):
        number = F.when(name.rlike(f"(^| )({words})([0-9]{{2}})?($| )"), n).otherwise(number)
    for n, words in reversed(LOOSE_MONTHS):
        hit = name.contains(words[0])
        for word in words[1:]:
            hit = hit | name.contains(word)
        number = F.when(hit, n).otherwise(number)
    named = campaigns.withColumn(
        "campaign_name_search",
        F.lower(F.regexp_replace("campaign_name", "[^a-zA-Z0-9À-ÿ]+", " ")),
    ).select("*", product.alias("product"), number.alias("campaign_month_number"))
    return named.select(
        "month",
        F.col("platform").alias("channel"),
        "campaign_name",
        "campaign_name_raw",
        "date_start",
        "date_end",
        "product",
        # make_date of NULL parts is NULL; the day and month are always valid.
        F.make_date(F.year("date_start"), F.col("campaign_month_number"), F.lit(1)).alias(
            "campaign_month"
        ),
        F.col("objective_normalized").alias("objective"),
        "spend_fcfa",
        "impressions",
        "clicks",
    ).select(
        "*",
        F.when(F.col("product").isNotNull(), "parsed")
        .otherwise("not_found")
        .alias("product_parse_status"),
        F.when(F.col("campaign_month").isNotNull(), "parsed")
        .otherwise("not_found")
        .alias("campaign_month_parse_status"),
        F.col("product").isNull().alias("product_parse_failed"),
        F.col("campaign_month").isNull().alias("campaign_month_parse_failed"),
    )
