"""Conformed tables: calendar, stores, products, media reconciliation, labelled comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions import dates, labels, money


SALES_SUMS = [
    "units_sold", "revenue_fcfa", "net_revenue_fcfa", "gross_units", "return_units",
    "gross_revenue_fcfa", "return_revenue_fcfa",
]


def sales_daily(sales: DataFrame) -> DataFrame:
    """Sales lines summed to (day, store, spelling, commune, SKU), under the lines' own names.

    Sums add up further and distinct stores, spellings, communes, days and SKUs are all there, so
    the calendar, the product dimension and the monthly sales tables read this instead of the lines.
    """
    return sales.groupBy("sale_date", "pos_key", "pos_name", "commune", "product_sku").agg(
        F.count("*").alias("line_count"), *[F.sum(c).alias(c) for c in SALES_SUMS]
    )


def sales_calendar(sales: DataFrame) -> DataFrame:
    """One row per day from the first month's first day to the last month's last day."""
    observed = sales.groupBy("sale_date").agg(F.count("*").alias("n"))
    bounds = observed.agg(
        dates.month_floor(F.min("sale_date")).alias("first_day"),
        F.last_day(F.max("sale_date")).alias("final_day"),
    )
    days = bounds.select(F.explode(F.sequence("first_day", "final_day")).alias("sale_date"))
    return days.join(observed, "sale_date", "left").select(
        "sale_date",
        dates.month_floor(F.col("sale_date")).alias("month"),
        dates.week_floor(F.col("sale_date")).alias("week_start"),
        F.col("n").isNotNull().alias("has_sales_data"),
        F.col("n").isNull().alias("is_missing_sales_day"),
    )


def pos_dimension(sales: DataFrame) -> DataFrame:
    """One row per store key with its ids in the order they first sold.

    Aggregated per (store, id) first, so the ordered list only ever holds distinct ids.
    Ids that first sold on the same day are ordered by id.
    """
    per_id = sales.groupBy("pos_key", "pos_id").agg(
        F.min("pos_name_raw").alias("pos_name_raw"),
        F.min("commune").alias("commune"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )
    rank = F.struct("first_sale_date", "pos_id")
    return per_id.groupBy("pos_key").agg(
        F.min_by("pos_id", rank).alias("canonical_pos_id"),
        F.min_by("pos_name_raw", rank).alias("canonical_pos_name"),
        F.min("commune").alias("commune"),
        F.count("*").alias("pos_id_count"),
        F.transform(F.array_sort(F.collect_list(rank)), lambda x: x["pos_id"]).alias("pos_ids"),
        (F.count("*") > 1).alias("pos_id_changed"),
        F.min("first_sale_date").alias("first_sale_date"),
        F.max("last_sale_date").alias("last_sale_date"),
    )


def product_dimension(sales: DataFrame) -> DataFrame:
    """One row per SKU; unknown prefixes or formats stay NULL."""
    prefix = F.upper(F.split_part("product_sku", F.lit("-"), F.lit(1)))
    suffix = F.upper(F.split_part("product_sku", F.lit("-"), F.lit(2)))

    def lookup(key: Column, values: dict) -> Column:
        out = F.lit(None)
        for code, value in values.items():
            out = F.when(key == code, F.lit(value)).otherwise(out)
        return out

    skus = sales.where(F.col("product_sku").isNotNull()).select("product_sku").distinct()
    return skus.select(
        "product_sku",
        lookup(prefix, labels.SKU_PRODUCTS).alias("product"),
        lookup(suffix, {k: v[0] for k, v in labels.SKU_FORMATS.items()}).alias("format"),
        lookup(suffix, {k: v[1] for k, v in labels.SKU_FORMATS.items()}).alias("volume_litres"),
    )


def campaign_totals(campaigns: DataFrame) -> DataFrame:
    """Spend side of the reconciliation: month x channel."""
    return campaigns.groupBy("month", "channel").agg(
        F.sum("spend_fcfa").alias("campaign_spend_fcfa"),
        F.sum("campaign_rows").alias("campaign_rows"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
    )


def campaign_rollup(attributes: DataFrame) -> DataFrame:
    """Campaign lines at (date month, name month, channel).

    Both month-level views of the export, by date and by name, roll up from this small
    table, so the export is deduplicated and scanned once.
    """
    return attributes.groupBy("month", "campaign_month", "channel").agg(
        F.sum("spend_fcfa").alias("spend_fcfa"),
        F.count("*").alias("campaign_rows"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        *[
            F.count_if(F.col("product") == p).alias(f"{p}_campaigns") for p in labels.PRODUCTS
        ],
        F.count_if(F.col("product").isNull()).alias("campaigns_without_product"),
        F.count_if("product_parse_failed").alias("product_parse_failure_count"),
        F.count_if("campaign_month_parse_failed").alias("month_parse_failure_count"),
    )


def plan_totals(plan: DataFrame) -> DataFrame:
    """Plan side of the reconciliation: month x channel."""
    return plan.groupBy(F.col("month_date").alias("month"), "channel").agg(
        F.sum("planned_budget_fcfa").alias("planned_budget_fcfa"),
        F.sum("invoiced_fcfa").alias("invoiced_fcfa"),
        F.sum("invoiced_available").alias("invoiced_rows"),
        F.count("*").alias("media_plan_rows"),
    )


def source_coverage(in_export: Column, in_plan: Column, invoiced: Column) -> Column:
    billed = invoiced.isNotNull()
    return (
        F.when(in_export & in_plan & billed, "both_available")
        .when(in_export & in_plan, "both_sources_invoice_missing")
        .when(in_export, "campaign_only")
        .when(in_plan & billed, "media_plan_only")
        .when(in_plan, "media_plan_only_invoice_missing")
        .otherwise("neither_available")
    )


def media_reconciliation(spend: DataFrame, plan: DataFrame) -> DataFrame:
    """Full outer join of the two aggregates; rows of either side alone are kept."""
    keys = ["month", "channel"]
    present = F.lit(True)
    joined = spend.withColumn("in_export", present).join(
        plan.withColumn("in_plan", present), keys, "full"
    )
    cost, invoiced = F.col("campaign_spend_fcfa"), F.col("invoiced_fcfa")
    return joined.select(
        *keys,
        "campaign_spend_fcfa",
        "campaign_rows",
        "impressions",
        "clicks",
        "planned_budget_fcfa",
        "invoiced_fcfa",
        "invoiced_rows",
        "media_plan_rows",
        source_coverage(
            F.col("in_export").isNotNull(), F.col("in_plan").isNotNull(), invoiced
        ).alias("source_coverage"),
        (cost - invoiced).alias("campaign_vs_invoiced_variance_fcfa"),
        money.ratio(cost, invoiced).alias("campaign_to_invoiced_ratio"),
    )


COMMENT_COLUMNS = [
    "comment_id", "platform", "published_at", "author_handle", "comment_text", "like_count", "reply_to_id",
]
LABEL_COLUMNS = [
    "language_model", "sentiment_model", "theme_model", "product_model", "is_spam_model", "model_used",
    "rules_complete",
]


def comments_enriched(comments: DataFrame, predictions: DataFrame) -> DataFrame:
    """Comments with their labels; a comment nobody scored keeps NULL labels."""
    labels_by_id = predictions.select("comment_id", *LABEL_COLUMNS)
    return comments.select(*COMMENT_COLUMNS).join(labels_by_id, "comment_id", "left")
