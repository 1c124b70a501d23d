"""Data-quality checks. A check counts violating rows; zero means it passed.

All row-level checks of one table, and the uniqueness of its key, are counted in a single pass
over it. Checks that compare rows or tables return their violating rows as a DataFrame and are
counted on their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signals.params import Params
from signals.sources.io import stage, stage_union, union_all

Tables = Callable[[str], DataFrame]


def _not_null(*columns: str) -> dict[str, str]:
    return {f"not_null_{c}": f"{c} is null" for c in columns}


def _share(*columns: str) -> dict[str, str]:
    return {f"range_{c}": f"{c} < 0 or {c} > 1" for c in columns}


def _non_negative(*columns: str) -> dict[str, str]:
    return {f"non_negative_{c}": f"{c} < 0" for c in columns}


_KNOWN_PRODUCTS = "('bissap', 'gingembre', 'bouye')"
_LEADING_TIMES = r"'^\\s*([0-9]+)\\s*x'"
_LEADING_NUMBER = r"'^\\s*([0-9]+)\\s+'"


def row_checks(params: Params = Params()) -> dict[str, dict[str, str]]:
    """table -> check -> condition that holds on a violating row."""
    limit = f"{params.max_plausible_amount}D"
    return {
        "clean_campaigns": {
            **_not_null("platform", "campaign_name", "date_start", "date_end", "spend_fcfa",
                        "objective_normalized"),
            "parsed_dates": "date_start is null or date_end is null",
        },
        "clean_media_plan": {
            **_not_null("plan_id", "month_date", "channel", "planned_budget_fcfa"),
            **_non_negative("planned_budget_fcfa"),
            "identity_variance": "invoiced_fcfa is not null and "
            "variance_fcfa <> invoiced_fcfa - planned_budget_fcfa",
        },
        "clean_pos_sales": {
            **_not_null("sale_date", "pos_id", "commune", "channel", "product_sku",
                        "units_sold", "revenue_fcfa", "net_revenue_fcfa"),
            **_non_negative("gross_units"),
            "non_positive_return_units": "return_units > 0",
            "identity_net": "net_revenue_fcfa <> gross_revenue_fcfa + return_revenue_fcfa "
            "or units_sold <> gross_units + return_units",
        },
        "clean_chat_orders": {
            **_not_null("row_id", "order_ref", "received_at", "customer_phone", "items_text", "status"),
            "accepted_status": "status not in ('delivered', 'cancelled', 'pending')",
        },
        "clean_comments": {
            **_not_null("comment_id", "platform", "published_at", "comment_text", "like_count"),
            **_non_negative("like_count"),
            "no_empty_text": "is_empty_comment",
        },
        "campaign_attributes": {
            **_not_null("month", "channel", "campaign_name"),
            "accepted_product": f"product not in {_KNOWN_PRODUCTS}",
            "name_month_is_date_month": "campaign_month <> month",
        },
        "media_reconciliation": {
            **_not_null("month", "channel"),
            "identity_ratio": "source_coverage = 'both_available' and invoiced_fcfa <> 0 "
            "and campaign_to_invoiced_ratio is null",
            "identity_variance": "source_coverage = 'both_available' "
            "and campaign_vs_invoiced_variance_fcfa is null",
        },
        "sales_calendar": _not_null("sale_date"),
        "pos_dimension": _not_null("pos_key"),
        "product_dimension": {
            **_not_null("product_sku"),
            "mapped_sku": "product is null or format is null or volume_litres is null",
        },
        "order_items": {
            **_not_null("row_id", "order_ref", "quantity"),
            "accepted_format": "format not in ('1L', '33cl')",
            "accepted_product": f"product not in {_KNOWN_PRODUCTS}",
            "positive_quantity": "quantity <= 0",
            "written_multiplier": r"(segment rlike '^\\s*[0-9]+\\s*x\\s*[a-z]' and quantity <> "
            f"try_cast(regexp_extract(segment, {_LEADING_TIMES}, 1) as int)) or "
            r"(segment rlike '^\\s*[0-9]+\\s+(bissap|gingembre|bouye)' and quantity <> "
            f"try_cast(regexp_extract(segment, {_LEADING_NUMBER}, 1) as int))",
        },
        "order_quality": {
            **_not_null("row_id"),
            "plausible_amounts": "(amount_outlier and amount_plausible_fcfa is not null) "
            f"or amount_plausible_fcfa > {limit} or (amount_missing and amount_outlier) or "
            "(amount_fcfa is not null and not amount_outlier and amount_plausible_fcfa is null)",
        },
        "comments_enriched": {
            **_not_null("comment_id"),
            "complete_predictions": "language_model is null or sentiment_model is null "
            "or theme_model is null or product_model is null or is_spam_model is null",
        },
        "marketing_channel_monthly": _non_negative("campaign_spend_fcfa"),
        "channel_performance_monthly": _non_negative("campaign_spend_fcfa"),
        "sales_monthly": {**_not_null("month"), **_non_negative("net_revenue_fcfa")},
        "product_mix_monthly": _not_null("month", "product_sku"),
        "chat_orders_monthly": {"positive_orders": "orders <= 0"},
        "chat_customers": {
            **_not_null("customer_key"),
            "identity_flags": "order_count < 1 or delivered_order_count > order_count "
            "or has_delivered_order <> (delivered_order_count > 0) "
            "or is_repeat_customer <> (delivered_order_count > 1) "
            "or is_repeat_customer_any_status <> (order_count > 1)",
        },
        "social_monthly": {
            "themes_sum_to_usable": "non_spam_comments_count <> taste_comments_count "
            "+ price_comments_count + promotion_comments_count + availability_comments_count "
            "+ packaging_comments_count + health_comments_count + delivery_comments_count "
            "+ service_comments_count + product_question_comments_count "
            "+ other_theme_comments_count",
        },
        "budget_allocation": {
            **_non_negative("campaign_spend_fcfa", "clicks", "impressions"),
            **_share("spend_share", "planned_share"),
        },
        "channel_evidence": {
            **_non_negative("campaign_spend_fcfa", "clicks", "impressions"),
            **_share("spend_share"),
        },
        "channel_decision": {
            **_non_negative("campaign_spend_fcfa"),
            **_share("spend_share", "planned_share"),
        },
        "budget_recommendation": {
            "positive_budget": "proposed_budget_fcfa is null or proposed_budget_fcfa <= 0",
        },
    }


UNIQUE_KEYS = {
    "clean_comments": "comment_id",
    "sales_calendar": "sale_date",
    "comments_enriched": "comment_id",
    "pos_dimension": "pos_key",
    "product_dimension": "product_sku",
    "chat_customers": "customer_key",
    "order_quality": "row_id",
}


def count_violations(df: DataFrame, table: str, checks: Mapping[str, str]) -> DataFrame:
    """(check_name, table_name, violations) of every row check, in one pass."""
    counted = df.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in checks.items()])
    return counted.unpivot([], list(checks), "check_name", "violations").select(
        "check_name", F.lit(table).alias("table_name"), "violations"
    )


def count_all_violations(
    df: DataFrame, table: str, checks: Mapping[str, str], key: str | None = None
) -> DataFrame:
    """The same with the uniqueness of a key, all in one pass: rows are counted per key, with the
    violations of every check, and the keys that occur twice are counted over that."""
    if key is None:
        return count_violations(df, table, checks)
    per_key = df.groupBy(key).agg(
        F.count("*").alias("_rows"), *[F.count_if(F.expr(rule)).alias(name) for name, rule in checks.items()]
    )
    unique = f"unique_{key}"
    repeated = F.count_if(F.col(key).isNotNull() & (F.col("_rows") > 1)).alias(unique)
    counted = per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in checks], repeated
    )
    return counted.unpivot([], [*checks, unique], "check_name", "violations").select(
        "check_name", F.lit(table).alias("table_name"), "violations"
    )


def violating_rows(df: DataFrame, rule: str) -> DataFrame:
    return df.where(F.expr(rule))


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once (NULL is not a value)."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
    )


def assert_calendar_bounds(calendar: DataFrame, sales: DataFrame) -> DataFrame:
    """Sale dates outside the calendar, and bounds that are not whole months."""
    first, last = (calendar.agg(f("sale_date")).scalar() for f in (F.min, F.max))
    outside = (
        sales.select("sale_date")
        .where((F.col("sale_date") < first) | (F.col("sale_date") > last))
        .select(F.lit("sale_outside_calendar").alias("issue"), F.col("sale_date").alias("detail"))
    )
    bounds = calendar.agg(F.min("sale_date").alias("a"), F.max("sale_date").alias("b"))
    start = bounds.where(F.col("a") != F.trunc("a", "MM")).select(
        F.lit("not_month_start").alias("issue"), F.col("a").alias("detail")
    )
    end = bounds.where(F.col("b") != F.last_day("b")).select(
        F.lit("not_month_end").alias("issue"), F.col("b").alias("detail")
    )
    return union_all([outside, start, end])


def assert_calendar_flags(calendar: DataFrame, sales: DataFrame) -> DataFrame:
    """Days flagged missing that have sales, and days not flagged that have none."""
    rows = sales.groupBy("sale_date").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return (
        calendar.join(rows, "sale_date", "left")
        .where(F.col("is_missing_sales_day") == (n > 0))
        .select("sale_date", "is_missing_sales_day", n.alias("pos_rows"))
    )


def assert_entity_keys(sales: DataFrame) -> DataFrame:
    """Ids of several stores, and stores that sold under several ids on one day."""
    triples = sales.select("pos_id", "pos_key", "sale_date").distinct()
    ids = (
        triples.select("pos_id", "pos_key")
        .distinct()
        .groupBy("pos_id")
        .agg(F.count("pos_key").alias("n_keys"))
        .where("n_keys <> 1")
    )
    stores = (
        triples.groupBy("pos_key", "sale_date")
        .agg(F.count("pos_id").alias("n_keys"))
        .where("n_keys > 1")
        .select(F.col("pos_key").alias("pos_id"), "n_keys")
    )
    return union_all([ids, stores])


def _doubtful_stores(sales: DataFrame) -> DataFrame:
    """(id, store) pairs whose lines ``assert_entity_keys`` has to see: those of an id that has not
    one store, and all of a store two of whose ids sold in overlapping times. Lines without a day
    count as any day."""
    undated = F.col("undated") > 0
    pairs = (
        sales.groupBy("pos_id", "pos_key")
        .agg(
            F.min("sale_date").alias("first"),
            F.max("sale_date").alias("last"),
            F.count_if(F.col("sale_date").isNull()).alias("undated"),
        )
        .select(
            "pos_id",
            "pos_key",
            F.when(undated, F.make_date(F.lit(1), F.lit(1), F.lit(1))).otherwise(F.col("first")).alias("first"),
            F.when(undated, F.make_date(F.lit(9999), F.lit(12), F.lit(31))).otherwise(F.col("last")).alias("last"),
        )
    )
    store = Window.partitionBy("pos_key")
    before = store.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    overlaps = F.col("first") <= F.max("last").over(before)
    return (
        pairs.withColumn("overlaps", F.coalesce(overlaps, F.lit(False)))
        .select(
            "pos_id",
            "pos_key",
            (F.count("pos_key").over(Window.partitionBy("pos_id")) != 1).alias("unclear"),
            F.max("overlaps").over(store).alias("shared"),
        )
        .where("unclear or shared")
        .select("pos_id", "pos_key")
    )


def doubtful_sales(sales: DataFrame) -> DataFrame:
    """The lines in which ``assert_entity_keys`` finds what it finds in all of them.

    Days are compared line by line only where an id or a store leaves room for a fault. The pairs
    are written, so that Spark knows how few they are before it joins.
    """
    pairs = stage(_doubtful_stores(sales)).withColumnsRenamed({"pos_id": "_id", "pos_key": "_key"})
    same = F.col("pos_id").eqNullSafe(F.col("_id")) & F.col("pos_key").eqNullSafe(F.col("_key"))
    return sales.select("pos_id", "pos_key", "sale_date").join(pairs, same, "left_semi")


def reconcile_aggregates(
    left: DataFrame, right: DataFrame, key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Keys on one side only, or whose paired columns differ (left name -> right name)."""
    a = left.select(F.col(key).alias("a_key"), *[F.col(c).alias(f"a_{c}") for c in columns])
    b = right.select(
        F.col(key).alias("b_key"), *[F.col(c).alias(f"b_{c}") for c in columns.values()]
    )
    differs = F.col("a_key").isNull() | F.col("b_key").isNull()
    for x, y in columns.items():
        differs = differs | (F.col(f"a_{x}") != F.col(f"b_{y}"))
    return (
        a.join(b, F.col("a_key") == F.col("b_key"), "full")
        .where(differs)
        .withColumn(key, F.coalesce("a_key", "b_key"))
        .drop("a_key", "b_key")
    )


def assert_mix_reconciles(mix: DataFrame, monthly: DataFrame) -> DataFrame:
    totals = mix.groupBy("month").agg(
        *[F.sum(c).alias(c) for c in ("net_units", "net_revenue_fcfa", "gross_revenue_fcfa")]
    )
    pairs = {
        "net_units_sold": "net_units",
        "net_revenue_fcfa": "net_revenue_fcfa",
        "gross_revenue_fcfa": "gross_revenue_fcfa",
    }
    return reconcile_aggregates(monthly, totals, "month", pairs)


def assert_chat_amounts(chat: DataFrame, quality: DataFrame) -> DataFrame:
    """Months whose amounts differ from a recomputation over the orders."""
    expected = quality.groupBy("month").agg(
        F.sum(F.coalesce("amount_plausible_fcfa", F.lit(0.0))).alias("plausible"),
        F.sum(F.when(F.col("amount_outlier"), F.col("amount_fcfa")).otherwise(0.0)).alias("outlier"),
        F.count_if("amount_outlier").alias("outliers"),
    )
    return (
        chat.join(expected, "month")
        .where(
            "known_order_amount_fcfa <> plausible or outlier_amount_fcfa <> outlier "
            "or outlier_amount_orders <> outliers "
            "or delivered_known_amount_fcfa > known_order_amount_fcfa"
        )
        .select("month")
    )


def assert_budget_total(recommendation: DataFrame, params: Params = Params()) -> DataFrame:
    total = F.sum("proposed_budget_fcfa")
    return recommendation.agg(total.alias("total_proposed_fcfa")).where(
        F.abs(F.col("total_proposed_fcfa") - params.total_test_budget) > 1
    )


def assert_decided_channels(recommendation: DataFrame, params: Params = Params()) -> DataFrame:
    """Decided channels that the recommendation does not know."""
    decided = recommendation.sparkSession.createDataFrame(
        [(c,) for c in params.decided_budget], "channel string"
    )
    return decided.join(recommendation.select("channel"), "channel", "left_anti")


def relation_checks(tables: Tables, params: Params = Params()) -> dict[tuple[str, str], DataFrame]:
    """(check, table) -> violating rows, for checks over several rows or tables."""
    sales, calendar = tables("clean_pos_sales"), tables("sales_calendar")
    recommendation = tables("budget_recommendation")
    return {
        ("calendar_bounds", "sales_calendar"): assert_calendar_bounds(calendar, sales),
        ("calendar_flags", "sales_calendar"): assert_calendar_flags(calendar, sales),
        ("entity_keys", "clean_pos_sales"): assert_entity_keys(doubtful_sales(sales)),
        ("mix_reconciles", "product_mix_monthly"): assert_mix_reconciles(
            tables("product_mix_monthly"), tables("sales_monthly")
        ),
        ("amounts_reconcile", "chat_orders_monthly"): assert_chat_amounts(
            tables("chat_orders_monthly"), tables("order_quality")
        ),
        ("budget_total", "budget_recommendation"): assert_budget_total(recommendation, params),
        ("decided_channels", "budget_recommendation"): assert_decided_channels(
            recommendation, params
        ),
    }


def quality_report(tables: Tables, params: Params = Params()) -> DataFrame:
    """check_name, table_name, violations, passed for every check; the counts are made here, a few
    tables at a time."""
    parts = [
        count_all_violations(tables(table), table, checks, UNIQUE_KEYS.get(table))
        for table, checks in row_checks(params).items()
    ]
    parts += [
        rows.agg(F.count("*").alias("violations")).select(
            F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "violations"
        )
        for (check, table), rows in relation_checks(tables, params).items()
    ]
    return stage_union(parts).withColumn("passed", F.col("violations") == 0)
