"""Marts: one function per table, each a DataFrame of the conformed tables.

Facts are aggregated before they are joined. One-row totals are scalar subqueries, so
there is no cross join, and windows only run on rows already at month or channel grain
with a partition key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions import dates, money
from signals.functions.lexicon import CLASSES
from signals.operators import conform
from signals.params import Params


def marketing_channel_monthly(rollup: DataFrame, plan: DataFrame) -> DataFrame:
    """Month x channel: spend, plan, coverage, unit costs and campaign counts.

    ``rollup`` is ``conform.campaign_rollup`` and is read twice: stage it. Campaign counts are keyed by the month in the campaign *name*; a campaign whose name
    has no month therefore never joins here, which keeps month_parse_failure_count at 0.
    """
    spend = conform.campaign_totals(rollup)
    counts = [
        "bissap_campaigns",
        "gingembre_campaigns",
        "bouye_campaigns",
        "campaigns_without_product",
        "product_parse_failure_count",
        "month_parse_failure_count",
    ]
    named = (
        rollup.where(F.col("campaign_month").isNotNull())
        .groupBy(F.col("campaign_month").alias("month"), "channel")
        .agg(F.sum("campaign_rows").alias("campaign_count"), *[F.sum(c).alias(c) for c in counts])
    )
    cost, clicks, views = (
        F.col("campaign_spend_fcfa"), F.col("clicks"), F.col("impressions")
    )
    zero = F.lit(0).cast("long")
    recon = conform.media_reconciliation(spend, conform.plan_totals(plan))
    return recon.join(named, ["month", "channel"], "left").select(
        "month",
        "channel",
        F.coalesce(cost, F.lit(0.0)).alias("campaign_spend_fcfa"),
        F.coalesce("planned_budget_fcfa", F.lit(0.0)).alias("planned_budget_fcfa"),
        "invoiced_fcfa",
        "campaign_vs_invoiced_variance_fcfa",
        "source_coverage",
        F.coalesce("campaign_rows", zero).alias("campaign_rows"),
        views,
        clicks,
        money.ratio_if_positive(cost, clicks).alias("cpc_fcfa"),
        (money.ratio_if_positive(cost, views) * 1000).alias("cpm_fcfa"),
        F.coalesce("campaign_count", zero).alias("campaign_count"),
        *[F.coalesce(c, zero).alias(c) for c in counts],
    )


def sales_monthly(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Month: net, gross and returned units and revenue, distinct stores, day coverage.

    ``sales`` is ``conform.sales_daily`` (or the lines), written: it is read twice. The sums and the
    days need a row a day of each task; the stores, spellings and communes are counted over their
    distinct combinations in a month, where over the sales they would multiply every row by four.
    """
    sums = {
        "units_sold": "net_units_sold",
        "revenue_fcfa": "net_revenue_fcfa",
        "gross_units": "gross_units",
        "gross_revenue_fcfa": "gross_revenue_fcfa",
        "return_units": "return_units",
        "return_revenue_fcfa": "return_revenue_fcfa",
    }
    month = dates.month_floor(F.col("sale_date")).alias("month")
    summed = sales.groupBy(month).agg(
        *[F.sum(source).alias(target) for source, target in sums.items()],
        F.count_distinct("sale_date").alias("observed_sales_days"),
    )
    active = {"active_pos": "pos_key", "active_pos_names": "pos_name", "active_communes": "commune"}
    present = sales.select(month, *active.values()).distinct().groupBy(F.col("month").alias("_month"))
    counted = present.agg(*[F.count_distinct(c).alias(name) for name, c in active.items()])
    monthly = summed.join(counted, F.col("month").eqNullSafe(F.col("_month"))).select(
        "month", *sums.values(), *active, "observed_sales_days"
    )
    days = calendar.groupBy("month").agg(
        F.count("*").alias("calendar_days"),
        F.count_if("has_sales_data").alias("days_with_sales_data"),
        F.count_if("is_missing_sales_day").alias("missing_sales_days"),
    )
    net, gross, back = (
        F.col("net_revenue_fcfa"), F.col("gross_revenue_fcfa"), F.col("return_revenue_fcfa")
    )
    return monthly.join(days, "month", "left").select(
        *monthly.columns,
        "calendar_days",
        "days_with_sales_data",
        "missing_sales_days",
        money.ratio_if_positive(net, F.col("days_with_sales_data")).alias(
            "avg_revenue_per_observed_day"
        ),
        money.ratio(F.abs(back), gross).alias("return_rate_revenue"),
    )


def monthly_performance(marketing: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales months with that month's marketing totals (months with no sales are absent)."""
    zero, zero_count = F.lit(0.0), F.lit(0).cast("long")
    totals = marketing.groupBy("month").agg(
        F.sum("campaign_spend_fcfa").alias("campaign_spend_fcfa"),
        F.sum("planned_budget_fcfa").alias("planned_budget_fcfa"),
        F.sum(F.coalesce("invoiced_fcfa", zero)).alias("invoiced_budget_fcfa"),
        F.sum(F.coalesce("campaign_vs_invoiced_variance_fcfa", zero)).alias(
            "campaign_vs_invoiced_variance_fcfa"
        ),
        F.sum(F.coalesce("impressions", zero_count)).alias("impressions"),
        F.sum(F.coalesce("clicks", zero_count)).alias("clicks"),
    )
    cost = F.col("campaign_spend_fcfa")
    return sales.join(totals, "month", "left").select(
        *totals.columns,
        money.ratio_if_positive(cost, F.col("clicks")).alias("blended_cpc_fcfa"),
        (money.ratio_if_positive(cost, F.col("impressions")) * 1000).alias("blended_cpm_fcfa"),
        "net_units_sold",
        "net_revenue_fcfa",
        "gross_units",
        "gross_revenue_fcfa",
        "return_units",
        "return_revenue_fcfa",
        "active_pos",
        "active_communes",
        "observed_sales_days",
        "calendar_days",
        "missing_sales_days",
        "avg_revenue_per_observed_day",
        "return_rate_revenue",
    )


def channel_performance_monthly(marketing: DataFrame, sales: DataFrame) -> DataFrame:
    """Channel rows with the month's sales repeated on each: never sum the sales columns."""
    return marketing.join(sales, "month", "left").select(
        "month",
        "channel",
        "campaign_spend_fcfa",
        "planned_budget_fcfa",
        "invoiced_fcfa",
        "campaign_vs_invoiced_variance_fcfa",
        "impressions",
        "clicks",
        "net_revenue_fcfa",
        "net_units_sold",
        "gross_revenue_fcfa",
        "return_revenue_fcfa",
        "missing_sales_days",
    )


def product_mix_monthly(sales: DataFrame, products: DataFrame, monthly: DataFrame) -> DataFrame:
    """Month x SKU: volumes, revenue, share of the month, litres and prices.

    ``sales`` is ``conform.sales_daily`` (or the lines).
    """
    month = dates.month_floor(F.col("sale_date")).alias("month")
    by_sku = sales.groupBy(month, "product_sku").agg(
        F.sum("gross_units").alias("gross_units"),
        F.sum("return_units").alias("return_units"),
        F.sum("units_sold").alias("net_units"),
        F.sum("gross_revenue_fcfa").alias("gross_revenue_fcfa"),
        F.sum("return_revenue_fcfa").alias("return_revenue_fcfa"),
        F.sum("net_revenue_fcfa").alias("net_revenue_fcfa"),
    )
    totals = by_sku.groupBy("month").agg(F.sum("net_revenue_fcfa").alias("month_revenue"))
    coverage = monthly.select("month", F.col("missing_sales_days").alias("month_missing_sales_days"))
    net, litres = F.col("net_revenue_fcfa"), F.col("net_units") * F.col("volume_litres")
    return (
        by_sku.join(products, "product_sku", "left")
        .join(totals, "month", "left")
        .join(coverage, "month", "left")
        .select(
            "month",
            "product",
            "format",
            "product_sku",
            "volume_litres",
            "gross_units",
            "return_units",
            "net_units",
            "gross_revenue_fcfa",
            "return_revenue_fcfa",
            "net_revenue_fcfa",
            money.ratio(net, F.col("month_revenue")).alias("revenue_share_of_month"),
            litres.alias("net_litres"),
            money.ratio(net, F.col("net_units")).alias("avg_net_price_per_unit_fcfa"),
            money.ratio(net, litres).alias("net_revenue_per_litre_fcfa"),
            "month_missing_sales_days",
        )
    )


def chat_orders_monthly(quality: DataFrame) -> DataFrame:
    """Month: orders by status, parse quality, units and amounts. One pass, one shuffle."""
    status, parse = F.col("status"), F.col("order_parse_status")
    delivered, plausible = status == "delivered", F.coalesce("amount_plausible_fcfa", F.lit(0.0))
    missing, outlier = F.col("amount_missing"), F.col("amount_outlier")
    units = [
        "bissap_units", "gingembre_units", "bouye_units", "format_1l_units", "format_33cl_units",
    ]
    return quality.groupBy("month").agg(
        F.count("*").alias("orders"),
        F.count_if(delivered).alias("delivered_orders"),
        F.count_if(status == "cancelled").alias("cancelled_orders"),
        F.count_if(status == "pending").alias("pending_orders"),
        F.count_if(missing).alias("amount_missing_orders"),
        F.count_if(parse == "fully_parsed").alias("fully_parsed_orders"),
        F.count_if(parse == "missing_format_only").alias("missing_format_orders"),
        F.count_if(parse == "unresolved").alias("unresolved_orders"),
        F.sum("quantity_total").alias("total_units"),
        *[F.sum(u).alias(u) for u in units],
        F.sum(plausible).alias("known_order_amount_fcfa"),
        F.sum(F.when(delivered, plausible).otherwise(0.0)).alias("delivered_known_amount_fcfa"),
        F.count_if(delivered & missing).alias("delivered_amount_missing_orders"),
        F.count_if(delivered & outlier).alias("delivered_outlier_amount_orders"),
        F.count_if(outlier).alias("outlier_amount_orders"),
        F.sum(F.when(outlier, F.col("amount_fcfa")).otherwise(0.0)).alias("outlier_amount_fcfa"),
    )


def chat_customers(orders: DataFrame) -> DataFrame:
    """Customer (normalised phone): order counts and repeat flags on delivered orders."""
    per_customer = (
        orders.where(F.col("customer_phone").isNotNull())
        .groupBy(F.col("customer_phone").alias("customer_key"))
        .agg(
            F.count("*").alias("order_count"),
            F.count_if(F.col("status") == "delivered").alias("delivered_order_count"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    delivered = F.col("delivered_order_count")
    return per_customer.select(
        "*",
        (delivered > 0).alias("has_delivered_order"),
        (delivered > 1).alias("is_repeat_customer"),
        (F.col("order_count") > 1).alias("is_repeat_customer_any_status"),
    )


# Mart column of each label.
SENTIMENT_COLUMNS = {s: f"{s}_comments_count" for s in ("positive", "negative", "neutral")}
THEME_COLUMNS = {
    t: "other_theme_comments_count" if t == "other" else f"{t}_comments_count"
    for t in CLASSES["theme"]
}
PRODUCT_COLUMNS = {
    "bissap": "bissap_comments_count",
    "gingembre": "gingembre_comments_count",
    "bouye": "bouye_comments_count",
    "multiple": "multiple_product_comments_count",
    "unknown": "unknown_product_comments_count",
    "none": "no_product_comments_count",
}


def social_monthly(enriched: DataFrame) -> DataFrame:
    """Month x platform: label counts without spam, and their percentages.

    Rows first collapse per comment id inside a (month, platform); the distinct count is
    then a plain count.
    """
    spam = F.col("is_spam_model")

    def usable(column: str, value: str) -> Column:
        return F.count_if((F.col(column) == value) & ~spam)

    counts = {
        "comments_count": F.count("*"),
        "likes_total": F.sum(F.coalesce("like_count", F.lit(0))),
        "spam_comments_count": F.count_if(spam),
        "non_spam_comments_count": F.count_if(~spam),
        **{c: usable("sentiment_model", v) for v, c in SENTIMENT_COLUMNS.items()},
        **{c: usable("theme_model", v) for v, c in THEME_COLUMNS.items()},
        **{c: usable("product_model", v) for v, c in PRODUCT_COLUMNS.items()},
        "model_used_count": F.count_if("model_used"),
        "rules_complete_count": F.count_if("rules_complete"),
    }
    month = dates.month_floor(F.to_date("published_at")).alias("month")
    monthly = enriched.groupBy(month, "platform").agg(
        *[expr.alias(name) for name, expr in counts.items()],
        F.count_distinct("comment_id").alias("unique_comments_count"),
    )
    total, usable_total = F.col("comments_count"), F.col("non_spam_comments_count")
    shares = {
        "positive": usable_total,
        "negative": usable_total,
        "neutral": usable_total,
        "spam": total,
        "model_used": total,
        "rules_complete": total,
    }
    return monthly.select(
        "*",
        *[
            money.percent(
                F.col(f"{n}_comments_count" if f"{n}_comments_count" in counts else f"{n}_count"),
                base,
            ).alias(f"{n}_share_pct")
            for n, base in shares.items()
        ],
    )


def _quality_status(good: Column, moderate: Column) -> Column:
    return F.when(good, "good").when(moderate, "moderate").otherwise("limited")


def budget_allocation(marketing: DataFrame) -> DataFrame:
    """Channel: totals, shares of spend and plan, unit costs, data quality."""
    zero, zero_count = F.lit(0.0), F.lit(0).cast("long")
    totals = marketing.groupBy("channel").agg(
        F.sum("campaign_spend_fcfa").alias("campaign_spend_fcfa"),
        F.sum("planned_budget_fcfa").alias("planned_budget_fcfa"),
        F.sum(F.coalesce("invoiced_fcfa", zero)).alias("invoiced_fcfa"),
        F.sum(F.coalesce("impressions", zero_count)).alias("impressions"),
        F.sum(F.coalesce("clicks", zero_count)).alias("clicks"),
        F.sum("campaign_rows").alias("campaign_rows"),
        F.sum("campaign_count").alias("campaign_count"),
        F.sum("campaigns_without_product").alias("campaigns_without_product"),
        F.sum("product_parse_failure_count").alias("product_parse_failure_count"),
        F.sum("month_parse_failure_count").alias("month_parse_failure_count"),
        F.count_distinct("month").alias("active_months"),
    )
    overall = money.one_row(
        marketing.agg(
            F.sum("campaign_spend_fcfa").alias("spend"), F.sum("planned_budget_fcfa").alias("plan")
        )
    )
    all_spend, all_planned = overall["spend"], overall["plan"]
    cost, planned = F.col("campaign_spend_fcfa"), F.col("planned_budget_fcfa")
    unnamed = F.col("campaigns_without_product")
    products, months = F.col("product_parse_failure_count"), F.col("month_parse_failure_count")
    return totals.select(
        "channel",
        cost,
        planned,
        "invoiced_fcfa",
        (cost - F.col("invoiced_fcfa")).alias("campaign_vs_invoiced_fcfa"),
        money.ratio_if_positive(cost, all_spend).alias("spend_share"),
        money.ratio_if_positive(planned, all_planned).alias("planned_share"),
        money.ratio_if_positive(cost, planned).alias("spend_vs_plan_ratio"),
        "impressions",
        "clicks",
        money.ratio_if_positive(cost, F.col("clicks")).alias("cpc_fcfa"),
        (money.ratio_if_positive(cost, F.col("impressions")) * 1000).alias("cpm_fcfa"),
        "campaign_rows",
        "campaign_count",
        "active_months",
        unnamed,
        products,
        months,
        _quality_status(
            (unnamed == 0) & (products == 0) & (months == 0), (products <= 2) & (months <= 2)
        ).alias("data_quality_status"),
    )


def month_ranks(marketing: DataFrame) -> DataFrame:
    """Distinct months, most recent first: one shared calendar for all channels.

    The list of months is short whatever the volume, so it is ranked as one sorted array;
    an unknown month ranks after the known ones.
    """
    months = marketing.select("month").distinct()
    ordered = months.agg(
        F.sort_array(F.collect_list(F.struct("month")), asc=False).alias("months")
    )
    return ordered.select(F.posexplode("months").alias("pos", "m")).select(
        F.col("m.month").alias("month"), (F.col("pos") + 1).alias("month_rank")
    )


def channel_evidence(marketing: DataFrame) -> DataFrame:
    """Channel: totals, recent and earlier spend, missing metrics, coverage, quality."""
    zero, zero_count = F.lit(0.0), F.lit(0).cast("long")
    ranks = month_ranks(marketing).withColumnRenamed("month", "ranked_month")
    ranked = marketing.join(ranks, F.col("month").eqNullSafe(F.col("ranked_month")))
    rank, cost = F.col("month_rank"), F.col("campaign_spend_fcfa")
    totals = ranked.groupBy("channel").agg(
        F.sum(cost).alias("campaign_spend_fcfa"),
        F.sum("planned_budget_fcfa").alias("planned_budget_fcfa"),
        F.sum(F.coalesce("invoiced_fcfa", zero)).alias("invoiced_fcfa"),
        F.sum(F.coalesce("impressions", zero_count)).alias("impressions"),
        F.sum(F.coalesce("clicks", zero_count)).alias("clicks"),
        F.sum("campaign_rows").alias("campaign_rows"),
        F.sum("campaign_count").alias("campaign_count"),
        F.count_distinct("month").alias("active_months"),
        F.count_if(F.col("impressions").isNull()).alias("months_missing_impressions"),
        F.count_if(F.col("clicks").isNull()).alias("months_missing_clicks"),
        F.sum("campaigns_without_product").alias("campaigns_without_product"),
        F.sum("product_parse_failure_count").alias("product_parse_failure_count"),
        F.sum("month_parse_failure_count").alias("month_parse_failure_count"),
        F.max(F.when(rank == 1, cost)).alias("latest_month_spend_fcfa"),
        F.max(F.when(rank == 2, cost)).alias("previous_month_spend_fcfa"),
        F.sum(F.when(rank <= 3, cost).otherwise(0.0)).alias("recent_3m_spend_fcfa"),
        F.sum(F.when(rank.between(4, 6), cost).otherwise(0.0)).alias("earlier_3m_spend_fcfa"),
    )
    overall = money.one_row(
        marketing.agg(
            F.sum("campaign_spend_fcfa").alias("spend"), F.count_distinct("month").alias("months")
        )
    )
    all_spend, period = overall["spend"], overall["months"]
    latest, previous = F.col("latest_month_spend_fcfa"), F.col("previous_month_spend_fcfa")
    recent, earlier = F.col("recent_3m_spend_fcfa"), F.col("earlier_3m_spend_fcfa")
    no_views, no_clicks = F.col("months_missing_impressions"), F.col("months_missing_clicks")
    products, months = F.col("product_parse_failure_count"), F.col("month_parse_failure_count")
    return totals.select(
        "channel",
        "campaign_spend_fcfa",
        "planned_budget_fcfa",
        "invoiced_fcfa",
        money.ratio_if_positive(F.col("campaign_spend_fcfa"), F.col("planned_budget_fcfa")).alias(
            "spend_vs_plan_ratio"
        ),
        F.when(
            F.col("campaign_spend_fcfa") > 0, money.ratio(F.col("campaign_spend_fcfa"), all_spend)
        ).alias("spend_share"),
        "impressions",
        "clicks",
        money.ratio_if_positive(F.col("campaign_spend_fcfa"), F.col("clicks")).alias("cpc_fcfa"),
        (
            money.ratio_if_positive(F.col("campaign_spend_fcfa"), F.col("impressions")) * 1000
        ).alias("cpm_fcfa"),
        "campaign_rows",
        "campaign_count",
        "active_months",
        no_views,
        no_clicks,
        "campaigns_without_product",
        products,
        months,
        latest,
        previous,
        (money.ratio_if_positive(latest, previous) - 1).alias("latest_month_spend_change"),
        recent,
        earlier,
        (money.ratio_if_positive(recent, earlier) - 1).alias("recent_vs_earlier_spend_change"),
        F.when(F.col("active_months") == period, "full_period")
        .otherwise("partial_period")
        .alias("period_coverage"),
        _quality_status(
            (no_views == 0) & (no_clicks == 0) & (products == 0) & (months == 0),
            (no_views <= 1) & (no_clicks <= 1) & (products <= 2) & (months <= 2),
        ).alias("data_quality_status"),
    )


def decision_budget(performance: DataFrame, marketing: DataFrame) -> DataFrame:
    """Month: performance with active channels, spend to plan and revenue to spend."""
    active = marketing.groupBy("month").agg(F.count_distinct("channel").alias("active_channels"))
    cost = F.col("campaign_spend_fcfa")
    return performance.join(active, "month", "left").select(
        "month",
        cost,
        "planned_budget_fcfa",
        "invoiced_budget_fcfa",
        "campaign_vs_invoiced_variance_fcfa",
        "net_revenue_fcfa",
        "net_units_sold",
        "impressions",
        "clicks",
        "blended_cpc_fcfa",
        "blended_cpm_fcfa",
        "missing_sales_days",
        "active_channels",
        money.ratio_if_positive(cost, F.col("planned_budget_fcfa")).alias(
            "overall_spend_vs_plan_ratio"
        ),
        money.ratio_if_positive(F.col("net_revenue_fcfa"), cost).alias(
            "revenue_to_campaign_spend_ratio"
        ),
    )


def channel_decision(
    evidence: DataFrame, allocation: DataFrame, performance: DataFrame
) -> DataFrame:
    """Channel: evidence, observed share, overall sales totals, evidence grade and profile."""
    all_planned = evidence.agg(F.sum("planned_budget_fcfa")).scalar()
    all_spend = allocation.agg(F.sum("campaign_spend_fcfa")).scalar()
    monthly_ratio = money.ratio_if_positive(
        F.col("net_revenue_fcfa"), F.col("campaign_spend_fcfa")
    )
    sales_totals = performance.agg(
        F.sum("net_revenue_fcfa").alias("total_net_revenue_fcfa"),
        F.sum("net_units_sold").alias("total_net_units_sold"),
        F.sum("missing_sales_days").alias("total_missing_sales_days"),
        F.avg(monthly_ratio).alias("avg_monthly_revenue_spend_ratio"),
    )
    overall = money.one_row(sales_totals)
    cost = F.col("campaign_spend_fcfa")
    observed = allocation.select(
        "channel",
        F.when(cost > 0, money.ratio(cost, all_spend)).otherwise(0.0).alias("observed_spend_share"),
    )
    status = F.col("data_quality_status")
    limited = status == "limited"
    return evidence.join(observed, "channel", "left").select(
        *[c for c in evidence.columns if c != "earlier_3m_spend_fcfa"],
        "observed_spend_share",
        money.ratio_if_positive(F.col("planned_budget_fcfa"), all_planned).alias("planned_share"),
        *[overall[name].alias(name) for name in sales_totals.columns],
        F.when(status == "good", "high")
        .when(status == "moderate", "medium")
        .otherwise("limited")
        .alias("evidence_quality"),
        F.when((F.col("clicks") > 0) & (F.col("impressions") > 0) & ~limited,
               "digital_metrics_available")
        .when(limited, "limited_measurement")
        .otherwise("non_digital_or_partial_metrics")
        .alias("measurement_profile"),
    )


# Wording shown beside each proposed budget.
RATIONALE = {
    "Meta": "Mesure digitale disponible ; dépense historique élevée ; allocation à tester "
    "sans conclure à une causalité sur les ventes.",
    "TikTok": "Volume digital mesurable et dépense proche du plan ; allocation de test, "
    "sans assimiler CPC à performance commerciale.",
    "Google": "Mesure des clics disponible et dépense proche du plan ; allocation de test "
    "sur un canal digital distinct.",
    "Radio": "Canal historiquement planifié et facturé, mais mesure média limitée ; "
    "allocation volontairement limitée avec instrumentation à renforcer.",
    "Influenceurs": "Présence dans le plan et dépenses observées, mais mesure limitée ; "
    "allocation de test avec dispositif de suivi.",
    "Activation terrain": "Le plan indique une dépense facturée alors que l'export campagne "
    "indique 0 ; allocation conditionnée à une meilleure réconciliation.",
}
NO_RATIONALE = "Canal non retenu dans la proposition."
TEST_CONDITION = {
    "Meta": "Suivre impressions, clics et conversion mesurable.",
    "TikTok": "Suivre impressions, clics et conversion mesurable.",
    "Google": "Suivre clics et conversion mesurable.",
    "Radio": "Ajouter code, numéro ou mécanisme de suivi dédié.",
    "Influenceurs": "Ajouter lien, code ou mécanisme de suivi dédié.",
    "Activation terrain": "Réconcilier facturation et dépenses campagne avant extrapolation.",
}
NO_CONDITION = "Définir un mécanisme de mesure."
EVIDENCE_BONUS = {"high": 1.5, "medium": 1.3}


def _by_channel(values: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for channel, value in values.items():
        out = F.when(F.col("channel") == channel, value).otherwise(out)
    return out


def budget_recommendation(decision: DataFrame, params: Params = Params()) -> DataFrame:
    """Channel: floor plus a share of the remainder, overridden by a decided amount.

    Rounding leaves a residual that goes to the channel with the largest raw budget, the
    first by name when several tie, so that the total always holds.
    """
    total, floor = F.lit(params.total_test_budget), F.lit(params.budget_floor)
    bonus = F.lit(1.0)
    for grade, factor in EVIDENCE_BONUS.items():
        bonus = F.when(F.col("evidence_quality") == grade, factor).otherwise(bonus)
    score = F.coalesce("observed_spend_share", F.lit(0.0)) * bonus
    scored = decision.select("channel", score.alias("raw_score"))
    overall = money.one_row(scored.agg(F.sum("raw_score").alias("s"), F.count("*").alias("n")))
    all_scores, n = overall["s"], overall["n"]
    share = F.when(all_scores > 0, F.col("raw_score") / all_scores).otherwise(
        F.lit(1.0) / n.cast("double")
    )
    step = F.lit(params.budget_rounding)
    raw = scored.select(
        "channel", (floor + share * (total - floor * n.cast("double"))).alias("raw_budget")
    )
    rounded = raw.withColumn("budget", F.round(F.col("raw_budget") / step) * step)
    largest_first = F.struct(-F.col("raw_budget"), "channel")
    rounding = money.one_row(
        rounded.agg(
            F.sum("budget").alias("total"), F.min_by("channel", largest_first).alias("absorber")
        )
    )
    residual, absorber = total - rounding["total"], rounding["absorber"]
    computed = rounded.select(
        "channel",
        (
            F.col("budget") + F.when(F.col("channel") == absorber, residual).otherwise(0.0)
        ).alias("computed_budget_fcfa"),
    )
    decided = F.lit(None).cast("double")
    for channel, amount in params.decided_budget.items():
        decided = F.when(F.col("channel") == channel, F.lit(float(amount))).otherwise(decided)
    proposed = F.coalesce(decided, F.col("computed_budget_fcfa"))
    return decision.join(computed, "channel").select(
        "channel",
        "campaign_spend_fcfa",
        "planned_budget_fcfa",
        "invoiced_fcfa",
        "spend_share",
        "planned_share",
        "spend_vs_plan_ratio",
        "impressions",
        "clicks",
        "cpc_fcfa",
        "cpm_fcfa",
        "data_quality_status",
        "evidence_quality",
        "measurement_profile",
        proposed.alias("proposed_budget_fcfa"),
        (proposed / total).alias("proposed_share"),
        "computed_budget_fcfa",
        F.when(decided.isNotNull(), "décidé").otherwise("calculé").alias("allocation_source"),
        _by_channel(RATIONALE, NO_RATIONALE).alias("allocation_rationale"),
        _by_channel(TEST_CONDITION, NO_CONDITION).alias("test_condition"),
    )
