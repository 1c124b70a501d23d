"""Every registered query: name -> function of (spark, folder of base tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signals.functions import labels
from signals.operators import (
    cleaning, conform, dedupe, evaluation, filters, identity, items, profiling, quality, sampling, scoring,
    trends, voice_rules,
)
from signals.operators.score_log import ScoreLog, incremental_score
from signals.plans import brief, marts, metrics
from signals.plans.metrics import Intent, metric_query
from signals.plans.workspace import Workspace
from signals.params import Params
from signals.session import configure
from signals.sources import derive, faults
from signals.sources.io import load_summary, shared_dir, stage, union_all

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Tables worth writing once when nearly everything is built in one go.
# Those with a row a source row, or made of all of those at once, by the shuffle files they need.
LARGE_TABLES = (
    "clean_chat_orders", "clean_pos_sales", "sales_monthly", "clean_comments", "comments_enriched", "social_monthly",
    "clean_campaigns", "order_quality", "chat_customers",
)
BASE_TABLES = (
    *LARGE_TABLES, "sales_calendar", "campaign_rollup", "marketing_channel_monthly",
    "monthly_performance", "channel_evidence", "channel_decision",
    "product_dimension", "product_mix_monthly", "chat_orders_monthly",
    "budget_allocation", "budget_recommendation",
)
# Columns they only carry along, which no check reads and no table made of them.
UNREAD = {
    "clean_chat_orders": ("received_at_raw", "customer_phone_raw", "delivery_zone_raw", "status_raw"),
    "clean_pos_sales": ("commune_raw", "channel_raw"),
    "comments_enriched": ("comment_text", "author_handle", "reply_to_id"),
    "clean_campaigns": ("platform_raw", "date_start_raw", "date_end_raw", "spend_raw", "objective_raw"),
    "order_quality": ("order_ref", "received_at"),
}


def workspace(spark: SparkSession, base: str, **options) -> Workspace:
    return Workspace(derive.DerivedSources(configure(spark), base), **options)


def register(name: str):
    """Register a function of the workspace under a name."""

    def add(build: Callable[[Workspace], DataFrame]):
        QUERIES[name] = lambda spark, base: build(workspace(spark, base))
        return build

    return add


def on_table(name: str, table: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, base: build(workspace(spark, base)(table))


def on_source(name: str, source: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, base: build(workspace(spark, base).sources[source])


def built(spark: SparkSession, base: str) -> Workspace:
    """A workspace whose shared tables are written already."""
    ws = workspace(spark, base, staged=BASE_TABLES, unread=UNREAD)
    ws.stage_all(alone=LARGE_TABLES)
    return ws


def value_pairs(*columns: str) -> Callable[[DataFrame], DataFrame]:
    """Distinct combinations of raw and parsed values with their frequency."""
    return lambda df: df.groupBy(*columns).agg(F.count("*").alias("row_count"))


# --- whole tables ------------------------------------------------------------------------
for _name in (
    "clean_campaigns", "clean_media_plan", "clean_pos_sales", "clean_comments",
    "clean_chat_orders", "campaign_attributes", "sales_daily", "product_dimension", "sales_calendar",
    "order_items", "order_quality", "media_reconciliation", "comments_enriched",
    "marketing_channel_monthly", "sales_monthly", "monthly_performance",
    "channel_performance_monthly", "product_mix_monthly", "chat_orders_monthly",
    "chat_customers", "social_monthly", "budget_allocation", "channel_evidence",
    "decision_budget", "channel_decision", "budget_recommendation",
):
    on_table(_name, _name, lambda df: df)
on_table(
    "pos_dimension", "pos_dimension", lambda df: df.withColumn("pos_ids", F.array_join("pos_ids", ","))
)


@register("load_summary")
def _(ws):
    return load_summary(ws.sources)


# --- cleaning, column by column ----------------------------------------------------------
PAIRS = {
    "canon_label": ("clean_campaigns", ["platform_raw", "platform"]),
    "canon_objective": ("clean_campaigns", ["objective_raw", "objective_normalized"]),
    "parse_mixed_date": ("clean_campaigns", ["date_start_raw", "date_start"]),
    "parse_mixed_end_date": ("clean_campaigns", ["date_end_raw", "date_end"]),
    "parse_money": ("clean_campaigns", ["spend_raw", "spend_amount"]),
    "detect_currency": ("clean_campaigns", ["spend_raw", "spend_currency", "converted_from_eur"]),
    "convert_fx": (
        "clean_campaigns", ["spend_amount", "spend_currency", "fx_rate_to_fcfa", "spend_fcfa"]
    ),
    "month_floor": ("clean_campaigns", ["date_start", "month"]),
    "quality_flags": (
        "clean_campaigns",
        ["date_start_parse_failed", "date_end_parse_failed", "spend_parse_failed",
         "invalid_date_range", "converted_from_eur", "impressions_missing", "clicks_missing"],
    ),
    "parse_french_month": ("clean_media_plan", ["month_raw", "month_date"]),
    "canon_channel": ("clean_media_plan", ["channel_raw", "channel"]),
    "plan_flags": (
        "clean_media_plan",
        ["month_parse_failed", "planned_budget_missing", "invalid_planned_budget"],
    ),
    "entity_key": ("clean_pos_sales", ["pos_name_raw", "pos_key"]),
    "canon_commune": ("clean_pos_sales", ["commune_raw", "commune"]),
    "canon_sales_channel": ("clean_pos_sales", ["channel_raw", "channel"]),
    "parse_mixed_timestamp": ("clean_chat_orders", ["received_at_raw", "received_at"]),
    "normalize_phone": ("clean_chat_orders", ["customer_phone_raw", "customer_phone"]),
    "canon_status": ("clean_chat_orders", ["status_raw", "status"]),
    "key_repeated": ("clean_chat_orders", ["order_ref", "order_ref_repeated"]),
    "campaign_name_attributes": (
        "campaign_attributes", ["campaign_name", "product", "product_parse_status"]
    ),
    "campaign_month": (
        "campaign_attributes", ["month", "campaign_month", "campaign_month_parse_status"]
    ),
    "parse_order_item": (
        "order_items", ["segment", "product", "format", "quantity", "parse_status"]
    ),
    "source_coverage": ("media_reconciliation", ["source_coverage"]),
}
for _name, (_table, _columns) in PAIRS.items():
    on_table(_name, _table, value_pairs(*_columns))

on_table(
    "plan_variance",
    "clean_media_plan",
    lambda df: df.select(
        "plan_id", "planned_budget_fcfa", "invoiced_fcfa", "variance_fcfa", "invoiced_available"
    ),
)
on_table(
    "split_returns",
    "clean_pos_sales",
    lambda df: df.groupBy("is_return").agg(
        F.count("*").alias("row_count"),
        F.sum("gross_units").alias("gross_units"),
        F.sum("return_units").alias("return_units"),
        F.sum("gross_revenue_fcfa").alias("gross_revenue_fcfa"),
        F.sum("return_revenue_fcfa").alias("return_revenue_fcfa"),
    ),
)
on_table(
    "net_revenue",
    "clean_pos_sales",
    lambda df: df.groupBy("product_sku").agg(
        F.count("revenue_fcfa").alias("known_rows"),
        F.count("*").alias("row_count"),
        F.sum("net_revenue_fcfa").alias("net_revenue_fcfa"),
    ),
)
on_source(
    "technical_row_id",
    "whatsapp_orders",
    lambda df: identity.with_row_ids(df).select("row_id", "order_ref", "received_at", "amount_fcfa"),
)
on_table(
    "recon_variance_ratio",
    "media_reconciliation",
    lambda df: df.select(
        "month",
        "channel",
        "campaign_vs_invoiced_variance_fcfa",
        "campaign_to_invoiced_ratio",
    ),
)

# --- duplicates, filters, keys -----------------------------------------------------------
on_source("drop_exact_duplicates", "campaign_spend_export", dedupe.drop_exact_duplicates)
on_source("drop_exact_duplicates_flagged", "social_comments", dedupe.drop_exact_duplicates_flagged)
on_source(
    "split_order_items",
    "whatsapp_orders",
    lambda df: df.select(F.explode(items.split_order_items(F.col("items_text"))).alias("segment"))
    .groupBy("segment")
    .agg(F.count("*").alias("row_count")),
)
on_table(
    "rows_in_months",
    "marketing_channel_monthly",
    lambda df: filters.rows_in_months(df, ["1997-03", "1998-11"]),
)
on_table(
    "members_in_closed_list",
    "marketing_channel_monthly",
    lambda df: filters.members_in_closed_list(
        df, "channel", ["Facebook", "google ads"], labels.CHANNEL_ALIASES
    ),
)
on_source(
    "rows_where_key_repeats",
    "whatsapp_orders",
    lambda df: dedupe.rows_where_key_repeats(df, "order_ref"),
)
on_source(
    "rows_where_tuple_repeats",
    "campaign_spend_export",
    lambda df: dedupe.rows_where_key_repeats(
        df, "platform", "campaign_name", "date_start", "date_end"
    ),
)

# --- profiling ---------------------------------------------------------------------------
on_source("profile_table", "campaign_spend_export",
          lambda df: profiling.profile_table(df, "campaign_spend_export"))
on_source("value_counts", "social_comments", lambda df: profiling.value_counts(df, "platform"))
on_source("missing_counts", "campaign_spend_export",
          lambda df: profiling.missing_counts(df, "impressions", "clicks"))
on_source("planned_vs_invoiced", "media_plan", profiling.planned_vs_invoiced)
on_source("date_span", "pos_sales_daily", lambda df: profiling.date_span(df, "sale_date"))
on_source("rows_per_day", "pos_sales_daily", lambda df: profiling.rows_per_day(df, "sale_date"))
# The derived lines have no such conflicts: they are planted.
on_source("id_name_conflicts", "pos_sales_daily",
          lambda df: profiling.id_name_conflicts(faults.shared_store_names(df), "pos_id", "pos_name"))
on_source("name_id_conflicts", "pos_sales_daily",
          lambda df: profiling.id_name_conflicts(faults.shared_store_names(df), "pos_name", "pos_id"))
on_table("store_id_conflicts", "clean_pos_sales",
         lambda df: profiling.id_name_conflicts(df, "pos_key", "pos_id"))
on_source("negative_profile", "pos_sales_daily", profiling.negative_profile)
on_source("missing_dates", "pos_sales_daily", lambda df: profiling.missing_dates(df, "sale_date"))
on_source("repeated_keys", "whatsapp_orders", lambda df: dedupe.repeated_keys(df, "order_ref"))
on_source("repeated_comment_ids", "social_comments",
          lambda df: dedupe.repeated_keys(df, "comment_id"))
on_source("text_length_stats", "social_comments", profiling.text_length_stats)
on_source("posts_per_platform", "social_comments", profiling.posts_per_platform)
on_source("phone_length_profile", "whatsapp_orders", profiling.phone_length_profile)

# --- comments ----------------------------------------------------------------------------
def _texts(ws: Workspace) -> DataFrame:
    comments = ws("clean_comments")
    return comments.where("comment_text <> ''").select("comment_id", "comment_text").distinct()


@register("classify_rules")
def _(ws):
    return voice_rules.classify_rules(_texts(ws))


def _rule(name: str, *columns: str) -> None:
    QUERIES[name] = lambda spark, base: value_pairs(*columns)(
        voice_rules.classify_rules(_texts(workspace(spark, base)))
    )


_rule("rule_language", "rule_language")
_rule("rule_sentiment", "rule_sentiment")
_rule("rule_theme", "rule_theme")
_rule("rule_product", "rule_product")
_rule("rule_spam", "rule_is_spam")
_rule("rules_complete", "rules_complete", "rule_theme", "rule_is_spam")


@register("normalize_comment")
def _(ws):
    normal = voice_rules.normalize_comment(F.col("comment_text"))
    return _texts(ws).select(
        "comment_id",
        normal.alias("normal_text"),
        voice_rules.strip_fillers(normal).alias("bare_text"),
    )


@register("emoji_only")
def _(ws):
    normal = voice_rules.normalize_comment(F.col("comment_text"))
    return (
        _texts(ws)
        .where(voice_rules.is_emoji_only(normal))
        .select("comment_id", voice_rules.emoji_sentiment(normal).alias("sentiment"))
    )


on_table("label_comments", "social_predictions", lambda df: df.drop("coerced"))
on_table("derive_product", "social_predictions", value_pairs("theme_model", "product_model"))


@register("score_distinct_texts")
def _(ws):
    scores = scoring.score_distinct_texts(voice_rules.classify_rules(_texts(ws)))
    return scores.withColumn("coerced", F.array_join("coerced", ","))


@register("merge_rules_and_scores")
def _(ws):
    return scoring.predict(ws("clean_comments"), scoring.constant_scorer).drop("coerced")


@register("conform_labels")
def _(ws):
    raw = _human(ws).select(
        "comment_id",
        F.col("language_human").alias("language"),
        F.col("sentiment_human").alias("sentiment"),
        # Some themes under another name, which is repaired.
        F.when(F.col("product_human") == "none", None)
        .when(F.col("theme_human") == "availability", " Stock fini")
        .when(F.col("theme_human") == "packaging", "couleur")
        .otherwise(F.upper("theme_human"))
        .alias("theme"),
        F.col("is_spam_human").alias("is_spam"),
    )
    return scoring.conform_labels(raw).withColumn("coerced", F.array_join("coerced", ","))


on_table("run_summary", "social_predictions", scoring.run_summary)


def _versioned(ws: Workspace) -> DataFrame:
    version = F.when(F.col("language_model") == "fr", "rules-1").otherwise("rules-0")
    return ws("social_predictions").withColumn("classifier_version", version)


@register("new_only")
def _(ws):
    comments = ws("clean_comments").select("comment_id", "like_count")
    return scoring.new_only(comments, _versioned(ws), "rules-1")


@register("incremental_score")
def _(ws):
    """Two runs into one log: the first only knows the replies, the second adds the rest."""
    comments = ws("clean_comments")
    path = f"{shared_dir(comments.sparkSession)}/signals-log/{uuid.uuid4().hex}"
    incremental_score(comments.where("is_reply"), path, 1, ws.params, slices=2)
    made = incremental_score(comments, path, 2, ws.params, slices=2)
    return made.drop("coerced", "classifier_version", "run_id")


@register("compacted_log")
def _(ws):
    """The log of two runs after compaction: one set of files, the newest row per comment."""
    comments = ws("clean_comments")
    log = ScoreLog(comments.sparkSession, f"{shared_dir(comments.sparkSession)}/signals-log/{uuid.uuid4().hex}")
    log.score(comments.where("is_reply"), ws.params.classifier_version, 1, slices=2)
    log.score(comments, ws.params.classifier_version, 2, slices=2)
    log.compact(buckets=4)
    return log.rows().drop("coerced", "classifier_version", "run_id")


@register("keep_last")
def _(ws):
    """An older run that knew no theme, superseded by the current one."""
    runs = F.array(
        F.struct(F.lit(1).alias("run_id"), F.lit("other").alias("theme")),
        F.struct(F.lit(2).alias("run_id"), F.col("theme_model").alias("theme")),
    )
    # Both rows of a comment from one labelling of it.
    both = ws("social_predictions").withColumn("run", F.explode(runs))
    both = both.withColumns({"theme_model": F.col("run.theme"), "run_id": F.col("run.run_id")}).drop("run")
    return scoring.keep_last(both).drop("coerced", "run_id")


# --- evaluation --------------------------------------------------------------------------
def _human(ws: Workspace, batch: int | None = None) -> DataFrame:
    return derive.human_labels(ws.sources.spark, ws.sources.base, batch)


def on_labels(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    @register(name)
    def _(ws):
        return build(evaluation.prediction_vs_human(_human(ws), ws("social_predictions")))


on_labels("prediction_vs_human", lambda df: df)
on_labels("field_accuracy", evaluation.field_accuracy)
on_labels("class_report", evaluation.class_report)
on_labels("exact_agreement", evaluation.exact_agreement)
on_labels("field_errors", evaluation.field_errors)
on_labels("error_rows", evaluation.error_rows)


@register("unmatched_labels")
def _(ws):
    return evaluation.unmatched_count(_human(ws), ws("social_predictions"))


@register("label_normalise")
def _(ws):
    return evaluation.label_normalise(_human(ws), "human")


@register("constant_baseline")
def _(ws):
    return evaluation.constant_baseline(_human(ws))


def _draft(ws: Workspace) -> DataFrame:
    drafted = _human(ws, 1)
    asked = F.when(F.col("is_spam_human").isin("true", "false"), " Oui ").otherwise("non")
    return drafted.withColumn("validated", asked).withColumn(
        "sentiment_human",
        F.when(F.col("language_human") == "FR", "mitigé").otherwise(F.col("sentiment_human")),
    )


@register("merge_refusals")
def _(ws):
    return evaluation.merge_refusals(_human(ws, 0), _draft(ws))


@register("merge_validated")
def _(ws):
    draft = _draft(ws).where("sentiment_human <> 'mitigé'")
    merged, rest = evaluation.merge_validated(_human(ws, 0), draft)
    parts = [merged.withColumn("part", F.lit("merged"))]
    parts.append(rest.drop("validated").withColumn("part", F.lit("remaining")))
    return union_all(parts)


@register("version_drift")
def _(ws):
    # Read twice below: labelled once and written, without the texts.
    now = stage(ws("social_predictions").drop("comment_text", "coerced"))
    constant = now.select(
        "comment_id",
        F.lit("fr").alias("language_model"),
        F.lit("neutral").alias("sentiment_model"),
        F.lit("other").alias("theme_model"),
        F.lit("none").alias("product_model"),
        F.lit(False).alias("is_spam_model"),
    )
    return scoring.version_drift(constant, now)


@register("single_version")
def _(ws):
    return scoring.single_version(_versioned(ws), ws("clean_comments"))


on_table("annotation_sample", "clean_comments", sampling.annotation_sample)


def _crosstab(name: str, column: str) -> None:
    on_table(
        name,
        "comments_enriched",
        lambda df: trends.crosstab(
            df, column, "sentiment_model", ["positive", "negative", "neutral"],
            keep=~F.col("is_spam_model"),
        ),
    )


_crosstab("theme_sentiment", "theme_model")
_crosstab("product_sentiment", "product_model")

# --- metrics -----------------------------------------------------------------------------
for _metric in metrics.METRICS.values():
    _intent = Intent(_metric.name, _metric.dimensions)
    register(f"metric_{_metric.name}")(lambda ws, i=_intent: metric_query(ws, i))


@register("metric_total")
def _(ws):
    return metric_query(ws, Intent("net_revenue"))


@register("metric_month_filter")
def _(ws):
    return metric_query(ws, Intent("spend", ("channel",), month="1997-12"))


@register("metric_since_filter")
def _(ws):
    return metric_query(ws, Intent("net_revenue", ("month",), since="2000-06"))


@register("metric_relative_window")
def _(ws):
    return metric_query(ws, Intent("sentiment_split", ("month",), relative_months=3))


@register("metric_member_filters")
def _(ws):
    intent = Intent(
        "product_mix", ("month", "product"), since="2000-01", product=("bissap", "ginger")
    )
    return metric_query(ws, intent)


@register("metric_platform_filter")
def _(ws):
    return metric_query(ws, Intent("theme_split", ("month",), platform=("insta", "fb")))


@register("metric_channel_filter")
def _(ws):
    return metric_query(ws, Intent("spend", ("month",), channel="instagram"))


on_table("latest_month", "sales_monthly", metrics.latest_month)
on_table("latest_month_of_year", "sales_monthly", lambda df: metrics.latest_month(df, 12))


@register("with_previous_month")
def _(ws):
    return metrics.with_previous_month(ws, Intent("spend", ("channel",), month="1998-01"))


@register("previous_by_month")
def _(ws):
    return metrics.previous_by_month(ws, "sentiment_split")


@register("several_metrics")
def _(ws):
    results = metrics.several_metrics(
        ws, Intent("net_revenue", ("month",)), ["spend", "delivered_orders", "proposed_budget"]
    )
    parts = [
        df.select("month", F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
        for n, df in results.items()
    ]
    return union_all(parts)


def _bounds_check(spark: SparkSession, base: str) -> DataFrame:
    """Only what several bounded metrics read is written first."""
    ws = workspace(
        spark, base, staged=("sales_daily", "campaign_rollup", "marketing_channel_monthly", "sales_monthly", "social_monthly")
    )
    ws.stage_all()
    return metrics.metric_bounds_check(ws)


QUERIES["metric_bounds_check"] = _bounds_check

# --- trends ------------------------------------------------------------------------------
on_table("variation", "sales_monthly",
         lambda df: trends.variation_by_month(df, "net_revenue_fcfa"))
on_table("monthly_trend", "sales_monthly",
         lambda df: trends.monthly_trend(df, "net_revenue_fcfa"))
on_table("category_breakdown", "marketing_channel_monthly",
         lambda df: trends.category_breakdown(df, "channel", "campaign_spend_fcfa"))
on_table("share_trend", "product_mix_monthly",
         lambda df: trends.share_trend(df, "product_sku", "net_revenue_fcfa"))
on_table("month_category", "marketing_channel_monthly",
         lambda df: trends.month_category(df, "channel", "campaign_spend_fcfa"))
on_table("ranking", "marketing_channel_monthly",
         lambda df: trends.ranking(df, "channel", "campaign_spend_fcfa"))
on_table("ranking_lowest", "marketing_channel_monthly",
         lambda df: trends.ranking(df, "month", "campaign_spend_fcfa", lowest=True))
on_table(
    "compare_members",
    "marketing_channel_monthly",
    lambda df: trends.compare_members(
        filters.members_in_closed_list(df, "channel", ["Meta", "TikTok"], labels.CHANNEL_ALIASES),
        "channel",
        "campaign_spend_fcfa",
    ),
)


@register("ratio_by_category")
def _(ws):
    shares = metric_query(ws, Intent("positive_share", ("platform",)))
    return trends.ratio_by_category(shares, "platform", "positive_share")


@register("points_label")
def _(ws):
    shares = metric_query(ws, Intent("positive_share", ("month",)))
    change = F.col("positive_share") - F.col("previous_positive_share")
    both = shares.join(
        shares.select(
            F.add_months("month", 1).alias("month"),
            F.col("positive_share").alias("previous_positive_share"),
        ),
        "month",
    )
    return both.select("month", change.alias("points"), trends.points_label(change).alias("trend"))


on_table(
    "sentiment_summary",
    "social_monthly",
    lambda df: trends.sentiment_summary(
        df.select(
            "month",
            "platform",
            F.col("non_spam_comments_count").alias("usable"),
            *[F.col(c).alias(s) for s, c in marts.SENTIMENT_COLUMNS.items()],
        )
    ),
)
on_table("top_themes", "social_monthly", brief.top_named_themes)
on_table(
    "month_pivot",
    "product_mix_monthly",
    lambda df: trends.month_pivot(df, "product", "net_revenue_fcfa", labels.PRODUCTS),
)

# --- brief and pages ---------------------------------------------------------------------
on_table("brief_sales", "monthly_performance", brief.brief_sales)
on_table("brief_channels", "marketing_channel_monthly", brief.brief_channels)
on_table("brief_voice", "social_monthly", brief.brief_voice)
on_table("brief_themes", "social_monthly", brief.brief_themes)
on_table("brief_products", "product_mix_monthly", brief.brief_products)
on_table("brief_chat_orders", "chat_orders_monthly", brief.brief_chat_orders)


@register("brief_points")
def _(ws):
    return brief.brief_points(
        brief.brief_sales(ws("monthly_performance")),
        brief.brief_voice(ws("social_monthly")),
        ws("chat_orders_monthly"),
    )


on_table("period_kpis", "monthly_performance", brief.period_kpis)
on_table("incomplete_months", "monthly_performance", brief.incomplete_months)
on_table("coverage_by_month", "sales_monthly", brief.coverage_by_month)
on_table("mix_by_product_format", "product_mix_monthly", brief.mix_by_product_format)
on_table("mix_by_month_product", "product_mix_monthly", brief.mix_by_month_product)
on_table("channel_gap_flag", "budget_allocation", brief.channel_gap_flag)
on_table("repeat_customers", "chat_customers", brief.repeat_customers)
on_table("spend_kpis", "budget_allocation", brief.spend_kpis)
on_table("voice_totals", "social_monthly", brief.voice_totals)

# --- quality -----------------------------------------------------------------------------
QUERIES["quality_report"] = lambda spark, base: quality.quality_report(built(spark, base))
CHECKS = quality.row_checks(Params())


def _violations(name: str, table: str, check: str, *columns: str) -> None:
    on_table(
        name,
        table,
        lambda df: quality.violating_rows(df, CHECKS[table][check]).select(*columns),
    )


_violations("assert_accepted", "clean_chat_orders", "accepted_status", "order_ref", "status_raw")
_violations("assert_parsed_dates", "clean_campaigns", "parsed_dates",
            "platform", "campaign_name", "date_start_raw", "date_end_raw")
_violations("assert_mapped", "product_dimension", "mapped_sku", "product_sku")
_violations("assert_name_month", "campaign_attributes", "name_month_is_date_month",
            "campaign_name", "month", "campaign_month")
_violations("assert_predictions", "comments_enriched", "complete_predictions", "comment_id")


# Checks that nothing in the derived tables violates run over planted faults.
def on_faulty(name: str, source: str, build: Callable[[Workspace], DataFrame]) -> None:
    def run(spark: SparkSession, base: str) -> DataFrame:
        sources = dict(derive.DerivedSources(configure(spark), base))
        sources[source] = faults.SOURCE_FAULTS[source](sources[source])
        return build(Workspace(sources))

    QUERIES[name] = run


on_faulty(
    "assert_multiplier",
    "whatsapp_orders",
    lambda ws: quality.violating_rows(
        ws("order_items"), CHECKS["order_items"]["written_multiplier"]
    ).select("row_id", "segment", "quantity"),
)


@register("assert_range")
def _(ws):
    table = "budget_allocation"
    return quality.count_violations(ws(table), table, CHECKS[table])


@register("assert_identity")
def _(ws):
    table = "clean_pos_sales"
    return quality.count_violations(ws(table), table, CHECKS[table])


on_table("assert_unique", "clean_comments", lambda df: quality.assert_unique(df, "comment_id"))
on_faulty("assert_entity_keys", "pos_sales_daily",
          lambda ws: quality.assert_entity_keys(ws("clean_pos_sales")))


@register("assert_calendar_bounds")
def _(ws):
    tables = faults.damaged(ws)
    return quality.assert_calendar_bounds(tables("sales_calendar"), ws("clean_pos_sales"))


@register("assert_calendar_flags")
def _(ws):
    tables = faults.damaged(ws)
    return quality.assert_calendar_flags(tables("sales_calendar"), ws("clean_pos_sales"))


@register("assert_mix_reconciles")
def _(ws):
    tables = faults.damaged(ws)
    return quality.assert_mix_reconciles(tables("product_mix_monthly"), ws("sales_monthly"))


@register("reconcile_aggregates")
def _(ws):
    return quality.reconcile_aggregates(
        ws("sales_monthly"), ws("chat_orders_monthly"), "month", {"net_units_sold": "total_units"}
    )


@register("assert_chat_amounts")
def _(ws):
    tables = faults.damaged(ws)
    return quality.assert_chat_amounts(tables("chat_orders_monthly"), ws("order_quality"))


@register("assert_budget_total")
def _(ws):
    return quality.assert_budget_total(faults.damaged(ws)("budget_recommendation"), ws.params)


@register("assert_decided_channels")
def _(ws):
    return quality.assert_decided_channels(faults.damaged(ws)("budget_recommendation"), ws.params)


@register("campaign_totals")
def _(ws):
    return conform.campaign_totals(ws("campaign_rollup"))


@register("computed_budget")
def _(ws):
    """The recommendation with nothing decided: every amount is the computed one."""
    open_params = Params(decided_budget={})
    return marts.budget_recommendation(ws("channel_decision"), open_params).select(
        "channel", "proposed_budget_fcfa", "proposed_share", "allocation_source"
    )
