"""Check SQL of every registered query."""

from __future__ import annotations

import oracle.sources  # noqa: F401  (defines the table expressions)
import oracle.tables  # noqa: F401
from catalog.queries import CHECKS, PAIRS
from oracle import voice
from oracle.build import count_if, div, div_pos, half_up, isum, items, pct, query, text
from signals.functions import lexicon as lx
from signals.plans import marts
from signals.plans.metrics import METRICS

SQL: dict[str, str] = dict(voice.QUERIES)

WHOLE = [
    "clean_campaigns", "clean_media_plan", "clean_pos_sales", "clean_comments",
    "clean_chat_orders", "campaign_attributes", "sales_daily", "product_dimension", "sales_calendar",
    "order_quality", "media_reconciliation", "comments_enriched", "marketing_channel_monthly",
    "sales_monthly", "monthly_performance", "channel_performance_monthly",
    "product_mix_monthly", "chat_orders_monthly", "chat_customers", "social_monthly",
    "budget_allocation", "channel_evidence", "decision_budget", "channel_decision",
    "budget_recommendation", "pos_dimension",
]
for _name in WHOLE:
    SQL[_name] = f"SELECT * FROM t_{_name}"
SQL["order_items"] = """SELECT row_id, order_ref, received_at, customer_phone, items_text, amount_fcfa,
  status, delivery_zone, segment, product, format, quantity, parse_status, parse_failed
  FROM t_order_lines"""
SQL["load_summary"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count, {columns}::INTEGER AS column_count "
    f"FROM {table}"
    for name, table, columns in [
        ("campaign_spend_export", "r_campaigns", 8), ("media_plan", "r_plan", 8),
        ("pos_sales_daily", "r_pos", 8), ("whatsapp_orders", "r_orders", 7),
        ("social_comments", "r_comments", 8),
    ]
)
for _name, (_table, _columns) in PAIRS.items():
    _from = "t_order_lines" if _table == "order_items" else f"t_{_table}"
    SQL[_name] = f"SELECT {', '.join(_columns)}, count(*) AS row_count FROM {_from} GROUP BY ALL"

SQL |= {
    "plan_variance": "SELECT plan_id, planned_budget_fcfa, invoiced_fcfa, variance_fcfa, "
    "invoiced_available FROM t_clean_media_plan",
    "split_returns": f"""SELECT is_return, count(*) AS row_count, {isum("gross_units")}
      AS gross_units, {isum("return_units")} AS return_units,
      sum(gross_revenue_fcfa) AS gross_revenue_fcfa,
      sum(return_revenue_fcfa) AS return_revenue_fcfa FROM t_clean_pos_sales GROUP BY 1""",
    "net_revenue": """SELECT product_sku, count(revenue_fcfa) AS known_rows, count(*) AS row_count,
      sum(net_revenue_fcfa) AS net_revenue_fcfa FROM t_clean_pos_sales GROUP BY 1""",
    "technical_row_id": "SELECT row_id, order_ref, received_at, amount_fcfa FROM r_order_ids",
    "recon_variance_ratio": "SELECT month, channel, campaign_vs_invoiced_variance_fcfa, "
    "campaign_to_invoiced_ratio FROM t_media_reconciliation",
    # duplicates, filters, keys
    "drop_exact_duplicates": "SELECT DISTINCT * FROM r_campaigns",
    "drop_exact_duplicates_flagged": "SELECT comment_id, platform, post_id, published_at, "
    "author_handle, comment_text, like_count, reply_to_id, count(*) > 1 AS was_exact_duplicate "
    "FROM r_comments GROUP BY 1, 2, 3, 4, 5, 6, 7, 8",
    "split_order_items": r"""SELECT trim(s) AS segment, count(*) AS row_count FROM (
      SELECT unnest(regexp_split_to_array(regexp_replace(lower(regexp_replace(regexp_replace(
        items_text, '\([^)]*\)', '', 'g'), '\s+', ' ', 'g')), '\s+et\s+', '+', 'g'), '\+')) AS s
      FROM r_orders) GROUP BY 1""",
    "rows_in_months": "SELECT * FROM t_marketing_channel_monthly WHERE strftime(month, '%Y-%m') "
    "IN ('1997-03', '1998-11')",
    "members_in_closed_list": "SELECT * FROM t_marketing_channel_monthly "
    "WHERE channel IN ('Meta', 'Google')",
    "rows_where_key_repeats": "SELECT * FROM r_orders WHERE order_ref IN "
    "(SELECT order_ref FROM r_orders GROUP BY 1 HAVING count(*) > 1)",
    "rows_where_tuple_repeats": """SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY
      platform, campaign_name, date_start, date_end) AS n FROM r_campaigns) WHERE n > 1""",
    # profiling
    "profile_table": "UNPIVOT (SELECT 'campaign_spend_export' AS table_name, "
    "count(*) AS row_count, 8::BIGINT AS column_count, "
    "(SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM r_campaigns "
    "GROUP BY platform, campaign_name, date_start, date_end, spend, impressions, clicks, "
    "objective HAVING count(*) > 1)) AS duplicate_group_rows, "
    + ", ".join(
        f"count(*) - count({c}) AS null_{c}"
        for c in ["platform", "campaign_name", "date_start", "date_end", "spend", "impressions",
                  "clicks", "objective"]
    )
    + " FROM r_campaigns) ON COLUMNS(* EXCLUDE (table_name)) INTO NAME measure VALUE value",
    "value_counts": "SELECT platform AS label, count(*) AS row_count FROM r_comments GROUP BY 1",
    "missing_counts": "SELECT count(*) AS total_rows, count(*) - count(impressions) "
    "AS missing_impressions, count(*) - count(clicks) AS missing_clicks FROM r_campaigns",
    "planned_vs_invoiced": "SELECT channel, sum(planned_budget_fcfa) AS planned_fcfa, "
    "sum(invoiced_fcfa) AS invoiced_fcfa, sum(invoiced_fcfa) - sum(planned_budget_fcfa) "
    "AS variance_fcfa FROM r_plan GROUP BY channel",
    "date_span": "SELECT min(sale_date) AS min_date, max(sale_date) AS max_date, "
    "count(DISTINCT sale_date) AS distinct_days FROM r_pos",
    "rows_per_day": "SELECT sale_date AS day, count(*) AS row_count FROM r_pos GROUP BY 1",
    "id_name_conflicts": """SELECT pos_id AS key_value, count(DISTINCT pos_name) AS distinct_values,
      string_agg(DISTINCT pos_name, ' | ' ORDER BY pos_name) AS joined_values
      FROM r_faulty_pos GROUP BY 1 HAVING count(DISTINCT pos_name) > 1""",
    "name_id_conflicts": """SELECT pos_name AS key_value, count(DISTINCT pos_id) AS distinct_values,
      string_agg(DISTINCT pos_id, ' | ' ORDER BY pos_id) AS joined_values
      FROM r_faulty_pos GROUP BY 1 HAVING count(DISTINCT pos_id) > 1""",
    "store_id_conflicts": """SELECT pos_key AS key_value, count(DISTINCT pos_id) AS distinct_values,
      string_agg(DISTINCT pos_id, ' | ' ORDER BY pos_id) AS joined_values
      FROM t_clean_pos_sales GROUP BY 1 HAVING count(DISTINCT pos_id) > 1""",
    "negative_profile": f"""SELECT {count_if("units_sold < 0")} AS negative_unit_rows,
      (sum(units_sold) FILTER (WHERE units_sold < 0))::BIGINT AS negative_units,
      {count_if("revenue_fcfa < 0")} AS negative_revenue_rows,
      sum(revenue_fcfa) FILTER (WHERE revenue_fcfa < 0) AS negative_revenue_fcfa FROM r_pos""",
    "missing_dates": """SELECT day::DATE AS missing_day FROM (SELECT unnest(generate_series(
      min(sale_date)::TIMESTAMP, max(sale_date)::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM r_pos)
      WHERE day::DATE NOT IN (SELECT sale_date FROM r_pos)""",
    "repeated_keys": "SELECT order_ref, count(*) AS occurrences FROM r_orders GROUP BY 1 "
    "HAVING count(*) > 1",
    "repeated_comment_ids": "SELECT comment_id, count(*) AS occurrences FROM r_comments "
    "GROUP BY 1 HAVING count(*) > 1",
    "text_length_stats": f"""SELECT count(*) AS total, {count_if("trim(comment_text) = ''")}
      AS empty_comments, min(length(comment_text))::INTEGER AS min_length,
      sum(length(comment_text))::DOUBLE / count(comment_text) AS avg_length,
      max(length(comment_text))::INTEGER AS max_length FROM r_comments""",
    "posts_per_platform": "SELECT platform, count(DISTINCT post_id) AS distinct_posts "
    "FROM r_comments GROUP BY 1",
    "phone_length_profile": "SELECT length(regexp_replace(customer_phone, '[^0-9]', '', 'g'))"
    "::INTEGER AS digit_count, count(*) AS row_count FROM r_orders GROUP BY 1",
}

# --- comments ----------------------------------------------------------------------------



def _counts(table: str, *columns: str) -> str:
    return f"SELECT {', '.join(columns)}, count(*) AS row_count FROM {table} GROUP BY ALL"


_RAW_LABELS = f"""SELECT comment_id, lower(trim(language_human)) AS l,
  lower(trim(sentiment_human)) AS s,
  CASE WHEN product_human <> 'none' THEN lower(trim(theme_human)) END AS t,
  coalesce(lower(trim(is_spam_human)) IN ({items(lx.TRUTHY)}), false) AS is_spam FROM r_human"""
_KNOWN = {
    "l": f"coalesce(l IN ({items(lx.CLASSES['language'])}), false)",
    "s": f"coalesce(s IN ({items(lx.CLASSES['sentiment'])}), false)",
    "t": f"coalesce(t IN ({items(lx.CLASSES['theme'])}), false)",
}
_VERSIONED = (
    "SELECT *, CASE WHEN language_model = 'fr' THEN 'rules-1' ELSE 'rules-0' END "
    "AS classifier_version FROM t_predictions"
)
_PREDICTED = "SELECT * FROM t_predictions"
SQL |= {
    "classify_rules": "SELECT * FROM t_rules_done",
    "rule_language": _counts("t_rules", "rule_language"),
    "rule_sentiment": _counts("t_rules", "rule_sentiment"),
    "rule_theme": _counts("t_rules", "rule_theme"),
    "rule_product": _counts("t_rules", "rule_product"),
    "rule_spam": _counts("t_rules", "rule_is_spam"),
    "rules_complete": _counts("t_rules_done", "rules_complete", "rule_theme", "rule_is_spam"),
    "normalize_comment": "SELECT comment_id, n AS normal_text, b AS bare_text FROM t_text_flags",
    "emoji_only": "SELECT comment_id, rule_sentiment AS sentiment FROM t_rules "
    "JOIN t_text_flags USING (comment_id) WHERE emoji",
    "label_comments": _PREDICTED,
    "merge_rules_and_scores": _PREDICTED,
    "incremental_score": _PREDICTED,
    "compacted_log": _PREDICTED,
    "keep_last": _PREDICTED,
    "derive_product": _counts("t_predictions", "theme_model", "product_model"),
    "score_distinct_texts": """SELECT DISTINCT sha256(n) AS score_key, 'other' AS language,
      'neutral' AS sentiment, 'other' AS theme, false AS is_spam, '' AS coerced
      FROM t_rules_done JOIN t_text_flags USING (comment_id) WHERE NOT rules_complete""",
    "conform_labels": f"""SELECT comment_id,
      CASE WHEN {_KNOWN["l"]} THEN l ELSE 'other' END AS language,
      CASE WHEN {_KNOWN["s"]} THEN s ELSE 'neutral' END AS sentiment,
      CASE WHEN {_KNOWN["t"]} THEN t ELSE 'other' END AS theme, is_spam,
      concat_ws(',', CASE WHEN NOT {_KNOWN["l"]} THEN 'language' END,
        CASE WHEN NOT {_KNOWN["s"]} THEN 'sentiment' END,
        CASE WHEN NOT {_KNOWN["t"]} THEN 'theme' END) AS coerced FROM ({_RAW_LABELS})""",
    "run_summary": f"""UNPIVOT (SELECT count(*) AS total, {count_if("rules_complete")} AS rules_only,
      {count_if("model_used")} AS model_used, 0::BIGINT AS coerced_language,
      0::BIGINT AS coerced_sentiment, 0::BIGINT AS coerced_theme FROM t_predictions)
      ON COLUMNS(*) INTO NAME item VALUE comments""",
    "new_only": f"""SELECT comment_id, like_count FROM t_clean_comments WHERE comment_id NOT IN
      (SELECT comment_id FROM ({_VERSIONED}) WHERE classifier_version = 'rules-1')""",
    "single_version": f"""SELECT count(DISTINCT classifier_version) AS versions,
      count(*) AS predicted, (SELECT count(DISTINCT comment_id) FROM t_clean_comments)
      AS source_comments, count(DISTINCT classifier_version) = 1 AND count(*) =
      (SELECT count(DISTINCT comment_id) FROM t_clean_comments) AS consistent
      FROM ({_VERSIONED})""",
    "version_drift": " UNION ALL ".join(
        f"SELECT count(*) AS compared, '{f}' AS field, {count_if(f'{f}_model <> {v}')} AS changed, "
        f"{div(count_if(f'{f}_model <> {v}'), 'count(*)')} AS changed_share FROM t_predictions"
        for f, v in [("language", "'fr'"), ("sentiment", "'neutral'"), ("theme", "'other'"),
                     ("product", "'none'"), ("is_spam", "false")]
    ),
    "annotation_sample": """SELECT comment_id, platform, published_at, author_handle, comment_text,
      like_count, reply_to_id, '' AS language_human, '' AS sentiment_human, '' AS theme_human,
      '' AS product_human, '' AS is_spam_human, '' AS annotation_notes FROM t_clean_comments
      ORDER BY md5(comment_id || '|42'), comment_id LIMIT 50""",
    # evaluation
    "prediction_vs_human": "SELECT * FROM t_compared",
    "error_rows": "SELECT * EXCLUDE (exact_match) FROM t_compared WHERE NOT exact_match",
    "class_report": f"""SELECT field, label, coalesce({div("hits", "predicted")}, 0) AS precision,
      coalesce({div("hits", "support")}, 0) AS recall,
      coalesce({div("2 * hits", "support + predicted")}, 0) AS f1, support
      FROM (SELECT field, label, {count_if("truth AND same")} AS hits, {count_if("truth")} AS support,
          {count_if("NOT truth")} AS predicted FROM (
        SELECT field, human AS label, true AS truth, human = model AS same FROM t_pairs
        UNION ALL SELECT field, model, false, false FROM t_pairs) GROUP BY ALL)""",
    "field_errors": " UNION ALL ".join(
        f"SELECT count(*) AS evaluated, '{f}' AS field, {count_if(f'NOT {f}_match')} AS errors, "
        f"{div(count_if(f'NOT {f}_match'), 'count(*)')} AS error_rate FROM t_compared"
        for f in voice.FIELDS
    ),
    "unmatched_labels": """SELECT count(*) AS unmatched FROM r_human h WHERE NOT EXISTS (
      SELECT 1 FROM t_predictions p WHERE p.comment_id = h.comment_id
      AND p.comment_text = h.comment_text)""",
    "label_normalise": voice.norm_human("r_human"),
    "constant_baseline": f"""SELECT field, label AS majority_label,
      {div("n", "total")} AS accuracy FROM (
        SELECT *, sum(n) OVER (PARTITION BY field) AS total,
          row_number() OVER (PARTITION BY field ORDER BY n DESC, label) AS place
        FROM (SELECT field, label, count(*) AS n FROM (
          UNPIVOT (SELECT language_human AS language, sentiment_human AS sentiment,
            theme_human AS theme, product_human AS product, is_spam_human::VARCHAR AS is_spam
            FROM ({voice.norm_human("r_human")})) ON COLUMNS(*) INTO NAME field VALUE label)
        GROUP BY ALL)) WHERE place = 1""",
    "merge_refusals": f"""WITH ready AS (SELECT * FROM r_human_next
        WHERE is_spam_human IN ('true', 'false'))
      SELECT comment_id, 'sentiment_human' AS reason FROM ready WHERE language_human = 'FR'
        OR lower(trim(sentiment_human)) NOT IN ({items(lx.CLASSES["sentiment"])})
      UNION ALL SELECT comment_id, 'language_human' FROM ready
        WHERE lower(language_human) NOT IN ({items(lx.CLASSES["language"])})
      UNION ALL SELECT comment_id, 'theme_human' FROM ready
        WHERE theme_human NOT IN ({items(lx.CLASSES["theme"])})
      UNION ALL SELECT comment_id, 'product_human' FROM ready
        WHERE product_human NOT IN ({items(lx.CLASSES["product"])})
      UNION ALL SELECT comment_id, 'already_labelled' FROM ready
        WHERE comment_id IN (SELECT comment_id FROM r_human_first)""",
    "merge_validated": """SELECT *, 'merged' AS part FROM r_human_first
      UNION ALL SELECT *, CASE WHEN is_spam_human IN ('true', 'false') THEN 'merged'
        ELSE 'remaining' END FROM r_human_next WHERE language_human <> 'FR'""",
}

# --- metrics -----------------------------------------------------------------------------


def _metric_sql(expression: str) -> str:
    """Registry expression in the check dialect, with its result type."""
    sql = expression.replace("1.0D", "1.0::DOUBLE")
    if "try_divide(" in sql:
        head, _, tail = sql.partition("try_divide(")
        depth, cut, parts = 1, 0, []
        for i, char in enumerate(tail):
            depth += (char == "(") - (char == ")")
            if depth == 1 and char == ",":
                parts.append(tail[:i])
                cut = i + 1
            if depth == 0:
                parts.append(tail[cut:i])
                break
        return head + div(*parts)
    return sql if "_fcfa" in sql or "_share" in sql else f"({sql})::BIGINT"


def metric(name: str, dimensions=(), where: str = "true") -> str:
    m = METRICS[name]
    columns = [f"{_metric_sql(m.expression)} AS {name}"]
    columns += [f"{_metric_sql(e)} AS {c}" for c, e in m.components.items()]
    group = f" GROUP BY {', '.join(dimensions)}" if dimensions else ""
    sql = f"SELECT {', '.join([*dimensions, *columns])} FROM t_{m.table} WHERE {where}{group}"
    return sql.replace("count_if(is_repeat_customer)", count_if("is_repeat_customer")).replace(
        "count_if(has_delivered_order)", count_if("has_delivered_order")
    )


_GROWTH = """SELECT month, net_revenue_fcfa / nullif(lag(net_revenue_fcfa) OVER (ORDER BY month), 0)
  - 1 AS revenue_growth FROM t_sales_monthly"""
for _name, _m in METRICS.items():
    SQL[f"metric_{_name}"] = metric(_name, _m.dimensions)
SQL["metric_revenue_growth"] = _GROWTH
_SENTIMENTS = ["sentiment_split", "positive", "negative", "neutral"]
SQL |= {
    "metric_total": metric("net_revenue"),
    "metric_month_filter": metric("spend", ("channel",), "month = DATE '1997-12-01'"),
    "metric_since_filter": metric("net_revenue", ("month",), "month >= DATE '2000-06-01'"),
    "metric_relative_window": metric(
        "sentiment_split", ("month",),
        "month >= (SELECT max(month) - INTERVAL 2 MONTH FROM t_social_monthly)",
    ),
    "metric_member_filters": metric(
        "product_mix", ("month", "product"),
        "month >= DATE '2000-01-01' AND product IN ('bissap', 'gingembre')",
    ),
    "metric_platform_filter": metric(
        "theme_split", ("month",), "platform IN ('Instagram', 'Facebook')"
    ),
    "metric_channel_filter": metric("spend", ("month",), "channel = 'Meta'"),
    "latest_month": "SELECT max(month) AS latest_month FROM t_sales_monthly",
    "latest_month_of_year": "SELECT max(month) FILTER (WHERE month(month) = 12) AS latest_month "
    "FROM t_sales_monthly",
    "with_previous_month": f"""SELECT a.channel, a.spend, b.spend AS previous_spend
      FROM ({metric("spend", ("channel",), "month = DATE '1998-01-01'")}) a
      LEFT JOIN ({metric("spend", ("channel",), "month = DATE '1997-12-01'")}) b USING (channel)""",
    "previous_by_month": f"""SELECT a.*, {", ".join(f"b.{s} AS previous_{s}" for s in _SENTIMENTS)}
      FROM ({metric("sentiment_split", ("month",))}) a
      LEFT JOIN ({metric("sentiment_split", ("month",))}) b
      ON a.month = (b.month + INTERVAL 1 MONTH)::DATE""",
    "several_metrics": " UNION ALL ".join(
        f"SELECT month, '{n}' AS metric, {n}::DOUBLE AS value FROM ({metric(n, ('month',))})"
        for n in ("net_revenue", "spend", "delivered_orders")
    ),
    "metric_bounds_check": " UNION ALL ".join(
        f"SELECT metric, value, low, high, coalesce(value BETWEEN low AND high, false) AS passed "
        f"FROM (SELECT '{n}' AS metric, {n}::DOUBLE AS value, "
        + (
            f"({' + '.join(m.components)})::DOUBLE AS low, "
            f"({' + '.join(m.components)})::DOUBLE AS high"
            if m.components
            else f"{m.bounds[0]}::DOUBLE AS low, {m.bounds[1]}::DOUBLE AS high"
        )
        + f" FROM ({metric(n)}))"
        for n, m in METRICS.items()
        if m.bounds or m.components
    ),
}


# --- trends ------------------------------------------------------------------------------
def direction(change: str, threshold: float) -> str:
    return (
        f"CASE WHEN abs({change}) < {threshold}::DOUBLE THEN 'stable' WHEN {change} > 0 THEN 'up' "
        f"WHEN {change} < 0 THEN 'down' END"
    )


_SPEND = "SELECT channel AS category, sum(campaign_spend_fcfa) AS value FROM " \
    "t_marketing_channel_monthly GROUP BY 1"  # fmt: skip
_PLACED = f"""SELECT category, value, {div("value", "sum(value) OVER ()")} AS share,
  CASE WHEN up = 1 THEN 'first' WHEN up = 2 THEN 'second' WHEN down = 1 THEN 'last' END AS place,
  sum(value) OVER () AS total_value FROM (
    SELECT *, row_number() OVER (ORDER BY value DESC, category) AS up,
      row_number() OVER (ORDER BY value, category DESC) AS down FROM ({_SPEND}))"""
_MONTHS = "SELECT month, sum(campaign_spend_fcfa) AS v FROM t_marketing_channel_monthly GROUP BY 1"
_SHARES = f"""SELECT month, product_sku AS category, {div("sum(net_revenue_fcfa)",
  "sum(sum(net_revenue_fcfa)) OVER (PARTITION BY month)")} AS share
  FROM t_product_mix_monthly GROUP BY month, product_sku"""
_CHANGE = div("last_value - first_value", "abs(first_value)")
_RECENT = div("last_value - previous_value", "abs(previous_value)")


def _sentiment_shares(key: str) -> str:
    return f"""SELECT {key}, {div("sum(positive_comments_count)", "sum(non_spam_comments_count)")}
      AS good, {div("sum(negative_comments_count)", "sum(non_spam_comments_count)")} AS bad
      FROM t_social_monthly GROUP BY 1 HAVING sum(non_spam_comments_count) > 0"""


def _one(column: str, source: str, order: str) -> str:
    return f"(SELECT {column} FROM ({source}) ORDER BY {order} LIMIT 1)"


_BY_MONTH, _BY_PLATFORM = _sentiment_shares("month"), _sentiment_shares("platform")
_NAMED = {t: c for t, c in marts.THEME_COLUMNS.items() if t != "other"}
_LONG_THEMES = " UNION ALL ".join(
    f"SELECT {i} AS i, '{t}' AS label, {isum(c)} AS comments FROM t_social_monthly"
    for i, (t, c) in enumerate(_NAMED.items())
)
SQL |= {
    "variation": f"""SELECT month, value, previous_value, change, {direction("change", 0.01)}
      AS trend FROM (SELECT *, {div("value - previous_value", "abs(previous_value)")} AS change
        FROM (SELECT month, net_revenue_fcfa AS value,
          lag(net_revenue_fcfa) OVER (ORDER BY month) AS previous_value FROM t_sales_monthly))""",
    "monthly_trend": f"""SELECT *, {direction("change", 0.01)} AS trend,
        {direction("recent_change", 0.01)} AS recent_trend FROM (
      SELECT * EXCLUDE (previous_value), {_CHANGE} AS change, {_RECENT} AS recent_change FROM (
      SELECT count(*)::INTEGER AS months, min(month) AS first_month,
        arg_min(v, month) AS first_value, max(month) AS last_month,
        arg_max(v, month) AS last_value,
        CASE WHEN count(*) >= 3 THEN max(month) FILTER (WHERE back = 2) END AS previous_month,
        CASE WHEN count(*) >= 3 THEN max(v) FILTER (WHERE back = 2) END AS previous_value,
        sum(v) AS total_value, min(month) FILTER (WHERE top = 1) AS best_month, max(v) AS best_value,
        min(month) FILTER (WHERE low = 1) AS worst_month, min(v) AS worst_value
      FROM (SELECT month, net_revenue_fcfa AS v, row_number() OVER (ORDER BY month DESC) AS back,
        row_number() OVER (ORDER BY net_revenue_fcfa DESC, month) AS top,
        row_number() OVER (ORDER BY net_revenue_fcfa, month) AS low FROM t_sales_monthly)))""",
    "category_breakdown": _PLACED,
    "share_trend": f"""SELECT *, {direction("share_change", 0.01)} AS trend FROM (
      SELECT *, last_share - first_share AS share_change FROM (
      SELECT category, (SELECT min(month) FROM t_product_mix_monthly) AS first_month, first_share,
        (SELECT max(month) FROM t_product_mix_monthly) AS last_month, last_share FROM (
        SELECT category, sum(share) AS weight,
          max(share) FILTER (WHERE month = (SELECT min(month) FROM t_product_mix_monthly))
            AS first_share,
          max(share) FILTER (WHERE month = (SELECT max(month) FROM t_product_mix_monthly))
            AS last_share FROM ({_SHARES}) GROUP BY category)
      ORDER BY weight DESC, category LIMIT 1))""",
    "month_category": f"""SELECT *, {_one("month", _MONTHS, "v DESC, month")} AS best_month,
      (SELECT max(v) FROM ({_MONTHS})) AS best_value,
      {_one("month", _MONTHS, "v, month")} AS worst_month,
      (SELECT min(v) FROM ({_MONTHS})) AS worst_value FROM ({_PLACED})""",
    "ranking": f"""SELECT category, value, {div("value", "total")} AS share FROM (
      SELECT *, sum(value) OVER () AS total FROM ({_SPEND}))
      ORDER BY value DESC, category LIMIT 3""",
    "ranking_lowest": f"""SELECT month AS category, v AS value, {div("v", "total")} AS share
      FROM (SELECT *, sum(v) OVER () AS total FROM ({_MONTHS})) ORDER BY v, month LIMIT 3""",
    "compare_members": f"""WITH rows AS (SELECT * FROM t_marketing_channel_monthly
        WHERE channel IN ('Meta', 'TikTok')),
      sums AS (SELECT channel, sum(campaign_spend_fcfa) AS v FROM rows GROUP BY 1),
      lead AS (SELECT * FROM sums ORDER BY v DESC, channel LIMIT 1),
      second AS (SELECT * FROM sums ORDER BY v DESC, channel LIMIT 1 OFFSET 1),
      pairs AS (SELECT month, sum(campaign_spend_fcfa) FILTER (
          WHERE channel = (SELECT channel FROM lead)) AS a, sum(campaign_spend_fcfa) FILTER (
          WHERE channel = (SELECT channel FROM second)) AS b FROM rows GROUP BY 1)
      SELECT l.channel AS leader, s.channel AS runner_up, l.v AS leader_value,
        s.v AS runner_up_value, (SELECT count(*) FROM sums) AS members, l.v - s.v AS gap,
        {div_pos("l.v", "s.v")} AS times, (SELECT count(*) FROM sums) = 2 AND l.v = s.v AS is_tie,
        (SELECT {count_if("a > b")} FROM pairs) AS months_ahead,
        (SELECT {count_if("a IS NOT NULL AND b IS NOT NULL")} FROM pairs) AS months_compared
      FROM lead l, second s""",
    "ratio_by_category": f"""WITH s AS (SELECT * FROM ({metric("positive_share", ("platform",))})
        WHERE positive_share IS NOT NULL)
      SELECT (SELECT count(*) FROM s) AS categories,
        (SELECT platform FROM s ORDER BY positive_share DESC, platform LIMIT 1) AS highest,
        (SELECT max(positive_share) FROM s) AS highest_share,
        (SELECT platform FROM s ORDER BY positive_share, platform LIMIT 1) AS lowest,
        (SELECT min(positive_share) FROM s) AS lowest_share""",
    "points_label": f"""SELECT month, points, {direction("points", 0.005)} AS trend FROM (
      SELECT a.month, a.positive_share - b.positive_share AS points
      FROM ({metric("positive_share", ("month",))}) a
      JOIN ({metric("positive_share", ("month",))}) b
      ON a.month = (b.month + INTERVAL 1 MONTH)::DATE)""",
    "sentiment_summary": f"""SELECT *, {direction("positive_share_change", 0.01)}
        AS positive_share_trend FROM (
      SELECT *, last_positive_share - first_positive_share AS positive_share_change FROM (
      SELECT usable, positive, neutral, negative, {div("positive", "usable")} AS positive_share,
        {div("neutral", "usable")} AS neutral_share, {div("negative", "usable")} AS negative_share,
        CASE WHEN least(positive, negative) > 0 AND positive <> negative
          THEN greatest(positive, negative)::DOUBLE / least(positive, negative) END
          AS balance_ratio,
        CASE WHEN positive > negative THEN 'positive' WHEN negative > positive THEN 'negative'
          ELSE 'even' END AS prevailing,
        {_one("good", _BY_MONTH, "month")} AS first_positive_share,
        {_one("good", _BY_MONTH, "month DESC")} AS last_positive_share,
        {_one("month", _BY_MONTH, "bad DESC, month")} AS worst_month,
        {_one("bad", _BY_MONTH, "bad DESC, month")} AS worst_month_negative_share,
        {_one("platform", _BY_PLATFORM, "good DESC, platform")} AS best_platform,
        {_one("platform", _BY_PLATFORM, "good, platform")} AS lowest_platform,
        {_one("platform", _BY_PLATFORM, "bad DESC, platform")} AS most_negative_platform
      FROM (SELECT {isum("non_spam_comments_count")} AS usable,
        {isum("positive_comments_count")} AS positive, {isum("neutral_comments_count")} AS neutral,
        {isum("negative_comments_count")} AS negative FROM t_social_monthly)))""",
    "top_themes": f"""SELECT position::INTEGER AS position, label, comments,
      {div("comments", "(SELECT sum(non_spam_comments_count) FROM t_social_monthly)")} AS share
      FROM (SELECT *, row_number() OVER (ORDER BY comments DESC, i) AS position
        FROM ({_LONG_THEMES}) WHERE comments > 0) WHERE position <= 3""",
    "month_pivot": "SELECT month, "
    + ", ".join(
        f"sum(net_revenue_fcfa) FILTER (WHERE product = '{p}') AS {p}"
        for p in ("bissap", "gingembre", "bouye")
    )
    + " FROM t_product_mix_monthly GROUP BY month",
}

# --- brief and pages ---------------------------------------------------------------------
_SENT = list(marts.SENTIMENT_COLUMNS.values())
_VOICE_SUMS = "SELECT month, " + ", ".join(
    f"{isum(c)} AS {c}"
    for c in ["comments_count", "unique_comments_count", "spam_comments_count", *_SENT,
              *marts.THEME_COLUMNS.values()]
) + " FROM t_social_monthly GROUP BY month"
_ALL3 = " + ".join(_SENT)
_DECLARED = [
    "taste", "price", "promotion", "availability", "packaging", "health", "delivery", "service",
    "product_question", "other",
]
_SALES = f"""SELECT month, net_revenue_fcfa AS revenue_fcfa, previous_month,
  previous_revenue_fcfa, revenue_growth_pct, CASE WHEN revenue_growth_pct > 0 THEN 'up'
    WHEN revenue_growth_pct < 0 THEN 'down' WHEN revenue_growth_pct = 0 THEN 'flat'
    ELSE 'unknown' END AS revenue_direction, net_units_sold, active_pos, active_communes,
  observed_sales_days, calendar_days, missing_sales_days, return_rate_revenue
  FROM (SELECT *, {half_up(div("net_revenue_fcfa - previous_revenue_fcfa",
                               "previous_revenue_fcfa") + " * 100", 1)} AS revenue_growth_pct
    FROM (SELECT *, lag(month) OVER (ORDER BY month) AS previous_month,
      lag(net_revenue_fcfa) OVER (ORDER BY month) AS previous_revenue_fcfa
      FROM t_monthly_performance))"""
_POINTS = [
    ("attention", "revenue_down", "revenue_growth_pct < 0"),
    ("attention", "sales_days_missing", "missing_sales_days > 0"),
    ("attention", "negative_over_positive", "negative_comments_count > positive_comments_count"),
    ("attention", "amounts_missing", "delivered_amount_missing_orders > 0"),
    ("positive", "revenue_up", "revenue_growth_pct > 0"),
    ("positive", "positive_over_negative", "positive_comments_count > negative_comments_count"),
]
SQL |= {
    "brief_sales": _SALES,
    "brief_channels": f"""SELECT month, channel, campaign_spend_fcfa AS spend_fcfa,
      CASE WHEN total > 0 THEN {pct("campaign_spend_fcfa", "total")} END AS share_pct,
      planned_budget_fcfa, invoiced_fcfa, campaign_vs_invoiced_variance_fcfa AS variance_fcfa,
      source_coverage, (row_number() OVER (PARTITION BY month
        ORDER BY campaign_spend_fcfa DESC, channel))::INTEGER AS spend_position
      FROM (SELECT *, sum(campaign_spend_fcfa) OVER (PARTITION BY month) AS total
        FROM t_marketing_channel_monthly WHERE month IS NOT NULL)""",
    "brief_voice": f"""SELECT month, comments_count, unique_comments_count, spam_comments_count,
      {", ".join(_SENT)}, CASE greatest({", ".join(_SENT)}) WHEN 0 THEN 'unknown'
        WHEN positive_comments_count THEN 'positive' WHEN negative_comments_count THEN 'negative'
        ELSE 'neutral' END AS sentiment_majority,
      {", ".join(f"{pct(c, _ALL3)} AS {s}_share_pct" for s, c in marts.SENTIMENT_COLUMNS.items())}
      FROM ({_VOICE_SUMS})""",
    "brief_themes": f"""SELECT month, position::INTEGER AS position, label, comments FROM (
      SELECT *, row_number() OVER (PARTITION BY month ORDER BY comments DESC, i) AS position FROM (
      {" UNION ALL ".join(
          f"SELECT month, {i} AS i, '{t}' AS label, {marts.THEME_COLUMNS[t]} AS comments "
          f"FROM ({_VOICE_SUMS})" for i, t in enumerate(_DECLARED))}) WHERE comments > 0)
      WHERE position <= 3""",
    "brief_products": f"""SELECT month, position::INTEGER AS position, product, format, product_sku,
      net_units, net_revenue_fcfa, {half_up("coalesce(revenue_share_of_month, 0) * 100", 1)}
        AS revenue_share_pct FROM (SELECT *, row_number() OVER (PARTITION BY month
          ORDER BY net_revenue_fcfa DESC, product_sku) AS position FROM t_product_mix_monthly)
      WHERE position <= 5""",
    "brief_chat_orders": "SELECT month, orders, delivered_orders, cancelled_orders, "
    "pending_orders, total_units, bissap_units, gingembre_units, bouye_units, "
    "delivered_known_amount_fcfa, delivered_amount_missing_orders, "
    "delivered_outlier_amount_orders FROM t_chat_orders_monthly",
    "brief_points": " UNION ALL ".join(
        f"SELECT s.month, '{kind}' AS kind, '{point}' AS point FROM ({_SALES}) s "
        f"LEFT JOIN ({_VOICE_SUMS}) v USING (month) "
        f"LEFT JOIN t_chat_orders_monthly c USING (month) WHERE {cond}"
        for kind, point, cond in _POINTS
    ),
    "period_kpis": f"""SELECT count(*) AS months, sum(net_revenue_fcfa) AS net_revenue_fcfa,
      {isum("net_units_sold")} AS net_units_sold, sum(campaign_spend_fcfa) AS campaign_spend_fcfa,
      {count_if("missing_sales_days > 0")} AS incomplete_months,
      {count_if("missing_sales_days IS NULL")} AS unknown_months FROM t_monthly_performance""",
    "incomplete_months": "SELECT month, CASE WHEN missing_sales_days IS NULL THEN 'unknown' "
    "ELSE 'incomplete' END AS coverage FROM t_monthly_performance "
    "WHERE coalesce(missing_sales_days, 1) > 0",
    "coverage_by_month": f"""SELECT month, observed_sales_days, calendar_days,
      {pct("observed_sales_days", "calendar_days")} AS coverage_pct FROM t_sales_monthly""",
    "mix_by_product_format": f"""SELECT product, format, {isum("net_units")} AS net_units,
      sum(net_revenue_fcfa) AS net_revenue_fcfa, {half_up("sum(net_litres)", 2)} AS net_litres,
      {div("sum(net_revenue_fcfa)", "sum(sum(net_revenue_fcfa)) OVER ()")} AS revenue_share,
      {half_up(div("sum(net_revenue_fcfa)", "sum(net_litres)"), 2)} AS net_revenue_per_litre_fcfa
      FROM t_product_mix_monthly GROUP BY product, format""",
    "mix_by_month_product": "SELECT month, product, sum(net_revenue_fcfa) AS net_revenue_fcfa "
    "FROM t_product_mix_monthly GROUP BY ALL",
    "channel_gap_flag": f"""SELECT channel, campaign_spend_fcfa, invoiced_fcfa,
      campaign_spend_fcfa = 0 AND invoiced_fcfa > 0 AS billed_without_spend,
      {div("campaign_spend_fcfa", "max(campaign_spend_fcfa) OVER ()")} AS spend_vs_largest
      FROM t_budget_allocation""",
    "repeat_customers": f"""SELECT {count_if("has_delivered_order")} AS delivered_customers,
      {count_if("is_repeat_customer")} AS repeat_customers FROM t_chat_customers""",
    "spend_kpis": f"""SELECT sum(campaign_spend_fcfa) AS campaign_spend_fcfa,
      sum(planned_budget_fcfa) AS planned_budget_fcfa, sum(invoiced_fcfa) AS invoiced_fcfa,
      {div("sum(campaign_spend_fcfa)", "sum(planned_budget_fcfa)")} AS spend_vs_plan
      FROM t_budget_allocation""",
    "voice_totals": " UNION ALL ".join(
        f"SELECT '{c}' AS label, {isum(c)} AS comments FROM t_social_monthly"
        for c in [*_SENT, *marts.THEME_COLUMNS.values(), *marts.PRODUCT_COLUMNS.values(),
                  "rules_complete_count", "model_used_count"]
    ),
}

# --- quality -----------------------------------------------------------------------------
# Rules whose wording differs between the engines.
_RULES = {
    ("order_items", "written_multiplier"): r"(regexp_matches(segment, '^\s*[0-9]+\s*x\s*[a-z]') OR "
    r"regexp_matches(segment, '^\s*[0-9]+\s+(bissap|gingembre|bouye)')) AND quantity <> "
    r"try_cast(regexp_extract(segment, '([0-9]+)', 1) AS INTEGER)",
    ("order_quality", "plausible_amounts"): "(amount_outlier AND amount_plausible_fcfa IS NOT NULL)"
    " OR amount_plausible_fcfa > 100000 OR (amount_missing AND amount_outlier) OR "
    "(amount_fcfa IS NOT NULL AND NOT amount_outlier AND amount_plausible_fcfa IS NULL)",
}


def _table(name: str) -> str:
    return "t_order_lines" if name == "order_items" else f"t_{name}"


def _rule(table: str, check: str) -> str:
    return _RULES.get((table, check), CHECKS[table][check])


def _check_counts(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, "
        f"{count_if(_rule(table, check))} AS violations FROM {_table(table)}"
        for check in CHECKS[table]
    )


_UNIQUE = "SELECT {k}, count(*) AS occurrences FROM {t} WHERE {k} IS NOT NULL GROUP BY 1 " \
    "HAVING count(*) > 1"  # fmt: skip
_MIX = """SELECT month, s.net_units_sold AS a_net_units_sold,
  s.net_revenue_fcfa AS a_net_revenue_fcfa, s.gross_revenue_fcfa AS a_gross_revenue_fcfa,
  m.net_units AS b_net_units, m.net_revenue_fcfa AS b_net_revenue_fcfa,
  m.gross_revenue_fcfa AS b_gross_revenue_fcfa FROM t_sales_monthly s FULL JOIN (
    SELECT month, sum(net_units)::BIGINT AS net_units, sum(net_revenue_fcfa) AS net_revenue_fcfa,
      sum(gross_revenue_fcfa) AS gross_revenue_fcfa FROM t_product_mix_monthly GROUP BY 1) m
  USING (month) WHERE s.net_units_sold IS DISTINCT FROM m.net_units
    OR s.net_revenue_fcfa IS DISTINCT FROM m.net_revenue_fcfa
    OR s.gross_revenue_fcfa IS DISTINCT FROM m.gross_revenue_fcfa"""
SQL |= {
    "assert_accepted": "SELECT order_ref, status_raw FROM t_clean_chat_orders "
    "WHERE status NOT IN ('delivered', 'cancelled', 'pending')",
    "assert_parsed_dates": "SELECT platform, campaign_name, date_start_raw, date_end_raw "
    "FROM t_clean_campaigns WHERE date_start IS NULL OR date_end IS NULL",
    "assert_mapped": "SELECT product_sku FROM t_product_dimension "
    "WHERE product IS NULL OR format IS NULL OR volume_litres IS NULL",
    "assert_name_month": "SELECT campaign_name, month, campaign_month FROM t_campaign_attributes "
    "WHERE campaign_month <> month",
    "assert_predictions": "SELECT comment_id FROM t_comments_enriched "
    "WHERE language_model IS NULL OR theme_model IS NULL OR is_spam_model IS NULL",
    "assert_multiplier": "SELECT row_id, segment, quantity FROM t_faulty_lines WHERE "
    + _RULES["order_items", "written_multiplier"],
    "assert_range": _check_counts("budget_allocation"),
    "assert_identity": _check_counts("clean_pos_sales"),
    "assert_unique": _UNIQUE.format(k="comment_id", t="t_clean_comments"),
    "assert_entity_keys": """SELECT pos_id, count(DISTINCT pos_key) AS n_keys FROM t_clean_pos_sales
      GROUP BY 1 HAVING count(DISTINCT pos_key) <> 1
      UNION ALL SELECT pos_key, count(DISTINCT pos_id) FROM t_clean_pos_sales
      GROUP BY pos_key, sale_date HAVING count(DISTINCT pos_id) > 1""",
    "assert_calendar_bounds": """SELECT 'sale_outside_calendar' AS issue, sale_date AS detail
      FROM t_clean_pos_sales WHERE sale_date NOT IN (SELECT sale_date FROM t_sales_calendar)
      UNION ALL SELECT 'not_month_start', min(sale_date) FROM t_sales_calendar
      HAVING day(min(sale_date)) <> 1
      UNION ALL SELECT 'not_month_end', max(sale_date) FROM t_sales_calendar
      HAVING max(sale_date) <> last_day(max(sale_date))""",
    "assert_calendar_flags": """SELECT c.sale_date, is_missing_sales_day, count(p.sale_date)
      AS pos_rows FROM t_sales_calendar c LEFT JOIN t_clean_pos_sales p USING (sale_date)
      GROUP BY ALL HAVING is_missing_sales_day = (count(p.sale_date) > 0)""",
    "assert_mix_reconciles": _MIX,
    "reconcile_aggregates": """SELECT month, net_units_sold AS a_net_units_sold,
      total_units AS b_total_units FROM t_sales_monthly FULL JOIN t_chat_orders_monthly
      USING (month) WHERE net_units_sold IS DISTINCT FROM total_units""",
    "assert_chat_amounts": """SELECT month FROM t_chat_orders_monthly JOIN (
      SELECT month, sum(CASE WHEN amount_fcfa <= 100000 THEN amount_fcfa ELSE 0 END) AS a,
        sum(CASE WHEN amount_fcfa > 100000 THEN amount_fcfa ELSE 0 END) AS b
      FROM t_order_quality GROUP BY 1) USING (month)
      WHERE known_order_amount_fcfa <> a OR outlier_amount_fcfa <> b
        OR delivered_known_amount_fcfa > known_order_amount_fcfa""",
    "assert_budget_total": """SELECT sum(proposed_budget_fcfa) AS total_proposed_fcfa
      FROM t_budget_recommendation HAVING abs(sum(proposed_budget_fcfa) - 15000000) > 1""",
    "assert_decided_channels": f"""SELECT channel FROM (VALUES {", ".join(
        f"({text(c)})" for c in oracle.tables.DECIDED_BUDGET)}) AS d(channel)
      WHERE channel NOT IN (SELECT channel FROM t_budget_recommendation)""",
    "campaign_totals": "SELECT month, channel, campaign_spend_fcfa, campaign_rows, impressions, "
    "clicks FROM t_media_reconciliation WHERE campaign_rows IS NOT NULL",
    "computed_budget": """SELECT channel, computed_budget_fcfa AS proposed_budget_fcfa,
      computed_budget_fcfa / 15000000.0::DOUBLE AS proposed_share,
      'calculé' AS allocation_source FROM t_budget_computed""",
}
_FAULTY = {
    "assert_entity_keys": {"t_clean_pos_sales": "t_faulty_pos"},
    "assert_calendar_bounds": {"t_sales_calendar": "t_faulty_calendar"},
    "assert_calendar_flags": {"t_sales_calendar": "t_faulty_calendar"},
    "assert_mix_reconciles": {"t_product_mix_monthly": "t_faulty_mix"},
    "assert_chat_amounts": {"t_chat_orders_monthly": "t_faulty_chat"},
    "assert_budget_total": {"t_budget_recommendation": "t_faulty_budget"},
    "assert_decided_channels": {"t_budget_recommendation": "t_faulty_budget"},
}
# The report checks the good tables; the queries of single checks, the damaged ones.
_GOOD = {name: SQL[name] for name in _FAULTY}
for _name, _tables in _FAULTY.items():
    for _good, _bad in _tables.items():
        SQL[_name] = SQL[_name].replace(_good, _bad)
_RELATIONS = [
    ("unique_comment_id", "clean_comments", SQL["assert_unique"]),
    *[
        (f"unique_{k}", t, _UNIQUE.format(k=k, t=f"t_{t}"))
        for t, k in [("sales_calendar", "sale_date"), ("comments_enriched", "comment_id"),
                     ("pos_dimension", "pos_key"), ("product_dimension", "product_sku"),
                     ("chat_customers", "customer_key"), ("order_quality", "row_id")]
    ],
    ("calendar_bounds", "sales_calendar", _GOOD["assert_calendar_bounds"]),
    ("calendar_flags", "sales_calendar", _GOOD["assert_calendar_flags"]),
    ("entity_keys", "clean_pos_sales", _GOOD["assert_entity_keys"]),
    ("mix_reconciles", "product_mix_monthly", _MIX),
    ("amounts_reconcile", "chat_orders_monthly", _GOOD["assert_chat_amounts"]),
    ("budget_total", "budget_recommendation", _GOOD["assert_budget_total"]),
    ("decided_channels", "budget_recommendation", _GOOD["assert_decided_channels"]),
]
SQL["quality_report"] = (
    "SELECT *, violations = 0 AS passed FROM ("
    + " UNION ALL ".join(_check_counts(t) for t in CHECKS)
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, count(*) AS violations "
        f"FROM ({sql})"
        for check, table, sql in _RELATIONS
    )
    + ")"
)

ORACLE = {name: query(sql) for name, sql in SQL.items()}
