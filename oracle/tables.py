"""Cleaning layer, conformed tables and marts in DuckDB SQL, written for checking only."""

from __future__ import annotations

import re

from oracle.build import CTES, count_if, define, div, div_pos, isum, items, pct, text
from signals.functions import labels as lb
from signals.functions.dates import MONTHS, MONTHS_PLAIN
from signals.params import DECIDED_BUDGET
from signals.plans import marts


def mapped(column: str, mapping, fallback: str) -> str:
    key = f"lower(trim({column}))"
    arms = " ".join(f"WHEN {key} IN ({items(al)}) THEN {text(to)}" for to, al in mapping.items())
    return f"CASE {arms} ELSE {fallback} END"


def trimmed(column: str) -> str:
    return f"trim({column})"


def read_date(column: str) -> str:
    low, pattern = f"lower(trim({column}))", r"'^([0-9]{1,2}) (\p{L}+) ([0-9]{4})$'"
    part = [f"regexp_extract({low}, {pattern}, {i})" for i in (1, 2, 3)]
    return (
        f"coalesce(try_strptime(trim({column}), '%Y-%m-%d')::DATE, "
        f"try_strptime(trim({column}), '%d/%m/%Y')::DATE, try_cast({part[2]} || '-' || "
        f"list_position([{items(MONTHS)}], {part[1]}) || '-' || {part[0]} AS DATE))"
    )


define(
    "t_clean_campaigns",
    f"""
SELECT *, date_trunc('month', date_start)::DATE AS month,
  CASE WHEN spend_currency = 'EUR' THEN 655.0 ELSE 1.0 END::DOUBLE AS fx_rate_to_fcfa,
  round(spend_amount * CASE WHEN spend_currency = 'EUR' THEN 655.0::DOUBLE ELSE 1.0::DOUBLE END, 2)
    AS spend_fcfa,
  date_start IS NULL AS date_start_parse_failed, date_end IS NULL AS date_end_parse_failed,
  spend_amount IS NULL AS spend_parse_failed,
  coalesce(date_start > date_end, false) AS invalid_date_range,
  spend_currency = 'EUR' AS converted_from_eur,
  impressions IS NULL AS impressions_missing, clicks IS NULL AS clicks_missing
FROM (
  SELECT {mapped("platform", lb.AD_PLATFORMS, "trim(platform)")} AS platform,
    trim(platform) AS platform_raw, trim(campaign_name) AS campaign_name,
    trim(campaign_name) AS campaign_name_raw,
    {read_date("date_start")} AS date_start, {read_date("date_end")} AS date_end,
    trim(date_start) AS date_start_raw, trim(date_end) AS date_end_raw,
    trim(spend) AS spend_raw,
    CASE WHEN contains(upper(spend), 'EUR') THEN 'EUR' ELSE 'FCFA' END AS spend_currency,
    try_cast(replace(regexp_replace(replace(replace(upper(spend), 'FCFA', ''), 'EUR', ''),
      '[^-0-9,.]', '', 'g'), ',', '.') AS DOUBLE) AS spend_amount,
    impressions, clicks, trim(objective) AS objective_raw,
    {mapped("objective", lb.OBJECTIVES, "lower(trim(objective))")} AS objective_normalized
  FROM (SELECT DISTINCT * FROM r_campaigns))
""",
)

_LOW = "lower(trim(month))"
_NAME = rf"regexp_extract({_LOW}, '^(\p{{L}}+)\s+([0-9]{{4}})$', 1)"
_YEAR = rf"regexp_extract({_LOW}, '^(\p{{L}}+)\s+([0-9]{{4}})$', 2)"
define(
    "t_clean_media_plan",
    f"""
SELECT *, invoiced_fcfa - planned_budget_fcfa AS variance_fcfa,
  (invoiced_fcfa IS NOT NULL)::INTEGER AS invoiced_available,
  invoiced_fcfa IS NULL AS invoiced_missing, month_date IS NULL AS month_parse_failed,
  planned_budget_fcfa IS NULL AS planned_budget_missing,
  planned_budget_fcfa < 0 AS invalid_planned_budget
FROM (
  SELECT trim(plan_id) AS plan_id, trim(month) AS month_raw,
    try_cast({_YEAR} || '-' || coalesce(nullif(list_position([{items(MONTHS)}], {_NAME}), 0),
      list_position([{items(MONTHS_PLAIN)}], {_NAME})) || '-1' AS DATE) AS month_date,
    trim(channel) AS channel_raw,
    {mapped("channel", lb.PLAN_CHANNELS, "trim(channel)")} AS channel,
    planned_budget_fcfa, invoiced_fcfa,
    nullif(trim(objective), '') AS objective, nullif(trim(owner), '') AS owner,
    nullif(trim(notes), '') AS notes
  FROM r_plan)
""",
)

define(
    "t_clean_pos_sales",
    rf"""
SELECT sale_date, trim(pos_id) AS pos_id, trim(pos_name) AS pos_name_raw,
  trim(pos_name) AS pos_name,
  regexp_replace(lower(strip_accents(trim(pos_name))), '\s+', ' ', 'g') AS pos_key,
  trim(commune) AS commune_raw,
  {mapped("commune", lb.COMMUNES, "trim(commune)")} AS commune,
  trim(channel) AS channel_raw, lower(trim(channel)) AS channel,
  trim(product_sku) AS product_sku, units_sold, revenue_fcfa,
  units_sold < 0 OR revenue_fcfa < 0 AS is_return,
  coalesce(greatest(units_sold, 0), 0)::INTEGER AS gross_units,
  coalesce(least(units_sold, 0), 0)::INTEGER AS return_units,
  CASE WHEN revenue_fcfa > 0 THEN revenue_fcfa ELSE 0 END::DOUBLE AS gross_revenue_fcfa,
  CASE WHEN revenue_fcfa < 0 THEN revenue_fcfa ELSE 0 END::DOUBLE AS return_revenue_fcfa,
  coalesce(revenue_fcfa, 0)::DOUBLE AS net_revenue_fcfa
FROM r_pos
""",
)

define(
    "t_clean_comments",
    f"""
SELECT trim(comment_id) AS comment_id, trim(post_id) AS post_id,
  trim(author_handle) AS author_handle, trim(platform) AS platform_raw,
  {mapped("platform", lb.SOCIAL_PLATFORMS, "trim(platform)")} AS platform,
  published_at, published_at::DATE AS published_date,
  date_trunc('month', published_at)::DATE AS month,
  trim(comment_text) AS comment_text, length(trim(comment_text))::INTEGER AS comment_length,
  like_count, reply_to_id, reply_to_id IS NOT NULL AS is_reply, n > 1 AS was_exact_duplicate,
  trim(comment_text) = '' AS is_empty_comment
FROM (SELECT *, count(*) AS n FROM r_comments GROUP BY ALL)
""",
)

_DIGITS = "regexp_replace(customer_phone, '[^0-9]', '', 'g')"
define(
    "t_clean_chat_orders",
    f"""
SELECT *, received_at::DATE AS order_date, date_trunc('month', received_at)::DATE AS month,
  received_at IS NULL AS received_at_parse_failed, customer_phone IS NULL AS phone_parse_failed
FROM (
  SELECT row_id, trim(order_ref) AS order_ref,
    count(*) OVER (PARTITION BY order_ref) > 1 AS order_ref_repeated,
    trim(received_at) AS received_at_raw,
    try_strptime(trim(received_at), ['%Y-%m-%d %H:%M', '%d/%m/%Y %H:%M', '%Y-%m-%d', '%d/%m/%Y'])
      AS received_at,
    trim(customer_phone) AS customer_phone_raw,
    CASE WHEN regexp_full_match({_DIGITS}, '[0-9]{{10}}') THEN '+225' || {_DIGITS}
      WHEN regexp_full_match({_DIGITS}, '225[0-9]{{10}}') THEN '+' || {_DIGITS} END
      AS customer_phone,
    nullif(trim(items_text), '') AS items_text, amount_fcfa,
    amount_fcfa IS NULL AS amount_missing, trim(delivery_zone) AS delivery_zone_raw,
    lower(trim(delivery_zone)) AS delivery_zone, trim(status) AS status_raw,
    {mapped("status", lb.ORDER_STATUSES, "lower(trim(status))")} AS status
  FROM r_order_ids)
""",
)

define(
    "t_campaign_attributes",
    r"""
SELECT month, channel, campaign_name, campaign_name_raw, date_start, date_end, product,
  campaign_month, objective_normalized AS objective, spend_fcfa, impressions, clicks,
  CASE WHEN product IS NULL THEN 'not_found' ELSE 'parsed' END AS product_parse_status,
  CASE WHEN campaign_month IS NULL THEN 'not_found' ELSE 'parsed' END
    AS campaign_month_parse_status,
  product IS NULL AS product_parse_failed, campaign_month IS NULL AS campaign_month_parse_failed
FROM (
  SELECT *, platform AS channel,
    nullif(regexp_extract(CASE WHEN contains(s, 'bissap') THEN 'bissap' ELSE
      CASE WHEN contains(s, 'gingembre') THEN 'gingembre' ELSE s END END,
      '(bissap|gingembre|bouye)', 1), '') AS product,
    try_cast(year(date_start)::VARCHAR || '-' || CASE
      WHEN contains(s, 'jan') THEN 1
      WHEN contains(s, 'fev') OR contains(s, 'février') THEN 2
      WHEN contains(s, 'mars') THEN 3 WHEN contains(s, 'avr') THEN 4
      WHEN contains(s, 'mai') THEN 5
      WHEN contains(s, 'jun') OR contains(s, 'juin') THEN 6
      WHEN regexp_matches(s, '(^| )mar(\d\d)?( |$)') THEN 3
      WHEN regexp_matches(s, '(^| )(juillet|juil|jul)(\d\d)?( |$)') THEN 7
      WHEN regexp_matches(s, '(^| )(août|aout|aou)(\d\d)?( |$)') THEN 8
      WHEN regexp_matches(s, '(^| )(septembre|sept|sep)(\d\d)?( |$)') THEN 9
      WHEN regexp_matches(s, '(^| )(octobre|oct)(\d\d)?( |$)') THEN 10
      WHEN regexp_matches(s, '(^| )(novembre|nov)(\d\d)?( |$)') THEN 11
      WHEN regexp_matches(s, '(^| )(décembre|decembre|dec)(\d\d)?( |$)') THEN 12
    END::VARCHAR || '-1' AS DATE) AS campaign_month
  FROM (SELECT *, lower(regexp_replace(campaign_name, '[^a-zA-Z0-9À-ÿ]+', ' ', 'g')) AS s
        FROM t_clean_campaigns))
""",
)

define(
    "t_sales_daily",
    """
SELECT sale_date, pos_key, pos_name, commune, product_sku, count(*) AS line_count,
  sum(units_sold)::BIGINT AS units_sold, sum(revenue_fcfa) AS revenue_fcfa,
  sum(net_revenue_fcfa) AS net_revenue_fcfa, sum(gross_units)::BIGINT AS gross_units,
  sum(return_units)::BIGINT AS return_units, sum(gross_revenue_fcfa) AS gross_revenue_fcfa,
  sum(return_revenue_fcfa) AS return_revenue_fcfa
FROM t_clean_pos_sales GROUP BY ALL
""",
)

define(
    "t_product_dimension",
    """
SELECT sku AS product_sku,
  (MAP {'BIS': 'bissap', 'GIN': 'gingembre', 'BOU': 'bouye'})[split_part(upper(sku), '-', 1)]
    AS product,
  (MAP {'1L': '1L', '33': '33cl', '33CL': '33cl'})[split_part(upper(sku), '-', 2)] AS format,
  (MAP {'1L': 1.0::DOUBLE, '33': 0.33::DOUBLE, '33CL': 0.33::DOUBLE})
    [split_part(upper(sku), '-', 2)] AS volume_litres
FROM (SELECT DISTINCT product_sku AS sku FROM t_clean_pos_sales WHERE product_sku IS NOT NULL)
""",
)

define(
    "t_pos_ids",
    """
SELECT pos_key, pos_id, min(pos_name) AS pos_name, min(commune) AS commune,
  min(sale_date) AS first_day, max(sale_date) AS last_day,
  row_number() OVER (PARTITION BY pos_key ORDER BY min(sale_date), pos_id) AS pos
FROM t_clean_pos_sales GROUP BY pos_key, pos_id
""",
)
define(
    "t_pos_dimension",
    """
SELECT pos_key, max(CASE WHEN pos = 1 THEN pos_id END) AS canonical_pos_id,
  max(CASE WHEN pos = 1 THEN pos_name END) AS canonical_pos_name, min(commune) AS commune,
  count(*) AS pos_id_count, string_agg(pos_id, ',' ORDER BY pos) AS pos_ids,
  count(*) > 1 AS pos_id_changed, min(first_day) AS first_sale_date,
  max(last_day) AS last_sale_date
FROM t_pos_ids GROUP BY pos_key
""",
)

define(
    "t_sales_calendar",
    """
SELECT day::DATE AS sale_date, date_trunc('month', day)::DATE AS month,
  date_trunc('week', day)::DATE AS week_start,
  day::DATE IN (SELECT sale_date FROM t_clean_pos_sales) AS has_sales_data,
  day::DATE NOT IN (SELECT sale_date FROM t_clean_pos_sales) AS is_missing_sales_day
FROM (
  SELECT unnest(generate_series(date_trunc('month', min(sale_date))::TIMESTAMP,
    last_day(max(sale_date))::TIMESTAMP, INTERVAL 1 DAY)) AS day
  FROM t_clean_pos_sales)
""",
)

define(
    "t_order_lines",
    r"""
SELECT *, CASE WHEN product IS NULL THEN 'unknown_product' WHEN format IS NULL
    THEN 'missing_format' ELSE 'parsed' END AS parse_status, product IS NULL AS parse_failed
FROM (
  SELECT *, CASE WHEN regexp_matches(segment, 'bissap|bis[- ]?(1l|33\s*cl)') THEN 'bissap'
      WHEN contains(segment, 'gingembre') THEN 'gingembre'
      WHEN contains(segment, 'bouye') THEN 'bouye' END AS product,
    CASE WHEN regexp_matches(segment, '1\s*l') THEN '1L'
      WHEN regexp_matches(segment, '33\s*cl') THEN '33cl' END AS format,
    CASE WHEN regexp_matches(segment, '^\s*\d+\s*x\s*[a-z]')
        THEN try_cast(regexp_extract(segment, '(\d+)') AS INTEGER)
      WHEN regexp_matches(segment, 'x\d+$')
        THEN try_cast(regexp_extract(segment, '(\d+)$', 1) AS INTEGER)
      WHEN regexp_matches(segment, '^\s*\d+\s')
        THEN try_cast(regexp_extract(segment, '(\d+)') AS INTEGER) ELSE 1 END AS quantity
  FROM (
    SELECT *, trim(unnest(string_split(regexp_replace(lower(regexp_replace(regexp_replace(
      items_text, '\([^)]*\)', '', 'g'), '\s+', ' ', 'g')), '\s+et\s+', '+', 'g'), '+'))) AS segment
    FROM t_clean_chat_orders WHERE items_text IS NOT NULL))
""",
)


def _u(cond: str) -> str:
    return f"coalesce(sum(quantity) FILTER (WHERE {cond}), 0)::BIGINT"


define(
    "t_order_quality",
    f"""
SELECT *, amount_fcfa IS NULL AS amount_missing,
  coalesce(amount_fcfa > 100000, false) AS amount_outlier,
  CASE WHEN amount_fcfa <= 100000 THEN amount_fcfa END AS amount_plausible_fcfa,
  unresolved_item_lines > 0 AS has_unknown_product, missing_format_lines > 0 AS has_missing_format,
  CASE WHEN parsed_item_lines = item_line_count THEN 'fully_parsed'
    WHEN parsed_item_lines > 0 AND unresolved_item_lines > 0 THEN 'partially_parsed'
    WHEN missing_format_lines = item_line_count THEN 'missing_format_only'
    ELSE 'unresolved' END AS order_parse_status
FROM (
  SELECT row_id, any_value(order_ref) AS order_ref, any_value(received_at) AS received_at,
    any_value(amount_fcfa) AS amount_fcfa, any_value(status) AS status, any_value(month) AS month,
    count(*) AS item_line_count,
    {count_if("parse_status = 'parsed'")} AS parsed_item_lines,
    {count_if("parse_status = 'unknown_product'")} AS unresolved_item_lines,
    {count_if("parse_status = 'missing_format'")} AS missing_format_lines,
    {_u("true")} AS quantity_total, {_u("product = 'bissap'")} AS bissap_units,
    {_u("product = 'gingembre'")} AS gingembre_units, {_u("product = 'bouye'")} AS bouye_units,
    {_u("format = '1L'")} AS format_1l_units, {_u("format = '33cl'")} AS format_33cl_units
  FROM t_order_lines GROUP BY row_id)
""",
)

define(
    "t_media_reconciliation",
    f"""
SELECT month, channel, campaign_spend_fcfa, campaign_rows, impressions, clicks,
  planned_budget_fcfa, invoiced_fcfa, invoiced_rows, media_plan_rows,
  CASE WHEN campaign_rows IS NOT NULL AND media_plan_rows IS NULL THEN 'campaign_only'
    ELSE CASE WHEN campaign_rows IS NOT NULL THEN 'both' ELSE 'media_plan_only' END
      || CASE WHEN invoiced_fcfa IS NOT NULL
           THEN CASE WHEN campaign_rows IS NULL THEN '' ELSE '_available' END
           ELSE CASE WHEN campaign_rows IS NULL THEN '_invoice_missing'
             ELSE '_sources_invoice_missing' END END
    END AS source_coverage,
  campaign_spend_fcfa - invoiced_fcfa AS campaign_vs_invoiced_variance_fcfa,
  {div("campaign_spend_fcfa", "invoiced_fcfa")} AS campaign_to_invoiced_ratio
FROM (
  SELECT month, platform AS channel, sum(spend_fcfa) AS campaign_spend_fcfa,
    count(*) AS campaign_rows, {isum("impressions")} AS impressions, {isum("clicks")} AS clicks
  FROM t_clean_campaigns GROUP BY ALL)
FULL JOIN (
  SELECT month_date AS month, channel, sum(planned_budget_fcfa) AS planned_budget_fcfa,
    sum(invoiced_fcfa) AS invoiced_fcfa, {isum("invoiced_available")} AS invoiced_rows,
    count(*) AS media_plan_rows
  FROM t_clean_media_plan GROUP BY ALL) USING (month, channel)
""",
)

define(
    "t_marketing_channel_monthly",
    f"""
SELECT r.month, r.channel, coalesce(campaign_spend_fcfa, 0)::DOUBLE AS campaign_spend_fcfa,
  coalesce(planned_budget_fcfa, 0)::DOUBLE AS planned_budget_fcfa, invoiced_fcfa,
  campaign_vs_invoiced_variance_fcfa, source_coverage,
  coalesce(campaign_rows, 0)::BIGINT AS campaign_rows, impressions, clicks,
  {div_pos("campaign_spend_fcfa", "clicks")} AS cpc_fcfa,
  {div_pos("campaign_spend_fcfa", "impressions")} * 1000 AS cpm_fcfa,
  coalesce(c1, 0)::BIGINT AS campaign_count, coalesce(c2, 0)::BIGINT AS bissap_campaigns,
  coalesce(c3, 0)::BIGINT AS gingembre_campaigns, coalesce(c4, 0)::BIGINT AS bouye_campaigns,
  coalesce(c5, 0)::BIGINT AS campaigns_without_product,
  coalesce(c5, 0)::BIGINT AS product_parse_failure_count,
  coalesce(c6, 0)::BIGINT AS month_parse_failure_count
FROM t_media_reconciliation r LEFT JOIN (
  SELECT campaign_month, channel, count(*) AS c1, {count_if("product = 'bissap'")} AS c2,
    {count_if("product = 'gingembre'")} AS c3, {count_if("product = 'bouye'")} AS c4,
    {count_if("product IS NULL")} AS c5, {count_if("campaign_month_parse_failed")} AS c6
  FROM t_campaign_attributes GROUP BY ALL) a
ON r.month = a.campaign_month AND r.channel = a.channel
""",
)

define(
    "t_sales_monthly",
    f"""
SELECT *, {div_pos("net_revenue_fcfa", "days_with_sales_data")} AS avg_revenue_per_observed_day,
  {div("abs(return_revenue_fcfa)", "gross_revenue_fcfa")} AS return_rate_revenue
FROM (
  SELECT date_trunc('month', sale_date)::DATE AS month, {isum("units_sold")} AS net_units_sold,
    sum(revenue_fcfa) AS net_revenue_fcfa, {isum("gross_units")} AS gross_units,
    sum(gross_revenue_fcfa) AS gross_revenue_fcfa, {isum("return_units")} AS return_units,
    sum(return_revenue_fcfa) AS return_revenue_fcfa, count(DISTINCT pos_key) AS active_pos,
    count(DISTINCT pos_name) AS active_pos_names, count(DISTINCT commune) AS active_communes,
    count(DISTINCT sale_date) AS observed_sales_days
  FROM t_clean_pos_sales GROUP BY 1)
LEFT JOIN (
  SELECT month, count(*) AS calendar_days, {count_if("has_sales_data")} AS days_with_sales_data,
    {count_if("is_missing_sales_day")} AS missing_sales_days
  FROM t_sales_calendar GROUP BY month) USING (month)
""",
)

define(
    "t_monthly_performance",
    f"""
SELECT month, campaign_spend_fcfa, planned_budget_fcfa, invoiced_budget_fcfa,
  campaign_vs_invoiced_variance_fcfa, impressions, clicks,
  {div_pos("campaign_spend_fcfa", "clicks")} AS blended_cpc_fcfa,
  {div_pos("campaign_spend_fcfa", "impressions")} * 1000 AS blended_cpm_fcfa,
  net_units_sold, net_revenue_fcfa, gross_units, gross_revenue_fcfa, return_units,
  return_revenue_fcfa, active_pos, active_communes, observed_sales_days, calendar_days,
  missing_sales_days, avg_revenue_per_observed_day, return_rate_revenue
FROM t_sales_monthly LEFT JOIN (
  SELECT month, sum(campaign_spend_fcfa) AS campaign_spend_fcfa,
    sum(planned_budget_fcfa) AS planned_budget_fcfa,
    sum(coalesce(invoiced_fcfa, 0)) AS invoiced_budget_fcfa,
    sum(coalesce(campaign_vs_invoiced_variance_fcfa, 0)) AS campaign_vs_invoiced_variance_fcfa,
    {isum("coalesce(impressions, 0)")} AS impressions, {isum("coalesce(clicks, 0)")} AS clicks
  FROM t_marketing_channel_monthly GROUP BY month) USING (month)
""",
)

define(
    "t_channel_performance_monthly",
    """
SELECT month, channel, campaign_spend_fcfa, planned_budget_fcfa, invoiced_fcfa,
  campaign_vs_invoiced_variance_fcfa, impressions, clicks, net_revenue_fcfa, net_units_sold,
  gross_revenue_fcfa, return_revenue_fcfa, missing_sales_days
FROM t_marketing_channel_monthly LEFT JOIN t_sales_monthly USING (month)
""",
)

define(
    "t_product_mix_monthly",
    f"""
SELECT month, product, format, product_sku, volume_litres, gross_units, return_units, net_units,
  gross_revenue_fcfa, return_revenue_fcfa, net_revenue_fcfa,
  {div("net_revenue_fcfa", "sum(net_revenue_fcfa) OVER (PARTITION BY month)")}
    AS revenue_share_of_month,
  net_units * volume_litres AS net_litres,
  {div("net_revenue_fcfa", "net_units")} AS avg_net_price_per_unit_fcfa,
  {div("net_revenue_fcfa", "net_units * volume_litres")} AS net_revenue_per_litre_fcfa,
  missing_sales_days AS month_missing_sales_days
FROM (
  SELECT date_trunc('month', sale_date)::DATE AS month, product_sku,
    {isum("gross_units")} AS gross_units, {isum("return_units")} AS return_units,
    {isum("units_sold")} AS net_units, sum(gross_revenue_fcfa) AS gross_revenue_fcfa,
    sum(return_revenue_fcfa) AS return_revenue_fcfa, sum(net_revenue_fcfa) AS net_revenue_fcfa
  FROM t_clean_pos_sales GROUP BY ALL)
LEFT JOIN t_product_dimension USING (product_sku)
LEFT JOIN (SELECT month, missing_sales_days FROM t_sales_monthly) USING (month)
""",
)

_DEL = "status = 'delivered'"
define(
    "t_chat_orders_monthly",
    f"""
SELECT month, count(*) AS orders, {count_if(_DEL)} AS delivered_orders,
  {count_if("status = 'cancelled'")} AS cancelled_orders,
  {count_if("status = 'pending'")} AS pending_orders,
  {count_if("amount_missing")} AS amount_missing_orders,
  {count_if("order_parse_status = 'fully_parsed'")} AS fully_parsed_orders,
  {count_if("order_parse_status = 'missing_format_only'")} AS missing_format_orders,
  {count_if("order_parse_status = 'unresolved'")} AS unresolved_orders,
  {isum("quantity_total")} AS total_units, {isum("bissap_units")} AS bissap_units,
  {isum("gingembre_units")} AS gingembre_units, {isum("bouye_units")} AS bouye_units,
  {isum("format_1l_units")} AS format_1l_units, {isum("format_33cl_units")} AS format_33cl_units,
  coalesce(sum(amount_plausible_fcfa), 0)::DOUBLE AS known_order_amount_fcfa,
  coalesce(sum(amount_plausible_fcfa) FILTER (WHERE {_DEL}), 0)::DOUBLE
    AS delivered_known_amount_fcfa,
  {count_if(f"{_DEL} AND amount_missing")} AS delivered_amount_missing_orders,
  {count_if(f"{_DEL} AND amount_outlier")} AS delivered_outlier_amount_orders,
  {count_if("amount_outlier")} AS outlier_amount_orders,
  coalesce(sum(amount_fcfa) FILTER (WHERE amount_outlier), 0)::DOUBLE AS outlier_amount_fcfa
FROM t_order_quality GROUP BY month
""",
)

define(
    "t_chat_customers",
    f"""
SELECT customer_phone AS customer_key, count(*) AS order_count,
  {count_if(_DEL)} AS delivered_order_count, min(order_date) AS first_order_date,
  max(order_date) AS last_order_date, {count_if(_DEL)} > 0 AS has_delivered_order,
  {count_if(_DEL)} > 1 AS is_repeat_customer, count(*) > 1 AS is_repeat_customer_any_status
FROM t_clean_chat_orders WHERE customer_phone IS NOT NULL GROUP BY customer_phone
""",
)

_LABELS = [
    *[(c, f"sentiment_model = '{v}'") for v, c in marts.SENTIMENT_COLUMNS.items()],
    *[(c, f"theme_model = '{v}'") for v, c in marts.THEME_COLUMNS.items()],
    *[(c, f"product_model = '{v}'") for v, c in marts.PRODUCT_COLUMNS.items()],
]
_COUNTS = ",\n  ".join(
    f"{count_if(f'{cond} AND NOT is_spam_model')} AS {name}" for name, cond in _LABELS
)
_SHARES = ", ".join(
    f"{pct(num, den)} AS {name}_share_pct"
    for name, num, den in [
        ("positive", "positive_comments_count", "non_spam_comments_count"),
        ("negative", "negative_comments_count", "non_spam_comments_count"),
        ("neutral", "neutral_comments_count", "non_spam_comments_count"),
        ("spam", "spam_comments_count", "comments_count"),
        ("model_used", "model_used_count", "comments_count"),
        ("rules_complete", "rules_complete_count", "comments_count"),
    ]
)
define(
    "t_social_monthly",
    f"""
SELECT *, {_SHARES} FROM (
SELECT date_trunc('month', published_at)::DATE AS month, platform, count(*) AS comments_count,
  count(DISTINCT comment_id) AS unique_comments_count,
  {isum("coalesce(like_count, 0)")} AS likes_total,
  {count_if("is_spam_model")} AS spam_comments_count,
  {count_if("NOT is_spam_model")} AS non_spam_comments_count,
  {_COUNTS},
  {count_if("model_used")} AS model_used_count, {count_if("rules_complete")} AS rules_complete_count
FROM t_comments_enriched GROUP BY ALL)
""",
)

_TOTALS = f"""
  sum(campaign_spend_fcfa) AS campaign_spend_fcfa, sum(planned_budget_fcfa) AS planned_budget_fcfa,
  coalesce(sum(invoiced_fcfa), 0)::DOUBLE AS invoiced_fcfa,
  coalesce(sum(impressions), 0)::BIGINT AS impressions, coalesce(sum(clicks), 0)::BIGINT AS clicks,
  {isum("campaign_rows")} AS campaign_rows, {isum("campaign_count")} AS campaign_count,
  {isum("campaigns_without_product")} AS campaigns_without_product,
  {isum("product_parse_failure_count")} AS product_parse_failure_count,
  {isum("month_parse_failure_count")} AS month_parse_failure_count,
  count(DISTINCT month) AS active_months
"""
define(
    "t_budget_allocation",
    f"""
SELECT *, campaign_spend_fcfa - invoiced_fcfa AS campaign_vs_invoiced_fcfa,
  {div_pos("campaign_spend_fcfa", "sum(campaign_spend_fcfa) OVER ()")} AS spend_share,
  {div_pos("planned_budget_fcfa", "sum(planned_budget_fcfa) OVER ()")} AS planned_share,
  {div_pos("campaign_spend_fcfa", "planned_budget_fcfa")} AS spend_vs_plan_ratio,
  {div_pos("campaign_spend_fcfa", "clicks")} AS cpc_fcfa,
  {div_pos("campaign_spend_fcfa", "impressions")} * 1000 AS cpm_fcfa,
  CASE WHEN campaigns_without_product + product_parse_failure_count + month_parse_failure_count = 0
    THEN 'good' WHEN greatest(product_parse_failure_count, month_parse_failure_count) <= 2
    THEN 'moderate' ELSE 'limited' END AS data_quality_status
FROM (SELECT channel, {_TOTALS} FROM t_marketing_channel_monthly GROUP BY channel)
""",
)

define(
    "t_channel_evidence",
    f"""
SELECT * EXCLUDE (all_months), {div_pos("campaign_spend_fcfa", "planned_budget_fcfa")}
    AS spend_vs_plan_ratio,
  CASE WHEN campaign_spend_fcfa > 0
    THEN {div("campaign_spend_fcfa", "sum(campaign_spend_fcfa) OVER ()")} END AS spend_share,
  {div_pos("campaign_spend_fcfa", "clicks")} AS cpc_fcfa,
  {div_pos("campaign_spend_fcfa", "impressions")} * 1000 AS cpm_fcfa,
  {div_pos("latest_month_spend_fcfa", "previous_month_spend_fcfa")} - 1
    AS latest_month_spend_change,
  {div_pos("recent_3m_spend_fcfa", "earlier_3m_spend_fcfa")} - 1 AS recent_vs_earlier_spend_change,
  CASE WHEN active_months = all_months THEN 'full_period' ELSE 'partial_period' END
    AS period_coverage,
  CASE WHEN months_missing_impressions + months_missing_clicks + product_parse_failure_count
      + month_parse_failure_count = 0 THEN 'good'
    WHEN greatest(months_missing_impressions, months_missing_clicks) <= 1
      AND greatest(product_parse_failure_count, month_parse_failure_count) <= 2 THEN 'moderate'
    ELSE 'limited' END AS data_quality_status
FROM (
  SELECT channel, {_TOTALS},
    {count_if("impressions IS NULL")} AS months_missing_impressions,
    {count_if("clicks IS NULL")} AS months_missing_clicks,
    max(campaign_spend_fcfa) FILTER (WHERE r = 1) AS latest_month_spend_fcfa,
    max(campaign_spend_fcfa) FILTER (WHERE r = 2) AS previous_month_spend_fcfa,
    coalesce(sum(campaign_spend_fcfa) FILTER (WHERE r <= 3), 0)::DOUBLE AS recent_3m_spend_fcfa,
    coalesce(sum(campaign_spend_fcfa) FILTER (WHERE r IN (4, 5, 6)), 0)::DOUBLE
      AS earlier_3m_spend_fcfa,
    (SELECT count(DISTINCT month) FROM t_marketing_channel_monthly) AS all_months
  FROM (SELECT *, dense_rank() OVER (ORDER BY month DESC NULLS LAST) AS r
        FROM t_marketing_channel_monthly)
  GROUP BY channel)
""",
)

define(
    "t_decision_budget",
    f"""
SELECT month, campaign_spend_fcfa, planned_budget_fcfa, invoiced_budget_fcfa,
  campaign_vs_invoiced_variance_fcfa, net_revenue_fcfa, net_units_sold, impressions, clicks,
  blended_cpc_fcfa, blended_cpm_fcfa, missing_sales_days, active_channels,
  {div_pos("campaign_spend_fcfa", "planned_budget_fcfa")} AS overall_spend_vs_plan_ratio,
  {div_pos("net_revenue_fcfa", "campaign_spend_fcfa")} AS revenue_to_campaign_spend_ratio
FROM t_monthly_performance LEFT JOIN (
  SELECT month, count(DISTINCT channel) AS active_channels
  FROM t_marketing_channel_monthly GROUP BY month) USING (month)
""",
)

define(
    "t_channel_decision",
    f"""
SELECT e.* EXCLUDE (earlier_3m_spend_fcfa), observed_spend_share,
  {div_pos("e.planned_budget_fcfa", "sum(e.planned_budget_fcfa) OVER ()")} AS planned_share,
  t.*,
  CASE data_quality_status WHEN 'good' THEN 'high' WHEN 'moderate' THEN 'medium'
    ELSE 'limited' END AS evidence_quality,
  CASE WHEN data_quality_status = 'limited' THEN 'limited_measurement'
    WHEN clicks > 0 AND impressions > 0 THEN 'digital_metrics_available'
    ELSE 'non_digital_or_partial_metrics' END AS measurement_profile
FROM t_channel_evidence e LEFT JOIN (
  SELECT channel, CASE WHEN campaign_spend_fcfa > 0
    THEN {div("campaign_spend_fcfa", "sum(campaign_spend_fcfa) OVER ()")} ELSE 0 END
    AS observed_spend_share FROM t_budget_allocation) USING (channel),
  (SELECT sum(net_revenue_fcfa) AS total_net_revenue_fcfa,
    {isum("net_units_sold")} AS total_net_units_sold,
    {isum("missing_sales_days")} AS total_missing_sales_days,
    avg({div_pos("net_revenue_fcfa", "campaign_spend_fcfa")}) AS avg_monthly_revenue_spend_ratio
   FROM t_monthly_performance) t
""",
)


def _per_channel(values, default) -> str:
    arms = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in values.items())
    return f"CASE channel {arms} ELSE {text(default)} END"


_DECIDED = ", ".join(f"({text(k)}, {v}::DOUBLE)" for k, v in DECIDED_BUDGET.items())
define(
    "t_budget_computed",
    """
SELECT channel, budget + CASE WHEN row_number() OVER (ORDER BY raw DESC, channel) = 1
    THEN 15000000 - sum(budget) OVER () ELSE 0 END AS computed_budget_fcfa
FROM (
  SELECT channel, raw, round(raw / 50000) * 50000 AS budget FROM (
    SELECT channel, 1000000 + (15000000 - 1000000 * count(*) OVER ()) * CASE
      WHEN sum(score) OVER () > 0 THEN score / sum(score) OVER ()
      ELSE 1.0::DOUBLE / count(*) OVER () END AS raw
    FROM (SELECT channel, coalesce(observed_spend_share, 0)::DOUBLE * CASE evidence_quality
            WHEN 'high' THEN 1.5 WHEN 'medium' THEN 1.3 ELSE 1.0 END::DOUBLE AS score
          FROM t_channel_decision)))
""",
)
define(
    "t_budget_recommendation",
    f"""
SELECT channel, campaign_spend_fcfa, planned_budget_fcfa, invoiced_fcfa, spend_share,
  planned_share, spend_vs_plan_ratio, impressions, clicks, cpc_fcfa, cpm_fcfa,
  data_quality_status, evidence_quality, measurement_profile,
  coalesce(amount, computed_budget_fcfa) AS proposed_budget_fcfa,
  coalesce(amount, computed_budget_fcfa) / 15000000.0::DOUBLE AS proposed_share,
  computed_budget_fcfa,
  CASE WHEN amount IS NULL THEN 'calculé' ELSE 'décidé' END AS allocation_source,
  {_per_channel(marts.RATIONALE, marts.NO_RATIONALE)} AS allocation_rationale,
  {_per_channel(marts.TEST_CONDITION, marts.NO_CONDITION)} AS test_condition
FROM t_channel_decision JOIN t_budget_computed USING (channel)
LEFT JOIN (VALUES {_DECIDED}) AS d(channel, amount) USING (channel)
""",
)


# --- planted faults ----------------------------------------------------------------------
def variant(name: str, source: str, **renamed: str) -> None:
    """The table expression `source` under another name, reading other tables."""
    sql = CTES[source]
    for old, new in renamed.items():
        sql = re.sub(rf"\b{old}\b", new, sql)
    define(name, sql)


define(
    "r_faulty_pos",
    """
SELECT * FROM r_pos
UNION ALL SELECT * REPLACE ('Kiosque du coin' AS pos_name) FROM r_pos WHERE units_sold = 13
""",
)
variant("t_faulty_pos", "t_clean_pos_sales", r_pos="r_faulty_pos")
define(
    "r_faulty_orders",
    """
SELECT * FROM r_orders
UNION ALL SELECT * REPLACE ('2 bissap 1L x3' AS items_text) FROM r_orders WHERE amount_fcfa IS NULL
""",
)
variant("r_faulty_ids", "r_order_ids", r_orders="r_faulty_orders")
variant("t_faulty_orders", "t_clean_chat_orders", r_order_ids="r_faulty_ids")
variant("t_faulty_lines", "t_order_lines", t_clean_chat_orders="t_faulty_orders")
define(
    "t_faulty_calendar",
    """
SELECT * REPLACE (is_missing_sales_day <> (day(sale_date) = 1) AS is_missing_sales_day)
FROM t_sales_calendar
WHERE sale_date NOT IN (SELECT min(sale_date) FROM t_sales_calendar
  UNION ALL SELECT max(sale_date) FROM t_sales_calendar)
""",
)
define(
    "t_faulty_mix",
    """
SELECT * REPLACE (CASE WHEN product = 'bissap' THEN net_units + 1 ELSE net_units END AS net_units)
FROM t_product_mix_monthly
""",
)
define(
    "t_faulty_chat",
    """
SELECT * REPLACE (CASE WHEN month(month) IN (2, 4, 6, 8, 10, 12) THEN known_order_amount_fcfa + 1
  ELSE known_order_amount_fcfa END AS known_order_amount_fcfa)
FROM t_chat_orders_monthly
""",
)
define(
    "t_faulty_budget",
    """
SELECT * REPLACE (CASE WHEN channel = 'Meta' THEN proposed_budget_fcfa + 1000
  ELSE proposed_budget_fcfa END AS proposed_budget_fcfa)
FROM t_budget_recommendation WHERE channel NOT IN ('Radio', 'TikTok')
""",
)
