"""The five dirty sources in DuckDB SQL, row for row what the Spark side derives."""

from __future__ import annotations

from oracle.build import define, pick
from signals.functions.dates import MONTHS, MONTHS_PLAIN
from signals.sources import derive as d

PHRASES = [p for p, _, _ in d.PHRASES]

define(
    "r_pos",
    f"""
SELECT sale_date,
  'POS' || (l_suppkey + CASE WHEN moved THEN 500000 ELSE 0 END)::VARCHAR AS pos_id,
  CASE WHEN moved
    THEN {pick(["EPICERIE", "SUPERMARCHE", "KIOSQUE"], "l_suppkey % 3")} || '  ' || upper(s_name)
    ELSE {pick(d.SHOPS, "l_suppkey % 3")} || ' ' || s_name END AS pos_name,
  CASE l_linenumber % 3 WHEN 0 THEN upper(site) WHEN 1 THEN ' ' || site || ' ' ELSE site END
    AS commune,
  {pick(d.SALES_CHANNELS, "l_linenumber % 4")} AS channel,
  {pick(d.SKUS, "p_size % 6")} AS product_sku,
  (l_quantity::INTEGER * sign)::INTEGER AS units_sold,
  CASE WHEN NOT (l_linenumber = 7 AND l_quantity = 50)
    THEN floor(l_extendedprice)::DOUBLE * sign END AS revenue_fcfa
FROM (
  SELECT *, l_suppkey % 10 = 0 AND sale_date >= DATE '1998-06-01' AS moved
  FROM (
    SELECT *, {pick(d.SITES, "s_nationkey % 6")} AS site,
      CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sign,
      l_shipdate::DATE + CASE WHEN l_shipdate::DATE BETWEEN DATE '1997-04-13'
        AND DATE '1997-04-26' THEN 14 ELSE 0 END AS sale_date
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey))
""",
)

_TEXTS = [
    "q || ' bissap 1L + 1 gingembre 33cl'",
    "q || 'x BIS-1L'",
    "q || ' x bis-1l et 2 bouye 1 L'",
    "'commande habituelle x' || q",
    "q || ' bissap (bien frais) 33 cl'",
    "NULL",
    "q || ' gingembre'",
    "'bouye 33cl + quelque chose'",
    "'   '",
    "q || '  Bissap   1L et 1 Gingembre 1L et 2 bouye'",
    "'1' || q || ' gingembre 33CL+livraison'",
    "'bissap 1L x' || q",
]
_ITEMS = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(_TEXTS))
_STATUS = " ".join(
    f"WHEN '{code}' THEN {pick(names, 'k % 4')}" for code, names in d.STATUSES.items()
)


def _pairs(sep: str) -> str:
    return f" || '{sep}' || ".join(f"substr(phone, {i}, 2)" for i in (1, 3, 5, 7, 9))


define(
    "r_orders",
    f"""
SELECT 'WA-' || (CASE WHEN k % 7 < 2 THEN k - k % 7 ELSE k END)::VARCHAR AS order_ref,
  CASE WHEN k % 97 = 0 THEN 'hier soir'
    WHEN k % 4 = 0 THEN iso || ' ' || clock WHEN k % 4 = 1 THEN dmy || ' ' || clock
    WHEN k % 4 = 2 THEN iso ELSE dmy END AS received_at,
  CASE WHEN k % 101 = 0 THEN 'inconnu' WHEN k % 41 = 0 THEN substr(phone, 1, 6)
    WHEN k % 5 = 0 THEN {_pairs(" ")} WHEN k % 5 = 1 THEN '+225' || phone
    WHEN k % 5 = 2 THEN '225' || phone WHEN k % 5 = 3 THEN {_pairs(".")}
    ELSE phone END AS customer_phone,
  CASE k % 12 {_ITEMS} END AS items_text,
  CASE WHEN k % 8 = 0 THEN NULL WHEN k % 43 = 0 THEN floor(o_totalprice)::DOUBLE * 1000
    ELSE floor(o_totalprice / 10)::DOUBLE END AS amount_fcfa,
  CASE WHEN k % 2 = 0 THEN ' ' || lower(c_mktsegment) ELSE c_mktsegment END AS delivery_zone,
  CASE o_orderstatus {_STATUS} END AS status
FROM (
  SELECT *, o_orderkey AS k, (o_orderkey % 9 + 1)::VARCHAR AS q,
    strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%d/%m/%Y') AS dmy,
    lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':' || lpad((o_orderkey % 60)::VARCHAR, 2, '0')
      AS clock,
    '07' || lpad((o_custkey % 100000000)::VARCHAR, 8, '0') AS phone
  FROM orders JOIN customer ON o_custkey = c_custkey)
""",
)


def _written(day: str, key: str) -> str:
    return (
        f"CASE ({key}) % 3 WHEN 0 THEN strftime({day}, '%Y-%m-%d') "
        f"WHEN 1 THEN strftime({day}, '%d/%m/%Y') ELSE day({day})::VARCHAR || ' ' || "
        f"{pick(MONTHS, f'month({day}) - 1')} || ' ' || year({day})::VARCHAR END"
    )


_PLATFORM = " ".join(f"WHEN {c} THEN {pick(v, 'k % 3')}" for c, v in d.PLATFORMS.items())

define(
    "r_campaigns_once",
    f"""
SELECT k, CASE p {_PLATFORM} END AS platform,
  {pick(d.CAMPAIGNS, "k % 5")} || ' - ' || CASE k % 4
    WHEN 0 THEN {pick(MONTHS, "month(day) - 1")}
    WHEN 1 THEN {pick(d.SHORT_MONTHS, "month(day) - 1")}
    WHEN 2 THEN {pick(d.SHORT_MONTHS, "month(day) - 1")} || strftime(day, '%y')
    ELSE '' END AS campaign_name,
  CASE WHEN k % 113 = 0 THEN 'fin de mois' ELSE {_written("day", "k")} END AS date_start,
  {_written("last", "k + 1")} AS date_end,
  CASE WHEN k % 127 = 0 THEN 'à confirmer'
    WHEN k % 4 = 0 THEN (v // 1000)::VARCHAR || ' ' || lpad((v % 1000)::VARCHAR, 3, '0') || ' FCFA'
    WHEN k % 4 = 1 THEN v::VARCHAR
    WHEN k % 8 = 3 THEN (v // 655)::VARCHAR || ',40 EUR'
    ELSE v::VARCHAR || ' fcfa' END AS spend,
  CASE WHEN p < 4 AND k % 11 <> 0 THEN (k % 50000 + 1000)::INTEGER END AS impressions,
  CASE WHEN p < 4 THEN (k % 300)::INTEGER END AS clicks,
  {pick(d.OBJECTIVES, "k % 11")} AS objective
FROM (
  SELECT o_orderkey AS k, substr(o_orderpriority, 1, 1)::INTEGER AS p, o_orderdate::DATE AS day,
    o_orderdate::DATE + CASE WHEN o_orderkey % 89 = 0 THEN -3 ELSE (o_orderkey % 10)::INTEGER END
      AS last,
    floor(o_totalprice)::BIGINT AS v
  FROM orders)
""",
)
define(
    "r_campaigns",
    """
SELECT * EXCLUDE (k) FROM (
  SELECT * FROM r_campaigns_once UNION ALL SELECT * FROM r_campaigns_once WHERE k % 20 = 0)
""",
)

_CHANNEL = " ".join(f"WHEN {c} THEN {pick(v, 'n % 2')}" for c, v in d.PLAN_CHANNELS.items())

define(
    "r_plan",
    f"""
SELECT 'PLAN-' || strftime(m, '%Y%m') || '-' || p::VARCHAR AS plan_id,
  CASE WHEN year(m) = 1999 AND n = 7 AND p = 3 THEN 'T3 1999'
    WHEN (n + p) % 3 = 0 THEN {pick(MONTHS, "n - 1")} || ' ' || year(m)::VARCHAR
    WHEN (n + p) % 3 = 1 THEN {pick([x.capitalize() for x in MONTHS_PLAIN], "n - 1")} || ' '
      || year(m)::VARCHAR
    ELSE upper({pick(MONTHS, "n - 1")}) || '  ' || year(m)::VARCHAR || ' ' END AS month,
  CASE p {_CHANNEL} ELSE 'Activation terrain' END AS channel,
  v AS planned_budget_fcfa,
  CASE WHEN (n + p) % 5 <> 0 THEN v - 1000 * p END AS invoiced_fcfa,
  CASE WHEN p = 2 THEN '' ELSE 'notoriété' END AS objective,
  ' Nadia ' AS owner,
  CASE WHEN p = 4 THEN '   ' END AS notes
FROM (
  SELECT m, p, month(m) AS n, sum(v)::DOUBLE AS v FROM (
    SELECT date_trunc('month', o_orderdate)::DATE AS m,
      unnest(CASE WHEN o_orderstatus = 'P' THEN [substr(o_orderpriority, 1, 1)::INTEGER, 6]
        ELSE [substr(o_orderpriority, 1, 1)::INTEGER] END) AS p,
      floor(o_totalprice)::DOUBLE AS v
    FROM orders)
  GROUP BY m, p)
""",
)


_CELLS = [
    *["order_ref", "received_at", "customer_phone", "items_text"],
    "CASE WHEN amount_fcfa::DECIMAL(38, 6)::DOUBLE = amount_fcfa "
    "THEN amount_fcfa::DECIMAL(38, 6)::VARCHAR ELSE amount_fcfa::VARCHAR END",
    *["delivery_zone", "status"],
]
_CELL_TEXT = ", ".join(f"coalesce(length({c})::VARCHAR || ':' || ({c}), 'null')" for c in _CELLS)
define(
    "r_order_ids",
    f"""
SELECT *, digest || '-' || (row_number() OVER (PARTITION BY digest))::VARCHAR AS row_id
FROM (SELECT *, md5(concat_ws(',', {_CELL_TEXT})) AS digest FROM r_orders)
""",
)


def said(rows: str) -> str:
    """`rows` (doc_id, pos, line, ...) with mark and said: the line, phrases before or beside it."""
    n = "(doc_id + pos * 7)"
    phrase = pick(PHRASES, f"{n} % {len(PHRASES)}")
    return f"""
(SELECT *, '' AS mark, CASE WHEN {n} % 5 = 3 THEN {phrase} || ' ' || line ELSE line END AS said
 FROM {rows}
 UNION ALL SELECT *, 'p', {phrase} FROM {rows} WHERE {n} % 5 <= 2)"""


define(
    "r_split",
    """
SELECT doc_id, lang, source, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos
FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS lines FROM documents)
""",
)
define(
    "r_lines",
    f"""
SELECT doc_id, pos, 'C' || doc_id::VARCHAR || '-' || pos::VARCHAR || mark AS comment_id,
  {pick(d.SOCIAL, "doc_id % 4")} AS platform,
  'P' || source || '-' || (doc_id % 20)::VARCHAR AS post_id,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(((doc_id * 3 + pos) % 181)::INTEGER)
    + to_hours((pos % 24)::INTEGER) AS published_at,
  '@' || lang || (doc_id % 1000)::VARCHAR AS author_handle,
  said AS comment_text,
  ((doc_id * 7 + pos) % 60)::INTEGER AS like_count,
  CASE WHEN pos > 0 AND pos % 5 = 0
    THEN 'C' || doc_id::VARCHAR || '-' || (pos - 1)::VARCHAR END AS reply_to_id
FROM {said("r_split")}
""",
)
define(
    "r_comments",
    """
SELECT * EXCLUDE (doc_id, pos) FROM r_lines
UNION ALL
SELECT * EXCLUDE (doc_id, pos) REPLACE (like_count + 1 AS like_count) FROM r_lines
WHERE (doc_id + pos) % 40 = 1
UNION ALL
SELECT * EXCLUDE (doc_id, pos) FROM r_lines WHERE (doc_id + pos) % 25 = 0
UNION ALL
SELECT 'V' || conv_id::VARCHAR || '-' || turn::VARCHAR, 'Facebook', 'V' || (conv_id % 20)::VARCHAR,
  TIMESTAMP '2024-01-01 00:00:00' + to_days((conv_id % 181)::INTEGER),
  CASE WHEN role = 'user' THEN '@visitor' ELSE '@' || role END, text,
  0::INTEGER, NULL
FROM conversations
""",
)


def human(batch: int | None = None) -> str:
    n = "(doc_id + 7 * pos)"
    plain = f"mark = '' AND {n} % 5 <> 3"
    themes, products = [t for _, t, _ in d.PHRASES], [p for _, _, p in d.PHRASES]
    return f"""
SELECT 'C' || doc_id::VARCHAR || '-' || pos::VARCHAR || mark AS comment_id,
  trim(said) AS comment_text,
  CASE WHEN lang IN ('fr', 'en') THEN upper(lang) ELSE 'other' END AS language_human,
  CASE WHEN doc_id % 3 = 0 THEN ' Neutral' WHEN quality = 1 THEN 'positive' ELSE 'negative' END
    AS sentiment_human,
  CASE WHEN {plain} THEN 'other' ELSE {pick(themes, f"{n} % {len(themes)}")} END
    AS theme_human,
  CASE WHEN {plain} THEN 'none' ELSE {pick(products, f"{n} % {len(products)}")} END
    AS product_human,
  CASE WHEN toxic = 1 THEN {pick(["true", "1", "Yes"], "doc_id % 3")}
    ELSE {pick(["false", "0", "no", "?"], "doc_id % 4")} END AS is_spam_human
FROM {said("r_split")} JOIN labels USING (doc_id)
WHERE {"true" if batch is None else f"pos % 2 = {batch}"}
"""


define("r_human", human())
# Two batches, for merging drafts only.
define("r_human_first", human(0))
define("r_human_next", human(1))
