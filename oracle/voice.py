"""Comment rules in DuckDB SQL: word lists on a token list, patterns through RE2.

RE2 has no look-around and an ASCII word edge, so edges are matched as a neighbouring
character that is not a letter, digit or underscore.
"""

from __future__ import annotations

from oracle.build import count_if, define, div, isum, items, text
from signals.functions import lexicon as lx

W = r"\p{L}\p{N}_"
NOT_W = rf"[^{W}]"
INNER = rf"(?:[^{W}\n]|[^{W}\n][^\n]*[^{W}\n])"


def re2(pattern: str) -> str:
    for a, b in (
        (r"\b.*\b", INNER),
        (r"\w", f"[{W}]"),
        (r"\s", r"[\s\p{Z}]"),
        (r"\d", r"\p{Nd}"),
    ):
        pattern = pattern.replace(a, b)
    return pattern


def group(patterns) -> str:
    closed = [re2(p) for p in patterns if not p.endswith("@")]
    open_ended = [re2(p) for p in patterns if p.endswith("@")]
    parts = [f"(?:{'|'.join(closed)})(?:{NOT_W}|$)"] if closed else []
    return "|".join(parts + open_ended)


def has(column: str, patterns) -> str:
    return f"regexp_matches({column}, {text(f'(?:{NOT_W}|^)(?:{group(patterns)})')})"


def negated(column: str, patterns) -> str:
    gap = re2(r"\s+(?:\w+\s+){0,3}?")
    pattern = f"(?:{NOT_W}|^)(?:{'|'.join(lx.NEGATIONS)}){gap}(?:{group(patterns)})"
    return f"regexp_matches({column}, {text(pattern)})"


def trim_all(column: str) -> str:
    return rf"lower(regexp_replace({column}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'))"


def any_contains(column: str, symbols) -> str:
    return "(" + " OR ".join(f"contains({column}, {text(s)})" for s in symbols) + ")"


_OPEN = f"^(?:{'|'.join(lx.LEADING_FILLERS)})" + rf"(?:[\s\p{{Z}},]+|({NOT_W})|$)"
_CLOSE = rf"({NOT_W}|^){lx.TRAILING_FILLER}[\s\p{{Z}}]*\?*"
BARE = trim_all(
    f"regexp_replace(regexp_replace(n, {text(_OPEN)}, '\\1'), {text(_CLOSE)}, '\\1', 'g')"
)

_THEMES = list(lx.THEME_PATTERNS)


def _found(theme: str) -> str:
    test = has("b", lx.THEME_PATTERNS[theme])
    if theme == "taste":
        named = has("b", [w for ws in lx.PRODUCT_PATTERNS.values() for w in ws])
        test = f"({test} OR ({has('b', lx.TASTE_IF_PRODUCT)} AND {named}))"
    return f"CASE WHEN {test} THEN '{theme}' END"


_PRODUCTS = ", ".join(
    f"CASE WHEN {has('n', words)} THEN '{p}' END" for p, words in lx.PRODUCT_PATTERNS.items()
)
_DOMINATED = "MAP {" + ", ".join(
    f"'{w}': [{items(losers)}]" for w, losers in lx.THEME_PRIORITY.items()
) + "}"

define(
    "t_texts",
    "SELECT DISTINCT comment_id, comment_text FROM t_clean_comments WHERE comment_text <> ''",
)
define(
    "t_text_flags",
    rf"""
SELECT comment_id, comment_text, n, b, regexp_split_to_array(n, '{NOT_W}+') AS words,
  [x FOR x IN [{", ".join(_found(t) for t in _THEMES)}] IF x IS NOT NULL] AS themes,
  {has("b", lx.HEDGES)} AS hedged,
  {has("b", lx.POSITIVE_PATTERNS)} AS pos, {has("b", lx.NEGATIVE_PATTERNS)} AS neg,
  {negated("b", lx.POSITIVE_PATTERNS)} AS not_pos,
  {negated("b", lx.NEGATIVE_PATTERNS)} AS not_neg,
  {has("n", lx.SPAM_PATTERNS)} AS spam,
  [x FOR x IN [{_PRODUCTS}] IF x IS NOT NULL] AS products,
  n <> '' AND NOT regexp_matches(n, '[\p{{L}}\p{{N}}]') AS emoji,
  regexp_matches(n, {text(f"^(?:{'|'.join(lx.CONVERSATIONAL)}){NOT_W}*$")}) AS talk
FROM (SELECT *, {BARE} AS b FROM (
  SELECT comment_id, comment_text, {trim_all("comment_text")} AS n FROM t_texts))
""",
)
_ENGLISH = (
    f"len(list_distinct(list_intersect(words, [{items(lx.ENGLISH_WORDS)}])))"
    + "".join(f" + {has('n', [p])}::INTEGER" for p in lx.ENGLISH_EXTRA)
)
define(
    "t_rule_steps",
    f"""
SELECT *, CASE WHEN list_has_any(words, [{items(lx.SLANG_WORDS)}]) THEN 'nouchi'
    WHEN french AND english >= 1 THEN 'mixed'
    WHEN english >= 2 OR {has("n", lx.STRONG_ENGLISH)} THEN 'en' WHEN french THEN 'fr' END AS lang,
  CASE WHEN hedged THEN NULL WHEN not_pos AND NOT not_neg THEN 'negative'
    WHEN not_neg AND NOT not_pos THEN 'positive' WHEN pos AND NOT neg THEN 'positive'
    WHEN neg AND NOT pos THEN 'negative'
    WHEN NOT pos AND NOT neg AND contains(b, '?') THEN 'neutral' END AS senti,
  CASE WHEN len(left_over) = 1 THEN left_over[1] END AS theme,
  CASE WHEN len(products) > 1 THEN 'multiple' ELSE products[1] END AS product
FROM (
  SELECT *, list_has_any(words, [{items(lx.FRENCH_WORDS)}]) OR {has("n", ["aujourd'hui"])}
      AS french,
    {_ENGLISH} AS english,
    [x FOR x IN themes IF NOT list_contains(
      flatten([coalesce(({_DOMINATED})[w], []::VARCHAR[]) FOR w IN themes]), x)] AS left_over
  FROM t_text_flags)
""",
)
define(
    "t_rules",
    f"""
SELECT comment_id, comment_text,
  CASE WHEN emoji THEN 'other' WHEN talk THEN coalesce(lang, 'fr') ELSE lang END AS rule_language,
  CASE WHEN emoji THEN CASE (CASE WHEN {any_contains("n", lx.POSITIVE_EMOJI)} THEN 1 ELSE 0 END)
      - (CASE WHEN {any_contains("n", lx.NEGATIVE_EMOJI)} THEN 1 ELSE 0 END)
      WHEN 1 THEN 'positive' WHEN -1 THEN 'negative' ELSE 'neutral' END
    WHEN talk OR spam THEN 'neutral' ELSE senti END AS rule_sentiment,
  CASE WHEN emoji OR talk OR spam OR general THEN 'other' ELSE theme END AS rule_theme,
  CASE WHEN emoji OR talk OR spam THEN 'none' ELSE product END AS rule_product,
  CASE WHEN emoji OR talk THEN false WHEN spam THEN true
    WHEN theme IS NOT NULL OR product IS NOT NULL OR general THEN false END AS rule_is_spam
FROM (SELECT *, theme IS NULL AND product IS NULL AND senti IS NOT NULL AND NOT contains(b, '?')
        AS general FROM t_rule_steps)
""",
)
define(
    "t_rules_done",
    """
SELECT *, rule_language IS NOT NULL AND rule_sentiment IS NOT NULL AND rule_theme IS NOT NULL
  AND rule_is_spam IS NOT NULL AS rules_complete FROM t_rules
""",
)
define(
    "t_predictions",
    f"""
SELECT comment_id, comment_text, language_model, sentiment_model, theme_model,
  coalesce(rule_product, CASE WHEN theme_model IN ({items(lx.PRODUCT_THEMES)}) THEN 'unknown'
    ELSE 'none' END) AS product_model,
  is_spam_model, NOT rules_complete AS model_used, rules_complete
FROM (SELECT *, coalesce(rule_language, 'other') AS language_model,
        coalesce(rule_sentiment, 'neutral') AS sentiment_model,
        coalesce(rule_theme, 'other') AS theme_model,
        coalesce(rule_is_spam, false) AS is_spam_model FROM t_rules_done)
""",
)
define(
    "t_comments_enriched",
    """
SELECT c.comment_id, platform, published_at, author_handle, c.comment_text, like_count,
  reply_to_id, language_model, sentiment_model, theme_model, product_model, is_spam_model,
  model_used, rules_complete
FROM t_clean_comments c LEFT JOIN t_predictions p ON c.comment_id = p.comment_id
""",
)

FIELDS = ["language", "sentiment", "theme", "product", "is_spam"]


def norm_human(table: str) -> str:
    plain = ", ".join(f"lower(trim({f}_human)) AS {f}_human" for f in FIELDS[:4])
    return f"""SELECT comment_id, comment_text, {plain},
  CASE WHEN lower(trim(is_spam_human)) IN ({items(lx.TRUTHY)}) THEN true
    WHEN lower(trim(is_spam_human)) IN ({items(lx.FALSY)}) THEN false END AS is_spam_human
FROM {table}"""


_MATCH = ", ".join(f"coalesce({f}_human = {f}_model, false) AS {f}_match" for f in FIELDS)
_ALL = " AND ".join(f"coalesce({f}_human = {f}_model, false)" for f in FIELDS)
define(
    "t_compared",
    f"""
SELECT comment_id, comment_text, {", ".join(f"{f}_human, {f}_model" for f in FIELDS)}, {_MATCH},
  {_ALL} AS exact_match
FROM ({norm_human("r_human")}) JOIN t_predictions USING (comment_id, comment_text)
""",
)
define(
    "t_pairs",
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, {f}_human::VARCHAR AS human, {f}_model::VARCHAR AS model "
        f"FROM t_compared WHERE {f}_human IS NOT NULL AND {f}_model IS NOT NULL"
        for f in FIELDS
    ),
)

QUERIES = {
    "theme_sentiment": f"""SELECT theme_model AS label,
      {", ".join(f"{count_if(f"sentiment_model = '{s}'")} AS {s}" for s in lx.CLASSES["sentiment"])}
      FROM t_comments_enriched WHERE NOT is_spam_model GROUP BY 1""",
    "product_sentiment": f"""SELECT product_model AS label,
      {", ".join(f"{count_if(f"sentiment_model = '{s}'")} AS {s}" for s in lx.CLASSES["sentiment"])}
      FROM t_comments_enriched WHERE NOT is_spam_model GROUP BY 1""",
    "field_accuracy": f"""SELECT field, {isum("CASE WHEN human = model THEN 1 ELSE 0 END")}
      AS correct, count(*) AS evaluated,
      {div("sum(CASE WHEN human = model THEN 1 ELSE 0 END)", "count(*)")} AS accuracy
      FROM t_pairs GROUP BY field""",
    "exact_agreement": f"""SELECT {count_if("exact_match")} AS agreed, count(*) AS evaluated,
      {div(count_if("exact_match"), "count(*)")} AS agreement FROM t_compared""",
}
