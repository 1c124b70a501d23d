"""Comment labelling rules as column expressions; NULL means "the rules do not know".

``classify_rules`` adds its columns in a few stages so that each normalised text and each
pattern group is evaluated once per comment. Everything is narrow: no shuffle, no Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions import lexicon as lx
from signals.functions.patterns import (
    END, SPACE, WORD, Markers, among, any_of, count_words, has_any, has_word, known_words, text_stems,
    to_java, whole_words,
)

RULE_FIELDS = ["language", "sentiment", "theme", "product", "is_spam"]
SCORED_FIELDS = ["language", "sentiment", "theme", "is_spam"]


def normalize_comment(text: Column) -> Column:
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    trimmed = F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")
    return F.lower(F.when(ends.rlike(SPACE), trimmed).otherwise(text))


def strip_fillers(normal: Column) -> Column:
    """Drop a leading interjection and the stock ending, from an already normal text."""
    opening = f"^(?:{'|'.join(lx.LEADING_FILLERS)}){END}(?:{SPACE}|,)*"
    ending = f"([^{WORD}]|^){lx.TRAILING_FILLER}{SPACE}*\\?*"
    # Few texts hold the letters of either, the others are what they were.
    opens = reduce(lambda a, b: a | b, [normal.startswith(word) for word in lx.LEADING_FILLERS])
    ends = normal.contains(lx.TRAILING_FILLER.rpartition(")")[2])
    cut = F.regexp_replace(F.regexp_replace(normal, opening, ""), ending, "$1")
    return F.when(opens | ends, normalize_comment(cut)).otherwise(normal)


FRENCH, ENGLISH = Markers.of(lx.FRENCH_WORDS), Markers.of(lx.ENGLISH_WORDS)
SLANG, SPAM, HEDGES = (
    Markers.of(lx.SLANG_WORDS), Markers.of(lx.SPAM_PATTERNS), Markers.of(lx.HEDGES)
)
ENGLISH_EXTRA, STRONG_ENGLISH = Markers.of(lx.ENGLISH_EXTRA), Markers.of(lx.STRONG_ENGLISH)
POSITIVE, NEGATIVE = Markers.of(lx.POSITIVE_PATTERNS), Markers.of(lx.NEGATIVE_PATTERNS)
THEMES = {theme: Markers.of(patterns) for theme, patterns in lx.THEME_PATTERNS.items()}
PRAISE = Markers.of(lx.TASTE_IF_PRODUCT)
STEMS = tuple(
    dict.fromkeys(s for m in (POSITIVE, NEGATIVE, PRAISE, *THEMES.values()) for s in m.stems)
)
NEGATION_WORDS = sorted({p.split()[0] for p in lx.NEGATIONS})
# Every word that a rule on a text without its fillers looks up, and every word that any rule does.
BARE_WORDS = sorted({
    *NEGATION_WORDS,
    *(name for names in lx.PRODUCT_PATTERNS.values() for name in names),
    *(
        word
        for m in (HEDGES, POSITIVE, NEGATIVE, PRAISE, *THEMES.values())
        for word in (*m.words, *m.anchors)
    ),
})
KNOWN_WORDS = sorted({
    *BARE_WORDS,
    *(
        word
        for m in (FRENCH, ENGLISH, SLANG, SPAM, ENGLISH_EXTRA, STRONG_ENGLISH)
        for word in (*m.words, *m.anchors)
    ),
})


def rule_language(normal: Column, words: Column) -> Column:
    french, english = has_any(FRENCH, normal, words), has_word(words, ENGLISH.words)
    extra = [
        has_any(Markers.of([p]), normal, words).cast("int") for p in lx.ENGLISH_EXTRA
    ]
    count = reduce(lambda a, b: a + b, extra, count_words(words, ENGLISH.words))
    return (
        F.when(has_any(SLANG, normal, words), "nouchi")
        .when(french & english, "mixed")
        .when(french, "fr")
        .when(english & ((count >= 2) | has_any(STRONG_ENGLISH, normal, words)), "en")
    )


def rule_product(words: Column) -> Column:
    found = {p: has_word(words, names) for p, names in lx.PRODUCT_PATTERNS.items()}
    count = reduce(lambda a, b: a + b, [hit.cast("int") for hit in found.values()])
    out = F.when(count > 1, "multiple")
    for product, hit in found.items():
        out = out.when(hit, product)
    return out


def theme_hits(bare: Column, words: Column, stems: Column) -> list[Column]:
    """One boolean column per theme: is it mentioned at all?"""
    hits = {theme: has_any(markers, bare, words, stems) for theme, markers in THEMES.items()}
    praised = has_any(PRAISE, bare, words, stems) & rule_product(words).isNotNull()
    hits["taste"] = hits["taste"] | praised
    return [hit.alias(f"_about_{theme}") for theme, hit in hits.items()]


def rule_theme() -> Column:
    """The single theme that no other mentioned theme dominates, else NULL."""
    themes = list(lx.THEME_PATTERNS)
    mentioned = {t: F.col(f"_about_{t}") for t in themes}
    survives = {}
    for theme in themes:
        winners = [w for w, losers in lx.THEME_PRIORITY.items() if theme in losers]
        survives[theme] = reduce(lambda a, w: a & ~mentioned[w], winners, mentioned[theme])
    left = F.filter(
        F.array(*[F.when(survives[t], F.lit(t)) for t in themes]), lambda t: t.isNotNull()
    )
    return F.when(F.size(left) == 1, F.element_at(left, 1))


def sentiment_hits(bare: Column, words: Column, stems: Column) -> list[Column]:
    """Positive and negative markers, plain and negated, and hedged wording."""
    before = any_of(lx.NEGATIONS) + to_java(r"\s+(?:\w+\s+){0,3}?")
    negated = has_word(words, NEGATION_WORDS)
    out = [has_any(HEDGES, bare, words).alias("_hedged")]
    for name, markers, patterns in (
        ("positive", POSITIVE, lx.POSITIVE_PATTERNS),
        ("negative", NEGATIVE, lx.NEGATIVE_PATTERNS),
    ):
        found = has_any(markers, bare, words, stems)
        flipped = negated & found & bare.rlike(before + f"(?:{whole_words(patterns)})")
        out += [found.alias(f"_{name}"), flipped.alias(f"_not_{name}")]
    return out


def rule_sentiment(bare: Column) -> Column:
    """A clear marker decides, a negated one flips it, a bare question is neutral."""
    positive, negative = F.col("_positive"), F.col("_negative")
    not_positive, not_negative = F.col("_not_positive"), F.col("_not_negative")
    opinion = (
        F.when(not_positive & ~not_negative, "negative")
        .when(not_negative & ~not_positive, "positive")
        .when(positive & ~negative, "positive")
        .when(negative & ~positive, "negative")
        .when(~positive & ~negative & bare.contains("?"), "neutral")
    )
    return F.when(~F.col("_hedged"), opinion)


def rule_spam(theme: Column, product: Column) -> Column:
    return F.when(F.col("_spam_words"), True).when(
        theme.isNotNull() | product.isNotNull(), False
    )


def emoji_sentiment(normal: Column) -> Column:
    def any_emoji(symbols: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [normal.contains(s) for s in symbols])

    good, bad = any_emoji(lx.POSITIVE_EMOJI), any_emoji(lx.NEGATIVE_EMOJI)
    return F.when(good & ~bad, "positive").when(bad & ~good, "negative").otherwise("neutral")


def is_emoji_only(normal: Column) -> Column:
    return (normal != "") & ~normal.rlike(r"[\p{L}\p{N}]")


def classify_rules(comments: DataFrame, text: str = "comment_text") -> DataFrame:
    """Add rule_<field> for the five fields and ``rules_complete``.

    Precedence: emoji only, conversational formula, spam, general opinion.
    """
    base = comments.columns
    normal, bare = F.col("_normal"), F.col("_bare")
    words, bare_words, stems = F.col("_words"), F.col("_bare_words"), F.col("_stems")
    texts = (
        comments.withColumn("_normal", normalize_comment(F.col(text)))
        .withColumn("_bare", strip_fillers(normal))
        .withColumn("_words", known_words(normal, KNOWN_WORDS, STEMS))
        .withColumn(
            "_bare_words",
            F.when(bare == normal, among(words, BARE_WORDS, STEMS))
            .otherwise(known_words(bare, BARE_WORDS, STEMS)),
        )
        .withColumn("_stems", text_stems(bare_words, STEMS))
    )
    hits = texts.select(
        *base,
        "_normal",
        "_bare",
        *theme_hits(bare, bare_words, stems),
        *sentiment_hits(bare, bare_words, stems),
        rule_language(normal, words).alias("_language"),
        rule_product(words).alias("_product"),
        has_any(SPAM, normal, words).alias("_spam_words"),
        is_emoji_only(normal).alias("_emoji"),
        normal.rlike(f"^(?:{'|'.join(lx.CONVERSATIONAL)})[^{WORD}]*$").alias("_talk"),
    ).withColumn("_sentiment", rule_sentiment(bare))
    language, sentiment, product = F.col("_language"), F.col("_sentiment"), F.col("_product")
    themed = hits.withColumn("_theme", rule_theme())
    theme, spam = F.col("_theme"), F.col("_spam")
    judged = themed.withColumn("_spam", rule_spam(theme, product)).withColumn(
        "_general",
        theme.isNull() & product.isNull() & sentiment.isNotNull() & ~bare.contains("?"),
    )
    emoji, talk = F.col("_emoji"), F.col("_talk")
    silent = emoji | talk
    is_spam, general = F.coalesce(spam, F.lit(False)), F.col("_general")
    out = {
        "language": F.when(emoji, "other").when(talk, F.coalesce(language, F.lit("fr")))
        .otherwise(language),
        "sentiment": F.when(emoji, emoji_sentiment(normal)).when(talk | is_spam, "neutral")
        .otherwise(sentiment),
        "theme": F.when(silent | is_spam | general, "other").otherwise(theme),
        "product": F.when(silent | is_spam, "none").otherwise(product),
        "is_spam": F.when(silent, False).when(is_spam, True).when(general, False).otherwise(spam),
    }
    labels = F.struct(*[c.alias(f"rule_{f}") for f, c in out.items()])
    # One struct per row, unpacked by a generator: a later filter on a label then stays above
    # it, where pushing it down would repeat the whole rule tree inside the filter.
    ruled = judged.select(*base, F.inline(F.array(labels)))
    return ruled.withColumn("rules_complete", rules_complete())


def rules_complete() -> Column:
    """Can the rules alone label the comment? The product is derived, so it may be open."""
    return reduce(lambda a, b: a & b, [F.col(f"rule_{f}").isNotNull() for f in SCORED_FIELDS])


def derive_product(theme: Column) -> Column:
    """Product of a comment that names none."""
    return F.when(theme.isin(*lx.PRODUCT_THEMES), "unknown").otherwise("none")
