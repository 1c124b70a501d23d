"""Completing rule labels with an optional scorer.

A scorer is a function from a frame with ``score_key`` and ``comment_text`` to the same keys
with raw ``language, sentiment, theme, is_spam`` text labels and, if it likes, the ``error`` that
kept it from labelling a text. The default answers the constant labels with plain columns;
``pandas_scorer`` wraps a batch model. ``score_log`` scores incrementally.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions import lexicon as lx
from signals.operators import voice_rules
from signals.operators.conform import LABEL_COLUMNS
from signals.sources.io import stage

Scorer = Callable[[DataFrame], DataFrame]
RAW_FIELDS = voice_rules.SCORED_FIELDS
PREDICTION_COLUMNS = [
    "comment_id", "comment_text", "language_model", "sentiment_model", "theme_model",
    "product_model", "is_spam_model", "model_used", "rules_complete", "coerced",
]


def constant_scorer(texts: DataFrame) -> DataFrame:
    """Every open field gets its default label."""
    return texts.select(
        "score_key", *[F.lit(str(lx.DEFAULTS[f]).lower()).alias(f) for f in RAW_FIELDS]
    )


def _isolated(label_batch: Callable[[pd.Series], pd.DataFrame], texts: pd.Series) -> pd.DataFrame:
    """Labels of a batch. A batch that fails is halved until the texts at fault stand alone; they
    get the error instead of labels, all others their labels."""
    try:
        labels = label_batch(texts)
        if len(labels) != len(texts):
            raise ValueError(f"{len(labels)} answers to {len(texts)} texts")
        return labels.reindex(columns=RAW_FIELDS).assign(error=None)
    except Exception as fault:  # whatever a model raises concerns its batch only
        if len(texts) == 1:
            empty = pd.DataFrame(None, index=texts.index, columns=RAW_FIELDS, dtype=object)
            return empty.assign(error=f"{type(fault).__name__}: {fault}")
        half = len(texts) // 2
        parts = [_isolated(label_batch, texts.iloc[:half]), _isolated(label_batch, texts.iloc[half:])]
        return pd.concat([p.astype(object) for p in parts])


def pandas_scorer(label_batch: Callable[[pd.Series], pd.DataFrame]) -> Scorer:
    """Scorer from a function of a batch of texts to a frame with the raw label columns.

    A row the function labels with NULL in every field counts as failed; so does a text the
    function cannot take, alone.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            labels = _isolated(label_batch, batch["comment_text"])
            labels.insert(0, "score_key", batch["score_key"].to_numpy())
            yield labels.astype(object).where(labels.notna(), None)

    schema = "score_key string, " + ", ".join(f"{f} string" for f in RAW_FIELDS) + ", error string"
    return lambda texts: texts.select("score_key", "comment_text").mapInPandas(run, schema)


def truthy(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value)).isin(*lx.TRUTHY), F.lit(False))


def repaired(value: Column, aliases: dict[str, str]) -> Column:
    """A label written under another known name becomes the label."""
    pairs = [F.lit(x) for pair in aliases.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[value], value)


def conform_labels(df: DataFrame) -> DataFrame:
    """Raw labels to the closed vocabularies, known other names first; ``coerced`` lists the
    fields that had to be replaced."""
    fields = [f for f in RAW_FIELDS if f != "is_spam"]
    clean = {f: F.lower(F.trim(F.col(f))) for f in fields}
    clean["theme"] = repaired(clean["theme"], lx.THEME_ALIASES)
    known = {f: F.coalesce(clean[f].isin(*lx.CLASSES[f]), F.lit(False)) for f in fields}
    replaced = F.array(*[F.when(~known[f], F.lit(f)) for f in fields])
    return df.select(
        *[c for c in df.columns if c not in RAW_FIELDS],
        *[F.when(known[f], clean[f]).otherwise(lx.DEFAULTS[f]).alias(f) for f in fields],
        truthy(F.col("is_spam")).alias("is_spam"),
        F.array_compact(replaced).alias("coerced"),
    )


def _text_key(text: Column) -> Column:
    return F.sha2(voice_rules.normalize_comment(text), 256)


ANSWERED = " or ".join(f"{f} is not null" for f in RAW_FIELDS)


def raw_scores(ruled: DataFrame, scorer: Scorer = constant_scorer) -> DataFrame:
    """A scorer's answers per distinct normal text among the comments the rules leave open.

    Copies of a text collapse before the shuffle and the scorer sees each text once.
    """
    texts = (
        ruled.where(~F.col("rules_complete"))
        .select(voice_rules.normalize_comment(F.col("comment_text")).alias("comment_text"))
        .distinct()
        .withColumn("score_key", F.sha2("comment_text", 256))
    )
    return scorer(texts)


def score_distinct_texts(ruled: DataFrame, scorer: Scorer = constant_scorer) -> DataFrame:
    """Conformed labels per distinct open text; texts without any label are left out."""
    return conform_labels(raw_scores(ruled, scorer).where(ANSWERED).drop("error"))


def merge_rules_and_scores(ruled: DataFrame, scores: DataFrame) -> DataFrame:
    """Rules first, scorer for what they leave open; the product is never the scorer's.

    An open comment whose text has no score failed and is not returned.
    """
    done = ruled.where("rules_complete").withColumn("coerced", F.array().cast("array<string>"))
    open_rows = ruled.where(~F.col("rules_complete")).withColumn(
        "score_key", _text_key(F.col("comment_text"))
    )
    scored = open_rows.join(scores, "score_key")

    def label(df: DataFrame, with_scores: bool) -> DataFrame:
        final = {
            f: F.coalesce(f"rule_{f}", f) if with_scores else F.col(f"rule_{f}")
            for f in RAW_FIELDS
        }
        product = F.coalesce(F.col("rule_product"), voice_rules.derive_product(final["theme"]))
        return df.select(
            "comment_id",
            "comment_text",
            final["language"].alias("language_model"),
            final["sentiment"].alias("sentiment_model"),
            final["theme"].alias("theme_model"),
            product.alias("product_model"),
            final["is_spam"].alias("is_spam_model"),
            (~F.col("rules_complete")).alias("model_used"),
            "rules_complete",
            "coerced",
        )

    return label(done, False).unionByName(label(scored, True))


def default_label_columns() -> list[Column]:
    """Label columns of a ruled comment whose open fields take their defaults.

    The default label of a field is the same for every text, so a coalesce is enough.
    """
    final = {f: F.coalesce(F.col(f"rule_{f}"), F.lit(lx.DEFAULTS[f])) for f in RAW_FIELDS}
    product = F.coalesce(F.col("rule_product"), voice_rules.derive_product(final["theme"]))
    return [
        final["language"].alias("language_model"),
        final["sentiment"].alias("sentiment_model"),
        final["theme"].alias("theme_model"),
        product.alias("product_model"),
        final["is_spam"].alias("is_spam_model"),
        (~F.col("rules_complete")).alias("model_used"),
        F.col("rules_complete"),
    ]


def default_labels(ruled: DataFrame) -> DataFrame:
    """``merge_rules_and_scores`` with the constant scorer, without its join."""
    return ruled.select(
        "comment_id",
        "comment_text",
        *default_label_columns(),
        F.array().cast("array<string>").alias("coerced"),
    )


def labelled_comments(comments: DataFrame) -> DataFrame:
    """Comments with the default labels of their own text, which need no join; a blank comment
    keeps NULL labels, like one that nobody scored."""
    said = F.col("comment_text") != ""
    ruled = voice_rules.classify_rules(comments)
    return ruled.select(
        *comments.columns,
        F.inline(F.array(F.struct(*default_label_columns()))),
    ).select(
        *comments.columns, *[F.when(said, F.col(c)).alias(c) for c in LABEL_COLUMNS]
    )


def predict_reporting(
    comments: DataFrame, scorer: Scorer | None = None
) -> tuple[DataFrame, DataFrame]:
    """One prediction per distinct (comment_id, text), and the comments without one because their
    text failed, with the error. Blank comments have neither."""
    texts = comments.where("comment_text <> ''").select("comment_id", "comment_text").distinct()
    ruled = voice_rules.classify_rules(texts)
    none = texts.where("false").withColumn("error", F.lit(None).cast("string"))
    if scorer is None:
        return default_labels(ruled), none
    # Read several times below, so rules and scorer run once and are written.
    ruled = stage(ruled)
    raw = raw_scores(ruled, scorer)
    raw = stage(raw if "error" in raw.columns else raw.withColumn("error", F.lit(None).cast("string")))
    scores = conform_labels(raw.where(ANSWERED).drop("error"))
    lost = raw.where(f"not ({ANSWERED})").select(
        "score_key", F.coalesce("error", F.lit("no label")).alias("error")
    )
    open_rows = ruled.where(~F.col("rules_complete")).select(
        "comment_id", "comment_text", _text_key(F.col("comment_text")).alias("score_key")
    )
    failed = open_rows.join(lost, "score_key").select("comment_id", "comment_text", "error")
    return merge_rules_and_scores(ruled, scores), failed


def predict(comments: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """One prediction per distinct (comment_id, text); blank comments have none."""
    return predict_reporting(comments, scorer)[0]


def run_summary(predictions: DataFrame) -> DataFrame:
    """Counts of a scoring run: (item, comments)."""
    flags = predictions.agg(
        F.count("*").alias("total"),
        F.count_if("rules_complete").alias("rules_only"),
        F.count_if("model_used").alias("model_used"),
        *[
            F.count_if(F.array_contains("coerced", f)).alias(f"coerced_{f}")
            for f in RAW_FIELDS
            if f != "is_spam"
        ],
    )
    return flags.unpivot([], flags.columns, "item", "comments")


def new_only(comments: DataFrame, scored: DataFrame, version: str) -> DataFrame:
    """Comments the given classifier version has not scored yet."""
    current = scored.where(F.col("classifier_version") == version).select("comment_id")
    return comments.join(current, "comment_id", "left_anti")


def keep_last(predictions: DataFrame, *also: str) -> DataFrame:
    """Latest run's row per comment (and value of the columns `also`), as an aggregate so that a hot
    id combines early. The row compares by run and text first, so it carries its text only once."""
    keys = ["comment_id", *also]
    columns = [c for c in predictions.columns if c not in keys]
    first = ["run_id", "comment_text"]
    newest = F.max(F.struct(*first, *[c for c in columns if c not in first]))
    return predictions.groupBy(*keys).agg(newest.alias("row")).select(*keys, *[f"row.{c}" for c in columns])


def predicted_twice(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both label sets of the comments two predictions share, one row per comment."""
    fields = ["language", "sentiment", "theme", "product", "is_spam"]
    left = first.select("comment_id", *[F.col(f"{f}_model").alias(f"{f}_a") for f in fields])
    right = second.select("comment_id", *[F.col(f"{f}_model").alias(f"{f}_b") for f in fields])
    return left.join(right, "comment_id")


def version_drift(first: DataFrame, second: DataFrame) -> DataFrame:
    """Per field: comments compared, changed, and the share changed."""
    both = predicted_twice(first, second)
    fields = ["language", "sentiment", "theme", "product", "is_spam"]
    counted = both.agg(
        F.count("*").alias("compared"),
        *[
            F.count_if(~F.col(f"{f}_a").eqNullSafe(F.col(f"{f}_b"))).alias(f) for f in fields
        ],
    )
    long = counted.unpivot(["compared"], fields, "field", "changed")
    return long.withColumn("changed_share", F.try_divide("changed", "compared"))


def single_version(predictions: DataFrame, comments: DataFrame) -> DataFrame:
    """Versions present, volumes on both sides, and whether they agree."""
    expected = comments.select("comment_id").distinct().agg(F.count("*")).scalar()
    return predictions.agg(
        F.count_distinct("classifier_version").alias("versions"),
        F.count("*").alias("predicted"),
    ).select(
        "versions",
        "predicted",
        expected.alias("source_comments"),
        ((F.col("versions") == 1) & (F.col("predicted") == expected)).alias("consistent"),
    )

