"""Labels of a classifier against labels given by people."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions import lexicon as lx
from signals.sources.io import ContractError, union_all

FIELDS = ["language", "sentiment", "theme", "product", "is_spam"]
# How a validated draft row is marked.
VALIDATED_MARKS = ["oui", "yes", "true"]
HUMAN_CLASSES = {**lx.CLASSES, "is_spam": ["true", "false"]}


def normalize_bool(value: Column) -> Column:
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isin(*lx.TRUTHY), True).when(text.isin(*lx.FALSY), False)


def label_normalise(df: DataFrame, suffix: str) -> DataFrame:
    """Text labels trimmed and lower-cased, truthy or falsy text to boolean."""
    out = df
    for field in FIELDS:
        name = f"{field}_{suffix}"
        value = F.col(name)
        clean = normalize_bool(value) if field == "is_spam" else F.lower(F.trim(value))
        out = out.withColumn(name, clean)
    return out


def one_per_key(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """`df`, refusing to be read when a key occurs twice.

    The rows are counted per key in the aggregate that the join on the same keys needs to shuffle
    anyway; no pass or action of its own.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"), F.count("*").alias("_n"))
    told = F.concat(F.lit(f"{name}: rows are not unique: "), *[F.col(k).cast("string") for k in keys[:1]])
    single = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))
    return grouped.where(single).select(*keys, "_row.*")


def prediction_vs_human(human: DataFrame, predictions: DataFrame) -> DataFrame:
    """One-to-one inner join on id and text, labels normalised, with match flags.

    A NULL on either side is a mismatch, as it is in every count but the accuracy. A key that
    occurs twice on either side fails the query.
    """
    left = label_normalise(human, "human").select(
        "comment_id", "comment_text", *[f"{f}_human" for f in FIELDS]
    )
    right = label_normalise(predictions, "model").select(
        "comment_id", "comment_text", *[f"{f}_model" for f in FIELDS]
    )
    keys = ["comment_id", "comment_text"]
    joined = one_per_key(left, keys, "human labels").join(one_per_key(right, keys, "predictions"), keys)
    match = [
        F.coalesce(F.col(f"{f}_human") == F.col(f"{f}_model"), F.lit(False)).alias(f"{f}_match")
        for f in FIELDS
    ]
    matched = joined.select("*", *match)
    exact = reduce(lambda a, b: a & b, [F.col(f"{f}_match") for f in FIELDS])
    return matched.withColumn("exact_match", exact)


def unmatched_count(human: DataFrame, predictions: DataFrame) -> DataFrame:
    """How many human rows have no prediction."""
    keys = ["comment_id", "comment_text"]
    return human.join(predictions.select(*keys), keys, "left_anti").agg(
        F.count("*").alias("unmatched")
    )


def long_labels(compared: DataFrame) -> DataFrame:
    """(field, human, model) rows of the pairs where both labels are known."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"{f}_human").cast("string").alias("human"),
                F.col(f"{f}_model").cast("string").alias("model"),
            )
            for f in FIELDS
        ]
    )
    return compared.select(F.inline(pairs)).where("human is not null and model is not null")


def confusion(compared: DataFrame) -> DataFrame:
    return long_labels(compared).groupBy("field", "human", "model").agg(F.count("*").alias("n"))


def field_accuracy(compared: DataFrame) -> DataFrame:
    right = F.sum(F.when(F.col("human") == F.col("model"), F.col("n")).otherwise(0))
    return (
        confusion(compared)
        .groupBy("field")
        .agg(right.alias("correct"), F.sum("n").alias("evaluated"))
        .withColumn("accuracy", F.try_divide("correct", "evaluated"))
    )


def class_report(compared: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class seen on either side."""
    cells = confusion(compared)
    hit = F.when(F.col("human") == F.col("model"), F.col("n")).otherwise(0)
    counted = union_all(
        [
            cells.select("field", F.col("human").alias("label"), hit.alias("hits"),
                         F.col("n").alias("support"), F.lit(0).alias("predicted")),
            cells.select("field", F.col("model").alias("label"), F.lit(0).alias("hits"),
                         F.lit(0).alias("support"), F.col("n").alias("predicted")),
        ]
    )
    sums = counted.groupBy("field", "label").agg(
        *[F.sum(c).alias(c) for c in ("hits", "support", "predicted")]
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "predicted"), zero)
    recall = F.coalesce(F.try_divide("hits", "support"), zero)
    f1 = F.coalesce(
        F.try_divide(F.col("hits") * 2, F.col("support") + F.col("predicted")), zero
    )
    return sums.select(
        "field",
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        "support",
    )


def exact_agreement(compared: DataFrame) -> DataFrame:
    return compared.agg(
        F.count_if("exact_match").alias("agreed"), F.count("*").alias("evaluated")
    ).withColumn("agreement", F.try_divide("agreed", "evaluated"))


def field_errors(compared: DataFrame) -> DataFrame:
    counted = compared.agg(
        F.count("*").alias("evaluated"), *[F.count_if(~F.col(f"{f}_match")).alias(f) for f in FIELDS]
    )
    return counted.unpivot(["evaluated"], FIELDS, "field", "errors").withColumn(
        "error_rate", F.coalesce(F.try_divide("errors", "evaluated"), F.lit(0.0))
    )


def error_rows(compared: DataFrame) -> DataFrame:
    return compared.where(~F.col("exact_match")).drop("exact_match")


def constant_baseline(human: DataFrame) -> DataFrame:
    """Majority class of each field and its share; ties go to the first label by name."""
    labels = label_normalise(human, "human")
    pairs = [
        F.struct(F.lit(f).alias("field"), F.col(f"{f}_human").cast("string").alias("label"))
        for f in FIELDS
    ]
    long = labels.select(F.inline(F.array(*pairs)))
    counts = long.where("label is not null").groupBy("field", "label").agg(F.count("*").alias("n"))
    return counts.groupBy("field").agg(
        F.min_by("label", F.struct(-F.col("n"), "label")).alias("majority_label"),
        F.try_divide(F.max("n"), F.sum("n")).alias("accuracy"),
    )


def merge_refusals(human: DataFrame, draft: DataFrame) -> DataFrame:
    """(comment_id, reason) of validated draft rows that may not be merged."""
    ready = _validated(draft)
    bad = [
        ready.where(~F.coalesce(F.lower(F.trim(f"{f}_human")).isin(*classes), F.lit(False))).select(
            "comment_id", F.lit(f"{f}_human").alias("reason")
        )
        for f, classes in HUMAN_CLASSES.items()
    ]
    known = ready.join(human.select("comment_id"), "comment_id", "left_semi").select(
        "comment_id", F.lit("already_labelled").alias("reason")
    )
    return union_all([*bad, known])


def _validated(draft: DataFrame) -> DataFrame:
    mark = F.lower(F.trim("validated"))
    return draft.where(F.coalesce(mark.isin(*VALIDATED_MARKS), F.lit(False))).drop("validated")


def merge_validated(human: DataFrame, draft: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged labels, remaining draft); a single refused row refuses them all."""
    refused = merge_refusals(human, draft).limit(5).collect()
    if refused:
        raise ContractError("; ".join(f"{r.comment_id}: {r.reason}" for r in refused))
    mark = F.lower(F.trim("validated"))
    rest = draft.where(~F.coalesce(mark.isin(*VALIDATED_MARKS), F.lit(False)))
    return human.unionByName(_validated(draft).select(*human.columns)), rest
