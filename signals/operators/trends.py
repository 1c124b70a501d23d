"""Trend, ranking and comparison figures over a (month, category, value) result.

Inputs are metric results, already at month or category grain, so their size depends on the
calendar and the vocabulary, not on the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.functions.money import one_row, variation

STABLE_CHANGE = 0.01
STABLE_POINTS = 0.005
STABLE_SHARE = 0.01


def direction_label(change: Column, threshold: float) -> Column:
    return (
        F.when(F.abs(change) < threshold, "stable").when(change > 0, "up").when(change < 0, "down")
    )


def trend_label(change: Column) -> Column:
    """Direction of a relative change; under 1 % is stable."""
    return direction_label(change, STABLE_CHANGE)


def points_label(change: Column) -> Column:
    """Direction of a change between two shares; under half a point is stable."""
    return direction_label(change, STABLE_POINTS)


def _named(df: DataFrame, value: str) -> DataFrame:
    return df.withColumnRenamed(value, "value").where(F.col("value").isNotNull())


def _best(by: Column, *tie: str) -> Column:
    """Order key: largest first, then the tie columns ascending (use with min_by)."""
    return F.struct(-by, *tie)


def variation_by_month(df: DataFrame, value: str) -> DataFrame:
    """Each month with the previous month present, the change and its direction."""
    series = _named(df, value).select("month", "value")
    ordered = series.agg(F.array_sort(F.collect_list(F.struct("month", "value"))).alias("s"))
    rows = ordered.select(F.posexplode("s").alias("i", "r"), "s").select(
        "r.month",
        "r.value",
        F.get("s", F.col("i") - 1)["value"].alias("previous_value"),
    )
    change = variation(F.col("value"), F.col("previous_value"))
    return rows.select("*", change.alias("change")).withColumn("trend", trend_label(F.col("change")))


def monthly_trend(df: DataFrame, value: str) -> DataFrame:
    """First, last, changes, total, best and worst month of one series (one row)."""
    series = _named(df, value).select("month", "value")
    v = F.col("value")
    summary = series.agg(
        F.array_sort(F.collect_list(F.struct("month", "value"))).alias("s"),
        F.sum("value").alias("total_value"),
        F.min_by("month", _best(v, "month")).alias("best_month"),
        F.max("value").alias("best_value"),
        F.min_by("month", F.struct("value", "month")).alias("worst_month"),
        F.min("value").alias("worst_value"),
    ).where(F.size("s") > 0)
    first, last = F.element_at("s", 1), F.element_at("s", -1)
    before = F.when(F.size("s") >= 3, F.get("s", F.size("s") - 2))
    change = variation(last["value"], first["value"])
    recent = variation(last["value"], before["value"])
    return summary.select(
        F.size("s").alias("months"),
        first["month"].alias("first_month"),
        first["value"].alias("first_value"),
        last["month"].alias("last_month"),
        last["value"].alias("last_value"),
        change.alias("change"),
        trend_label(change).alias("trend"),
        before["month"].alias("previous_month"),
        recent.alias("recent_change"),
        trend_label(recent).alias("recent_trend"),
        "total_value",
        "best_month",
        "best_value",
        "worst_month",
        "worst_value",
    )


def category_totals(df: DataFrame, dimension: str, value: str) -> DataFrame:
    return (
        _named(df, value)
        .groupBy(F.col(dimension).alias("category"))
        .agg(F.sum("value").alias("value"))
    )


def category_breakdown(df: DataFrame, dimension: str, value: str) -> DataFrame:
    """Totals by category with their share; the first, second and last are marked.

    Ties go to the first by name. No global sort: a category list may be long.
    """
    totals = category_totals(df, dimension, value)
    best = F.struct(-F.col("value"), "category")
    overall = one_row(
        totals.agg(
            F.min_by("category", best).alias("first"),
            F.max_by("category", best).alias("last"),
            F.sum("value").alias("total"),
        )
    )
    first, last, total = overall["first"], overall["last"], overall["total"]
    second = totals.where(F.col("category") != first).agg(F.min_by("category", best)).scalar()
    name = F.col("category")
    return totals.select(
        "category",
        "value",
        F.try_divide("value", total).alias("share"),
        F.when(name == first, "first")
        .when(name == second, "second")
        .when(name == last, "last")
        .alias("place"),
        total.alias("total_value"),
    )


def ranking(df: DataFrame, dimension: str, value: str, lowest: bool = False) -> DataFrame:
    """The most (or least) and the next two, with shares."""
    totals = category_totals(df, dimension, value)
    total = totals.agg(F.sum("value")).scalar()
    key = F.col("value") if lowest else -F.col("value")
    return (
        totals.orderBy(key, "category")
        .limit(3)
        .select("category", "value", F.try_divide("value", total).alias("share"))
    )


def share_trend(df: DataFrame, dimension: str, value: str) -> DataFrame:
    """Share of the leading category in the first and the last month.

    The leader is the category with the largest sum of monthly shares.
    """
    rows = (
        _named(df, value)
        .groupBy("month", F.col(dimension).alias("category"))
        .agg(F.sum("value").alias("value"))
    )
    monthly = rows.groupBy("month").agg(F.sum("value").alias("month_total"))
    shares = rows.join(monthly, "month").select(
        "month", "category", F.try_divide("value", "month_total").alias("share")
    )
    ends = one_row(monthly.agg(F.min("month").alias("a"), F.max("month").alias("b")))
    bounds = ends["a"], ends["b"]
    per_category = shares.groupBy("category").agg(
        F.sum("share").alias("weight"),
        F.max(F.when(F.col("month") == bounds[0], F.col("share"))).alias("first_share"),
        F.max(F.when(F.col("month") == bounds[1], F.col("share"))).alias("last_share"),
    )
    lead = per_category.orderBy(F.desc("weight"), "category").limit(1)
    change = F.col("last_share") - F.col("first_share")
    return lead.select(
        "category",
        bounds[0].alias("first_month"),
        "first_share",
        bounds[1].alias("last_month"),
        "last_share",
        change.alias("share_change"),
        direction_label(change, STABLE_SHARE).alias("trend"),
    )


def best_and_worst_month(df: DataFrame, value: str) -> DataFrame:
    monthly = _named(df, value).groupBy("month").agg(F.sum("value").alias("value"))
    return monthly.agg(
        F.count("*").alias("months"),
        F.min_by("month", _best(F.col("value"), "month")).alias("best_month"),
        F.max("value").alias("best_value"),
        F.min_by("month", F.struct("value", "month")).alias("worst_month"),
        F.min("value").alias("worst_value"),
    )


def month_category(df: DataFrame, dimension: str, value: str) -> DataFrame:
    """Category breakdown with the best and the worst month beside it."""
    extremes = best_and_worst_month(df, value)
    names = ["best_month", "best_value", "worst_month", "worst_value"]
    row = one_row(extremes)
    return category_breakdown(df, dimension, value).select("*", *[row[n].alias(n) for n in names])


def compare_members(df: DataFrame, dimension: str, value: str) -> DataFrame:
    """Leader against runner-up: gap, ratio, tie, and months the leader is ahead."""
    totals = category_totals(df, dimension, value)
    order = F.struct(-F.col("value"), "category", "value")
    two = totals.orderBy(-F.col("value"), "category").limit(2)
    members = totals.agg(F.count("*")).scalar()
    pair = two.agg(
        F.array_sort(F.collect_list(order)).alias("s"), F.max(members).alias("members")
    ).where("members >= 2")
    lead, second = F.get("s", 0), F.get("s", 1)
    named = pair.select(
        lead["category"].alias("leader"),
        second["category"].alias("runner_up"),
        lead["value"].alias("leader_value"),
        second["value"].alias("runner_up_value"),
        "members",
    )
    names = one_row(named.select("leader", "runner_up"))
    leader, runner = names["leader"], names["runner_up"]
    rows = _named(df, value).groupBy("month").agg(
        F.sum(F.when(F.col(dimension) == leader, F.col("value"))).alias("a"),
        F.sum(F.when(F.col(dimension) == runner, F.col("value"))).alias("b"),
    )
    both = rows.where("a is not null and b is not null")
    ahead = one_row(
        both.agg(F.count_if(F.col("a") > F.col("b")).alias("ahead"), F.count("*").alias("n"))
    )
    gap = F.col("leader_value") - F.col("runner_up_value")
    return named.select(
        "*",
        gap.alias("gap"),
        F.when(
            F.col("runner_up_value") > 0, F.try_divide("leader_value", "runner_up_value")
        ).alias("times"),
        ((F.col("members") == 2) & (gap == 0)).alias("is_tie"),
        ahead["ahead"].alias("months_ahead"),
        ahead["n"].alias("months_compared"),
    )


def ratio_by_category(df: DataFrame, dimension: str, value: str) -> DataFrame:
    """Highest and lowest share among categories; NULL shares do not take part."""
    v = F.col("value")
    return (
        _named(df, value)
        .withColumnRenamed(dimension, "category")
        .agg(
            F.count("*").alias("categories"),
            F.min_by("category", _best(v, "category")).alias("highest"),
            F.max("value").alias("highest_share"),
            F.min_by("category", F.struct("value", "category")).alias("lowest"),
            F.min("value").alias("lowest_share"),
        )
    )


def sentiment_summary(social: DataFrame) -> DataFrame:
    """Split, balance, share trend, worst month, best and worst platform (one row).

    Input: month, platform and the usable, positive, neutral and negative counts.
    """
    counts = ["usable", "positive", "neutral", "negative"]
    total = social.agg(*[F.sum(c).alias(c) for c in counts]).where("usable > 0")
    good, bad = F.col("positive"), F.col("negative")

    def shares(key: str) -> DataFrame:
        return (
            social.groupBy(key)
            .agg(*[F.sum(c).alias(c) for c in counts])
            .where("usable > 0")
            .select(
                key,
                F.try_divide("positive", "usable").alias("good"),
                F.try_divide("negative", "usable").alias("bad"),
            )
        )

    monthly = shares("month").agg(
        F.min_by("good", "month").alias("first_positive_share"),
        F.max_by("good", "month").alias("last_positive_share"),
        F.min_by("month", F.struct(-F.col("bad"), "month")).alias("worst_month"),
        F.max("bad").alias("worst_month_negative_share"),
    )
    platforms = shares("platform").agg(
        F.min_by("platform", F.struct(-F.col("good"), "platform")).alias("best_platform"),
        F.min_by("platform", F.struct("good", "platform")).alias("lowest_platform"),
        F.min_by("platform", F.struct(-F.col("bad"), "platform")).alias("most_negative_platform"),
    )

    def pick(frame: DataFrame) -> list[Column]:
        row = one_row(frame)
        return [row[c].alias(c) for c in frame.columns]

    change = F.col("last_positive_share") - F.col("first_positive_share")
    return (
        total.select(
            *counts,
            *[F.try_divide(c, "usable").alias(f"{c}_share") for c in counts[1:]],
            F.when((bad > 0) & (good > bad), F.try_divide(good, bad))
            .when((good > 0) & (bad > good), F.try_divide(bad, good))
            .alias("balance_ratio"),
            F.when(good > bad, "positive")
            .when(bad > good, "negative")
            .otherwise("even")
            .alias("prevailing"),
            *pick(monthly),
            *pick(platforms),
        )
        .withColumn("positive_share_change", change)
        .withColumn("positive_share_trend", direction_label(change, STABLE_SHARE))
    )


def top_labels(wide: DataFrame, columns: dict[str, str], n: int = 3, key: str | None = None):
    """The n largest labels of a row of counts; ties keep the declared order, zeros drop.

    ``columns`` maps label -> count column. Works per row on a small array, so it needs no
    shuffle; with ``key`` the row's key is carried along.
    """
    entries = F.array(
        *[
            F.struct(
                (-F.col(c)).alias("o"),
                F.lit(i).alias("i"),
                F.lit(label).alias("label"),
                F.col(c).alias("n"),
            )
            for i, (label, c) in enumerate(columns.items())
        ]
    )
    kept = F.slice(F.array_sort(F.filter(entries, lambda e: e["n"] > 0)), 1, n)
    keys = [key] if key else []
    return wide.select(*keys, F.posexplode(kept).alias("i", "e")).select(
        *keys,
        (F.col("i") + 1).alias("position"),
        F.col("e.label").alias("label"),
        F.col("e.n").alias("comments"),
    )


def wide_to_long(df: DataFrame, columns: list[str], name: str = "label", value: str = "value"):
    """Totals of the named columns as (label, value) rows."""
    totals = df.agg(*[F.sum(c).alias(c) for c in columns])
    return totals.unpivot([], columns, name, value)


def month_pivot(df: DataFrame, dimension: str, value: str, members: list[str]) -> DataFrame:
    """Month rows, one column per listed member; a missing cell stays NULL."""
    return df.groupBy("month").agg(
        *[F.sum(F.when(F.col(dimension) == m, F.col(value))).alias(m) for m in members]
    )


def crosstab(df: DataFrame, row: str, column: str, members: list[str], keep: Column) -> DataFrame:
    """Counts of row label by column label among the rows kept; a missing cell is 0."""
    counted = df.groupBy(F.col(row).alias("label")).agg(
        F.count_if(keep).alias("kept"),
        *[F.count_if(keep & (F.col(column) == m)).alias(m) for m in members],
    )
    return counted.where("kept > 0").drop("kept")
