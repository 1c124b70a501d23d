"""Profiles of raw tables: counts, spans, conflicts, lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """(table, measure, value): rows, columns, NULLs per column, rows in duplicate groups.

    One grouping over all columns serves both the NULL counts and the duplicates.
    """
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    n = F.col("_n")
    counted = groups.agg(
        F.sum(n).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("duplicate_group_rows"),
        *[
            F.coalesce(F.sum(F.when(F.col(c).isNull(), n)), F.lit(0)).alias(f"null_{c}")
            for c in df.columns
        ],
    )
    return counted.unpivot([], counted.columns, "measure", "value").select(
        F.lit(name).alias("table_name"), "measure", "value"
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, NULL included."""
    return df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("row_count"))


def missing_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns],
    )


def planned_vs_invoiced(plan: DataFrame) -> DataFrame:
    planned, invoiced = F.sum("planned_budget_fcfa"), F.sum("invoiced_fcfa")
    return plan.groupBy("channel").agg(
        planned.alias("planned_fcfa"),
        invoiced.alias("invoiced_fcfa"),
        (invoiced - planned).alias("variance_fcfa"),
    )


def date_span(df: DataFrame, column: str) -> DataFrame:
    """First and last day and the number of days seen, from one row per day."""
    days = df.groupBy(F.col(column).cast("date").alias("day")).agg(F.count("*").alias("n"))
    return days.agg(
        F.min("day").alias("min_date"),
        F.max("day").alias("max_date"),
        F.count("day").alias("distinct_days"),
    )


def rows_per_day(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("date").alias("day")).agg(F.count("*").alias("row_count"))


def id_name_conflicts(df: DataFrame, key: str, other: str) -> DataFrame:
    """Keys used with several values of ``other``, and those values joined in order."""
    pairs = df.where(F.col(other).isNotNull()).select(key, other).distinct()
    joined = pairs.groupBy(key).agg(
        F.count("*").alias("distinct_values"),
        F.array_join(F.sort_array(F.collect_list(other)), " | ").alias("joined_values"),
    )
    return joined.where("distinct_values > 1").withColumnRenamed(key, "key_value")


def negative_profile(sales: DataFrame) -> DataFrame:
    """Count and sum of negative lines, by units and by revenue."""
    units, revenue = F.col("units_sold"), F.col("revenue_fcfa")
    return sales.agg(
        F.count_if(units < 0).alias("negative_unit_rows"),
        F.sum(F.when(units < 0, units)).alias("negative_units"),
        F.count_if(revenue < 0).alias("negative_revenue_rows"),
        F.sum(F.when(revenue < 0, revenue)).alias("negative_revenue_fcfa"),
    )


def missing_dates(df: DataFrame, column: str) -> DataFrame:
    """Days between the first and the last that have no row."""
    days = df.select(F.col(column).cast("date").alias("missing_day")).distinct()
    bounds = days.agg(F.min("missing_day").alias("a"), F.max("missing_day").alias("b"))
    every = bounds.select(F.explode(F.sequence("a", "b")).alias("missing_day"))
    return every.join(days, "missing_day", "left_anti")


def text_length_stats(comments: DataFrame) -> DataFrame:
    size = F.length("comment_text")
    return comments.agg(
        F.count("*").alias("total"),
        F.count_if(F.trim("comment_text") == "").alias("empty_comments"),
        F.min(size).alias("min_length"),
        F.avg(size).alias("avg_length"),
        F.max(size).alias("max_length"),
    )


def posts_per_platform(comments: DataFrame) -> DataFrame:
    return (
        comments.select("platform", "post_id")
        .distinct()
        .groupBy("platform")
        .agg(F.count("post_id").alias("distinct_posts"))
    )


def phone_length_profile(orders: DataFrame) -> DataFrame:
    """How many orders have a phone of each number of digits."""
    digits = F.length(F.regexp_replace("customer_phone", "[^0-9]", ""))
    return orders.groupBy(digits.alias("digit_count")).agg(F.count("*").alias("row_count"))
