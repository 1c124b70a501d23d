"""Exact duplicates and repeated keys.

All of these aggregate before they shuffle: copies of one row collapse on the map side, so
a group of copies that holds a large part of the data costs one row per map task. No window
over a raw key is used, because it would put a hot key into a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of every set of fully identical rows (NULLs compare equal)."""
    return df.distinct()


def drop_exact_duplicates_flagged(df: DataFrame) -> DataFrame:
    """Same, with ``was_exact_duplicate`` telling whether copies were dropped."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return counted.withColumn("was_exact_duplicate", F.col("copies") > 1).drop("copies")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key and ``occurrences`` for the keys seen more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def rows_where_key_repeats(df: DataFrame, *keys: str) -> DataFrame:
    """Every row whose key occurs more than once (a NULL key part matches nothing)."""
    return df.join(repeated_keys(df, *keys).select(*keys), list(keys), "left_semi")


def flag_repeated_key(df: DataFrame, key: str, flag: str, weight: str | None = None) -> DataFrame:
    """Add ``flag``: does the key occur more than once? NULL keys form one group.

    ``weight`` names a column of row counts where ``df`` holds counted copies. Aggregate and join
    back instead of a window: the count is combined before the shuffle, and adaptive execution
    splits the row side of the join when one key is hot.
    """
    rows = F.count("*") if weight is None else F.sum(weight)
    counts = df.groupBy(key).agg((rows > 1).alias(flag))
    other = counts.withColumnRenamed(key, "_key")
    return df.join(other, df[key].eqNullSafe(other["_key"]), "left").drop("_key")
