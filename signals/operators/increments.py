"""Rebuilding only the months that changed.

A month of a table is told by an order-free digest of its rows, kept beside the table. Months are
compared with those of the run before; only changed ones are built and written again, each as a
partition of its own, and partitions of other months keep their files. Months are as many as the
calendar has, so their list may come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.sources.io import available, stage

#: Partition column of tables kept by month: YYYY-MM, or `none` for rows without a month.
PART = "for_month"


def part_of(month: Column) -> Column:
    return F.coalesce(F.date_format(month, "yyyy-MM"), F.lit("none"))


def month_digests(df: DataFrame, month: Column) -> DataFrame:
    """for_month, row_count and two order-free digests of the rows of each month."""
    row = [F.col(f"`{c}`") for c in df.columns]
    return df.groupBy(part_of(month).alias(PART)).agg(
        F.count("*").alias("row_count"),
        F.sum(F.xxhash64(*row).cast("decimal(38,0)")).alias("digest_sum"),
        F.bit_xor(F.xxhash64(F.lit(1), *row)).alias("digest_xor"),
    )


@dataclass(frozen=True)
class Changes:
    """Months to write again and months that are gone."""

    changed: list[str]
    removed: list[str]

    def __bool__(self) -> bool:
        return bool(self.changed or self.removed)

    def rows(self, df: DataFrame, month: Column) -> DataFrame:
        return df.where(part_of(month).isin(self.changed))

    def dates(self) -> list[date]:
        return [date.fromisoformat(f"{m}-01") for m in self.changed if m != "none"]


def changes(now: DataFrame, before: DataFrame | None) -> Changes:
    if before is None:
        return Changes(sorted(r[0] for r in now.select(PART).collect()), [])
    found = ["row_count", "digest_sum", "digest_xor"]
    old = before.select(PART, F.struct(found).alias("old"))
    rows = (
        now.select(PART, F.struct(found).alias("new"))
        .join(old, PART, "full")
        .where(~F.col("new").eqNullSafe(F.col("old")))
        .select(PART, F.col("new").isNull().alias("gone"))
        .collect()
    )
    return Changes(
        sorted(r[PART] for r in rows if not r.gone), sorted(r[PART] for r in rows if r.gone)
    )


def write_months(df: DataFrame, path: str, month: Column) -> None:
    """Replace the partitions of the months `df` holds; others stay untouched."""
    (
        df.withColumn(PART, part_of(month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PART)
        .parquet(path)
    )


def write_whole(df: DataFrame, path: str, month: Column) -> None:
    (
        df.withColumn(PART, part_of(month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PART)
        .parquet(path)
    )


def write_changed(df: DataFrame, path: str, month: Column, todo: Changes) -> None:
    """Write the changed months of `df`.

    Where a month is gone, `df` is the whole table and written as such. A changed month that has
    no rows in `df` any more would keep its old partition, so the table is then written whole, from
    its other months and `df`.
    """
    if todo.removed:
        write_whole(df, path, month)
        return
    fresh = stage(todo.rows(df, month))
    held = available(df.sparkSession, path)
    if held is not None:
        filled = {r[0] for r in fresh.select(part_of(month)).distinct().collect()}
        emptied = [m for m in todo.changed if m not in filled]
        if not held.where(F.col(PART).isin(emptied)).isEmpty():
            others = stage(held.where(~F.col(PART).isin(todo.changed)).drop(PART))
            write_whole(others.unionByName(fresh), path, month)
            return
    write_months(fresh, path, month)
