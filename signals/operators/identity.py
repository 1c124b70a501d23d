"""Technical row ids for tables without a natural key.

An id is a digest of the whole row and the row's number among its exact copies. It depends on the
data alone: not on partitions, on the order of rows or on which task ran twice, so it may be used
as a join key and traced from run to run. Copies are counted and expanded again; nothing is
ranked by a window, and rows that only repeat cost one row a task until they are expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Copies expanded from one array.
RUN = 1 << 16
COPIES = "_copies"


def cell_text(column: str, kind: T.DataType) -> Column:
    """Text of a value, distinct for distinct values of its type; NULL stays NULL."""
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # Plain decimals where they are exact, whatever the size of the number.
        plain = value.try_cast("decimal(38,6)")
        exact = plain.try_cast("double") == value
        return F.when(exact, plain.cast("string")).otherwise(value.cast("string"))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(value))
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    return value.cast("string")


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """MD5 of all cells, each with its length, so that no two rows share a text."""
    cells = []
    for field in df.schema.fields:
        if columns is None or field.name in columns:
            text = cell_text(field.name, field.dataType)
            known = F.concat(F.length(text).cast("string"), F.lit(":"), text)
            cells.append(F.coalesce(known, F.lit("null")))
    return F.md5(F.concat_ws(",", *cells))


def counted_copies(df: DataFrame) -> DataFrame:
    """Distinct rows and how often each occurs (`_copies`)."""
    return df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count("*").alias(COPIES))


def expanded(counted: DataFrame, copy: str) -> DataFrame:
    """Every copy as a row of its own, numbered from 1 in `copy`."""
    runs = counted.withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(COPIES) - 1) / RUN)))
    )
    first = F.col("_run") * RUN + 1
    last = F.least(first + RUN - 1, F.col(COPIES))
    return runs.withColumn(copy, F.explode(F.sequence(first, last))).drop("_run", COPIES)


def numbered(counted: DataFrame, digest: str, name: str) -> DataFrame:
    """`counted` expanded, with id `name` from the column `digest`, which goes."""
    rows = expanded(counted, "_copy")
    row_id = F.concat_ws("-", digest, F.col("_copy").cast("string"))
    return rows.withColumn(name, row_id).drop("_copy", digest)


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """`df` with a unique, reproducible id per row."""
    counted = counted_copies(df)
    return numbered(counted.withColumn("_digest", row_digest(df)), "_digest", name)
