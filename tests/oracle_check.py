"""Run a registered query on Spark and its check query on DuckDB, and compare them whole."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp",
}


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{base}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        # Exact but for the last digits, where the order of a sum may show.
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, list):
        return tuple(value)
    return value


def differences(df, con, sql: str) -> str | None:
    """None when names, types and rows agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    spark_types = dict(df.dtypes)
    wrong = {n: (spark_types[n], types[n]) for n in names if types[n] != spark_types[n]}
    if wrong:
        return f"types (spark, duckdb) {wrong}"
    order = sorted(names)
    at = {n: i for i, n in enumerate(names)}
    expected = Counter(tuple(_cell(r[at[n]]) for n in order) for r in result.fetchall())
    actual = Counter(tuple(_cell(r[n]) for n in order) for r in df.collect())
    if actual != expected:
        only_spark = list((actual - expected).elements())
        only_duck = list((expected - actual).elements())
        return (
            f"{len(only_spark)}/{sum(actual.values())} rows only in spark, "
            f"{len(only_duck)}/{sum(expected.values())} only in duckdb; {order}\n"
            f"  spark:  {only_spark[:2]}\n  duckdb: {only_duck[:2]}"
        )
    return None
