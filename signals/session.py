"""Session settings the library relies on or gains from; all can be set at run time."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Months and days are cut in one zone whatever the machine's.
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles a method above 8000 bytes of bytecode, so a wide stage fused
    # into one method runs interpreted. Above this size Spark splits the expressions instead;
    # the comment rules run about three times as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
