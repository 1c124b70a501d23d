from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column_values(spark):
    """Values of a function of a text column over the given texts."""

    def run(texts, expression):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
        return [r.v for r in df.select("i", expression(df.x).alias("v")).orderBy("i").collect()]

    return run
