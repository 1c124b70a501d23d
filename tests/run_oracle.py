"""Compare registered queries with their check SQL: python tests/run_oracle.py [sf] [name...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_check import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from catalog.queries import QUERIES  # noqa: E402
from oracle.queries import ORACLE  # noqa: E402


def main(sf: str = "sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = f"/root/testdata/{sf}"
    con, bad = connect(base), 0
    for name in names or QUERIES:
        if name not in ORACLE:
            print(name, "no check SQL", flush=True)
            continue
        start = time.time()
        try:
            found = differences(QUERIES[name](spark, base), con, ORACLE[name])
        except Exception as error:  # keep going, report all
            found = f"{type(error).__name__}: {str(error)[:600]}"
        took = round(time.time() - start, 1)
        if found:
            bad += 1
            print(f"{name}: {found} [{took}s]", flush=True)
        elif took > 8:
            print(f"{name}: ok [{took}s]", flush=True)
    print(f"{len(names or QUERIES)} queries, {bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
