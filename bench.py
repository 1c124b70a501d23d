"""Times the headline queries: one JSON line on stdout.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Each query is
built and run into the noop sink in a warm session; the figure is the best of BENCH_RUNS.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

HEADLINE = [
    "clean_campaigns", "clean_media_plan", "clean_pos_sales", "clean_comments",
    "clean_chat_orders", "pos_dimension", "sales_calendar", "order_items", "order_quality",
    "media_reconciliation", "classify_rules", "label_comments", "comments_enriched",
    "marketing_channel_monthly", "sales_monthly", "monthly_performance", "product_mix_monthly",
    "chat_orders_monthly", "chat_customers", "social_monthly", "budget_allocation",
    "channel_evidence", "channel_decision", "budget_recommendation", "field_accuracy",
    "sentiment_summary", "brief_points", "quality_report",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("signals-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Call-site capture costs a round trip to the JVM for every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from catalog.queries import QUERIES

    names = sys.argv[1:] or HEADLINE
    QUERIES["sales_monthly"](spark, base).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(base.rstrip("/")),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
