"""The report over tables written once: what it needs of them, and what it leaves on the disks."""

import glob
import time
from collections import Counter, defaultdict
from datetime import date

from catalog.queries import LARGE_TABLES, UNREAD, built, workspace
from signals.operators import quality
from signals.plans import marts
from signals.sources.io import SHUFFLE_CLEANUP, shuffles_dropped, stage, stage_union

BASE = "/root/testdata/sf0.001"


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def left_over(spark, before, wait=20):
    """Shuffle files that are still there after a while: they are dropped in the background."""
    until = time.time() + wait
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_shuffle_files_go_with_the_run(spark):
    numbers = spark.range(1000).selectExpr("id % 7 as k", "id as v")
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_dropped(spark):
        sums = stage(numbers.groupBy("k").sum("v"))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert not left_over(spark, before)
    assert rows(sums) == rows(numbers.groupBy("k").sum("v"))


def test_parts_are_written_one_by_one_and_read_as_one(spark):
    parts = [spark.range(n).selectExpr(f"'{n}' as name", "id % 2 as k").groupBy("name", "k").count() for n in range(6)]
    parts[2] = parts[2].select("count", "k", "name")
    before = shuffle_files(spark)
    got = stage_union(parts)
    assert got.columns == ["name", "k", "count"]
    assert rows(got) == Counter((str(n), k, (n + 1 - k) // 2) for n in range(6) for k in (0, 1) if k < n)
    assert not left_over(spark, before)
    # Nothing but the written rows is left to do.
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_the_written_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    ws = built(spark, BASE)
    assert not left_over(spark, before)
    # The daily sales have about a row a line; the lines are written already.
    assert "sales_daily" not in ws._built and set(LARGE_TABLES) < set(ws._built)
    assert all(not set(UNREAD[t]) & set(ws(t).columns) for t in UNREAD)


def test_the_report_is_that_of_the_whole_tables(spark):
    whole = quality.quality_report(workspace(spark, BASE))
    assert rows(quality.quality_report(built(spark, BASE))) == rows(whole)


def keyed(spark, lines):
    return spark.createDataFrame(lines, "pos_id string, pos_key string, sale_date date")


def test_entity_keys_need_only_doubtful_lines(spark):
    day = [date(2026, 1, d) for d in range(1, 10)]
    good = [("p1", "a", day[0]), ("p1", "a", day[3]), ("p2", "a", day[4]), ("p2", "a", day[8]), ("p3", "b", day[2])]
    assert quality.doubtful_sales(keyed(spark, good * 3)).count() == 0
    faults = [
        [("p4", "c", day[2]), ("p5", "c", day[2])],  # two ids on one day
        [("p4", "c", day[1]), ("p5", "c", day[0]), ("p5", "c", day[8]), ("p6", "c", day[8])],  # over the one between
        [("p4", "c", day[1]), ("p5", "c", day[0]), ("p5", "c", day[8])],  # overlapping, no day shared
        [("p3", "c", day[8])],  # an id of two stores
        [("p7", None, day[0]), ("p8", None, day[0])],
        [(None, "b", day[2]), (None, "d", day[2])],
        [("p4", "c", None), ("p5", "c", None), ("p6", "d", day[0]), ("p9", "d", None)],
        [("p4", "c", None), ("p5", "c", day[0])],
        [(None, None, None), (None, None, None)],
    ]
    for lines in [good, *(good + f * 2 for f in faults), good + [x for f in faults for x in f]]:
        sales = keyed(spark, lines)
        assert rows(quality.assert_entity_keys(quality.doubtful_sales(sales))) == rows(
            quality.assert_entity_keys(sales)
        ), lines


SUMS = ("units_sold", "revenue_fcfa", "gross_units", "gross_revenue_fcfa", "return_units", "return_revenue_fcfa")


def test_sales_monthly_counts_stores_without_shuffling_days(spark):
    days = [date(2026, 1, 5), date(2026, 1, 6), date(2026, 2, 1), None]
    keys = [("k1", "n1", "c1"), ("k1", "n2", "c1"), ("k2", "n3", None), (None, None, "c2")]
    lines = [
        (days[i % 4], *keys[(i * i + i // 5) % 4], *[None if (i + j) % 6 == 0 else float(i * j) for j in range(6)])
        for i in range(40)
    ]
    schema = "sale_date date, pos_key string, pos_name string, commune string, " + ", ".join(f"{c} double" for c in SUMS)
    calendar = spark.createDataFrame(
        [(date(2026, 1, 1), date(2026, 1, 1), True, False)],
        "sale_date date, month date, has_sales_data boolean, is_missing_sales_day boolean",
    )
    got = marts.sales_monthly(spark.createDataFrame(lines, schema), calendar)
    expected = defaultdict(list)
    for line in lines:
        expected[line[0] and line[0].replace(day=1)].append(line)

    def total(values):
        known = [v for v in values if v is not None]
        return sum(known) if known else None

    def different(values):
        return len(set(values) - {None})

    assert {
        r.month: (
            r.net_units_sold, r.net_revenue_fcfa, r.gross_units, r.gross_revenue_fcfa, r.return_units,
            r.return_revenue_fcfa, r.active_pos, r.active_pos_names, r.active_communes, r.observed_sales_days,
            r.calendar_days,
        )
        for r in got.collect()
    } == {
        m: (
            *[total(x[4 + j] for x in group) for j in range(6)],
            *[different(x[j] for x in group) for j in (1, 2, 3, 0)],
            1 if m == date(2026, 1, 1) else None,
        )
        for m, group in expected.items()
    }
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(sale_date" not in plan
