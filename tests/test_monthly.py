"""Loads that are published whole, tables written month by month, and the whole monthly run."""

import os
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from signals.operators import increments
from signals.plans.pipeline import TableFolder, run_month
from signals.sources import derive, io
from signals.sources.schemas import SCHEMAS

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    made = {n: derive.BUILDERS[n](spark, BASE) for n in SCHEMAS}
    # The contract wants one prediction per comment, so near copies are left out here.
    made["social_comments"] = made["social_comments"].dropDuplicates(["comment_id"])
    return {n: io.stage(df) for n, df in made.items()}


def files(path):
    """Every data file below a path, by its partition."""
    found = {}
    for folder, _, names in os.walk(path):
        data = sorted(n for n in names if n.endswith(".parquet"))
        if data:
            found[os.path.basename(folder)] = data
    return found


def small(spark, name):
    row = {"string": "x", "int": 1, "double": 1.0, "date": date(2026, 1, 1), "timestamp": datetime(2026, 1, 1)}
    fields = SCHEMAS[name].fields
    return spark.createDataFrame([tuple(row[f.dataType.simpleString()] for f in fields)], SCHEMAS[name])


def test_a_load_that_fails_half_way_leaves_the_old_one(spark, tmp_path):
    out = str(tmp_path / "out")
    assert io.loaded(spark, out) is None
    good = {name: small(spark, name) for name in SCHEMAS}
    first = io.load_all(good, out, 1)
    broken = F.raise_error(F.lit("no such sheet")).cast("string")
    third = list(SCHEMAS)[2]
    bad = {n: df.union(df) for n, df in good.items()}
    bad[third] = bad[third].withColumn("pos_id", broken)
    with pytest.raises(Exception, match="no such sheet"):
        io.load_all({**bad, third: bad[third]}, out, 2)
    assert io.loaded(spark, out) == first
    tables = TableFolder(spark, out)
    assert all(tables(f"raw_{n}").count() == 1 for n in SCHEMAS)
    io.load_all({n: df.union(df) for n, df in good.items()}, out, 3)
    assert all(tables(f"raw_{n}").count() == 2 for n in SCHEMAS)


def test_not_built_is_not_broken(spark, tmp_path):
    assert io.available(spark, str(tmp_path / "nowhere")) is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        io.available(spark, str(tmp_path / "empty"))
    io.write_mart(spark.range(3), str(tmp_path / "mart"))
    io.write_mart(spark.range(2), str(tmp_path / "mart"))
    assert io.available(spark, str(tmp_path / "mart")).count() == 2


def test_read_source(spark, tmp_path):
    plan = small(spark, "media_plan").withColumn("invoiced_fcfa", F.lit(None).cast("double"))
    plan.write.parquet(str(tmp_path / "parquet"))
    plan.select(*reversed(plan.columns)).write.option("header", True).csv(str(tmp_path / "csv"))
    plan.write.json(str(tmp_path / "json"))
    expected = plan.collect()
    for kind in ("parquet", "csv", "json"):
        got = io.read_source(spark, "media_plan", str(tmp_path / kind), kind)
        assert got.select(*plan.columns).collect() == expected, kind
        assert dict(got.dtypes) == dict(plan.dtypes), kind


def test_export_comments(spark, tmp_path):
    one = small(spark, "social_comments")
    rows = one.union(one.withColumn("comment_id", F.lit("a")))
    io.export_comments(rows, str(tmp_path / "texts"))
    got = spark.read.parquet(str(tmp_path / "texts"))
    assert got.columns == io.EXPORT_COLUMNS and sorted(r.comment_id for r in got.collect()) == ["a", "x"]
    with pytest.raises(io.ContractError, match="not unique"):
        io.export_comments(rows.union(one), str(tmp_path / "again"))
    assert not (tmp_path / "again").exists()


def lines(spark, *rows):
    return spark.createDataFrame([(date(2026, m, d) if m else None, v) for m, d, v in rows], "day date, v int")


def test_changed_months(spark):
    month = F.col("day")
    first = lines(spark, (1, 5, 1), (1, 6, 2), (2, 1, 3), (0, 0, 4))
    digests = io.stage(increments.month_digests(first, month))
    assert increments.changes(digests, None).changed == ["2026-01", "2026-02", "none"]
    same = lines(spark, (0, 0, 4), (2, 1, 3), (1, 6, 2), (1, 5, 1)).repartition(3)
    assert not increments.changes(increments.month_digests(same, month), digests)
    for rows, changed, removed in [
        ([(1, 5, 1), (1, 6, 2), (2, 1, 3), (0, 0, 4), (3, 1, 1)], ["2026-03"], []),
        ([(1, 5, 2), (1, 6, 1), (2, 1, 3), (0, 0, 4)], ["2026-01"], []),
        ([(1, 5, 1), (1, 6, 2), (1, 6, 2), (2, 1, 3), (0, 0, 5)], ["2026-01", "none"], []),
        ([(1, 5, 1), (1, 6, 2), (0, 0, 4)], [], ["2026-02"]),
    ]:
        found = increments.changes(increments.month_digests(lines(spark, *rows), month), digests)
        assert (found.changed, found.removed) == (changed, removed)


def test_months_that_lose_their_rows(spark, tmp_path):
    path, month = str(tmp_path / "t"), F.col("day")
    whole = increments.Changes(["2026-01", "2026-02"], [])
    increments.write_changed(lines(spark, (1, 5, 1), (2, 1, 3)), path, month, whole)
    january = files(path)["for_month=2026-01"]
    increments.write_changed(lines(spark, (2, 1, 9)), path, month, increments.Changes(["2026-02"], []))
    assert files(path)["for_month=2026-01"] == january
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]
    increments.write_changed(lines(spark), path, month, increments.Changes(["2026-02"], []))
    assert [r.v for r in spark.read.parquet(path).collect()] == [1]
    increments.write_changed(lines(spark, (3, 1, 5)), path, month, increments.Changes(["2026-03"], ["2026-01"]))
    assert [r.v for r in spark.read.parquet(path).collect()] == [5]


FACTS = [
    "clean_pos_sales", "sales_daily", "sales_monthly", "product_mix_monthly", "clean_chat_orders", "order_items",
    "order_quality", "chat_orders_monthly", "clean_comments", "comments_enriched", "social_monthly",
]


def contents(spark, folder):
    return {
        name: sorted(map(str, TableFolder(spark, folder)(name).select(*columns).collect()))
        for name, columns in ((n, sorted(TableFolder(spark, folder)(n).columns)) for n in FACTS)
    }


def test_a_run_with_a_new_month_writes_only_that_month(spark, sources, tmp_path):
    folder = str(tmp_path / "month")
    older = dict(sources)
    older["pos_sales_daily"] = sources["pos_sales_daily"].where("sale_date < '1998-11-01'")
    report = run_month(spark, older, folder, run_id=1)
    failed = {r.check_name for r in report.collect() if not r.passed}
    assert "budget_total" not in failed and "mix_reconciles" not in failed
    assert "accepted_status" in failed
    before = {name: files(f"{folder}/{name}") for name in FACTS}

    newer = dict(sources)
    newer["pos_sales_daily"] = sources["pos_sales_daily"].where("sale_date < '1998-12-01'")
    run_month(spark, newer, folder, run_id=2)
    after = {name: files(f"{folder}/{name}") for name in FACTS}
    for name in FACTS:
        changed = {m for m in after[name] if after[name][m] != before[name].get(m)}
        sales = name in ("clean_pos_sales", "sales_daily", "sales_monthly", "product_mix_monthly")
        assert changed == ({"for_month=1998-11"} if sales else set()), name
        assert set(before[name]) <= set(after[name])

    # Tables written month by month hold what a run from nothing writes.
    fresh = str(tmp_path / "fresh")
    run_month(spark, newer, fresh, run_id=1)
    assert contents(spark, folder) == contents(spark, fresh)
