"""Technical row ids: unique, and the same whatever the layout of the input."""

import datetime

from pyspark.sql import functions as F

from signals.operators import cleaning, identity, items, quality
from signals.sources.schemas import SCHEMAS

ROWS = [
    ("R1", "2026-01-05", "0548687257", "2 bissap 1L et 1 bouye", 3000.0, "z", "livré"),
    ("R1", "2026-01-05", "0548687257", "2 bissap 1L et 1 bouye", 3000.0, "z", "livré"),
    ("R1", "2026-01-05", "0548687257", "2 bissap 1L et 1 bouye", None, "z", "livré"),
    ("R2", None, None, "gingembre 33cl", 1.5e9, None, None),
    (None, None, None, None, None, None, None),
    (None, None, None, None, None, None, None),
    ("R3", "", "", "", 0.1, "", ""),
]


def orders(spark, parts, rows=ROWS):
    raw = spark.createDataFrame(rows, SCHEMAS["whatsapp_orders"]).repartition(parts)
    return cleaning.clean_chat_orders(raw)


def test_ids_do_not_depend_on_partitions_or_order(spark):
    one = {tuple(r) for r in orders(spark, 1).collect()}
    many = {tuple(r) for r in orders(spark, 7, ROWS[::-1]).collect()}
    assert one == many and len(one) == len(ROWS)


def test_ids_follow_lines_and_order_quality(spark):
    made = orders(spark, 3)
    lines, checked = items.order_items(made), items.order_quality(made)
    known = {r.row_id: r for r in made.collect()}
    assert len(known) == len(ROWS)
    assert all(known[r.row_id].items_text == r.items_text for r in lines.collect())
    per_order = dict(lines.groupBy("row_id").count().collect())
    assert per_order == {r.row_id: r.item_line_count for r in checked.collect()}


def test_flag_of_repeated_references_counts_copies(spark):
    got = {(r.order_ref, r.order_ref_repeated) for r in orders(spark, 2).collect()}
    assert got == {("R1", True), ("R2", False), (None, True), ("R3", False)}


def test_cells_that_look_alike_differ(spark):
    rows = [("a", "b"), ("ab", ""), ("a,1:b", ""), ("", "ab"), (None, "null"), ("null", None), ("", None), (None, "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(identity.row_digest(df)).distinct().count() == len(rows)


def test_numbers_and_other_types(spark):
    rows = [
        (v, 1, True, datetime.date(2026, 1, 1), datetime.datetime(2026, 1, 1), [1], b"x")
        for v in (0.1, 0.1 + 1e-12, 1e7, 1e7 + 1e-9, 1e300, -1e300, float("nan"), float("inf"), None)
    ]
    df = spark.createDataFrame(
        rows, "d double, i int, b boolean, day date, t timestamp, a array<int>, raw binary"
    )
    assert df.select(identity.row_digest(df)).distinct().count() == len(set(map(str, rows)))


def test_many_copies_are_expanded_in_runs(spark, monkeypatch):
    monkeypatch.setattr(identity, "RUN", 10)
    rows = [("same",)] * 95 + [("other",)] + [(str(i),) for i in range(10)]
    made = identity.with_row_ids(spark.createDataFrame(rows, "x string"))
    assert made.columns == ["x", "row_id"]
    assert made.count() == made.select("row_id").distinct().count() == len(rows)
    copies = made.where("x = 'same'").select(F.split_part("row_id", F.lit("-"), F.lit(2)).cast("int"))
    assert sorted(r[0] for r in copies.collect()) == list(range(1, 96))


def test_data_tests_on_row_ids(spark):
    """The not-null and unique tests of the order tables, on good and on damaged rows."""
    checked = items.order_quality(orders(spark, 2))
    assert quality.assert_unique(checked, "row_id").isEmpty()
    assert quality.assert_unique(checked.union(checked.limit(1)), "row_id").count() == 1
    for table, df in (
        ("clean_chat_orders", orders(spark, 2)),
        ("order_items", items.order_items(orders(spark, 2))),
        ("order_quality", checked),
    ):
        rule = quality.row_checks()[table]["not_null_row_id"]
        assert quality.violating_rows(df, rule).isEmpty()
        lost = df.withColumn("row_id", F.lit(None).cast("string"))
        assert quality.violating_rows(lost, rule).count() == df.count()
