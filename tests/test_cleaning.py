from datetime import date

from pyspark.sql import functions as F

from signals.operators import cleaning, conform, dedupe, items
from signals.params import Params
from signals.sources.schemas import SCHEMAS


def orders(spark, texts, amount=None):
    rows = [(f"R{i}", "2026-01-05", "0548687257", t, amount, "z", "livré")
            for i, t in enumerate(texts)]
    return cleaning.clean_chat_orders(spark.createDataFrame(rows, SCHEMAS["whatsapp_orders"]))


def test_exact_duplicates(spark):
    rows = [("a", None), ("a", None), ("a", 1), ("b", 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    assert dedupe.drop_exact_duplicates(df).count() == 3
    flagged = dedupe.drop_exact_duplicates_flagged(df).orderBy("k", "v").collect()
    assert [r.was_exact_duplicate for r in flagged] == [True, False, False]
    assert {r.v for r in dedupe.rows_where_key_repeats(df, "k").collect()} == {None, 1}
    repeated = {r.k: r.r for r in dedupe.flag_repeated_key(df, "k", "r").collect()}
    assert repeated == {"a": True, "b": False}


def test_repeated_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "k string")
    flags = [(r.k, r.r) for r in dedupe.flag_repeated_key(df, "k", "r").collect()]
    assert sorted(flags, key=str) == [("x", False), (None, True), (None, True)]


def test_hot_key_stays_whole(spark):
    rows = [("hot" if i % 3 == 0 else f"k{i}",) for i in range(900)]
    df = spark.createDataFrame(rows, "k string")
    flagged = dedupe.flag_repeated_key(df, "k", "r")
    assert flagged.count() == 900
    assert flagged.where("r").count() == 300


def test_pos_returns(spark):
    rows = [(date(2026, 1, 1), "P1", "Kiosque É", " COCODY", "Retail", "BIS-1L", u, r)
            for u, r in [(2, 10.0), (-1, -5.0), (0, 0.0), (None, None)]]
    df = cleaning.clean_pos_sales(spark.createDataFrame(rows, SCHEMAS["pos_sales_daily"]))
    got = [(r.is_return, r.gross_units, r.return_units, r.gross_revenue_fcfa,
            r.return_revenue_fcfa, r.net_revenue_fcfa, r.commune) for r in df.collect()]
    assert got == [
        (False, 2, 0, 10.0, 0.0, 10.0, "Cocody"),
        (True, 0, -1, 0.0, -5.0, -5.0, "Cocody"),
        (False, 0, 0, 0.0, 0.0, 0.0, "Cocody"),
        (None, 0, 0, 0.0, 0.0, 0.0, "Cocody"),
    ]


def test_media_plan_missing_invoice(spark):
    rows = [("p", "mai 2026", "fb/ig", 100.0, None, "", " ", None),
            ("q", "juin 2026", "Radio", 100.0, 90.0, "x", "o", "n")]
    df = cleaning.clean_media_plan(spark.createDataFrame(rows, SCHEMAS["media_plan"]))
    a, b = df.orderBy("plan_id").collect()
    assert (a.variance_fcfa, a.invoiced_available, a.objective, a.owner) == (None, 0, None, None)
    assert (b.variance_fcfa, b.invoiced_available, b.channel) == (-10.0, 1, "Radio")


def test_campaign_attributes(spark):
    names = ["Bissap - janvier", "GAMME maison", "bouye juil26", "innovation", "Gingembre fév26",
             "promo mar26", "Bissap DEC"]
    rows = [("meta", n, "2026-03-04", "x", "10", 1, 1, "conv") for n in names]
    rows.append(("meta", "Bissap mai", "n/a", "x", "10", 1, 1, "conv"))
    raw = spark.createDataFrame(rows, SCHEMAS["campaign_spend_export"])
    got = {r.campaign_name: r for r in
           cleaning.campaign_attributes(cleaning.clean_campaigns(raw)).collect()}
    months = {n: got[n].campaign_month and got[n].campaign_month.month for n in names}
    assert months == {
        "Bissap - janvier": 1, "GAMME maison": 5, "bouye juil26": 7, "innovation": None,
        "Gingembre fév26": None, "promo mar26": 3, "Bissap DEC": 12,
    }
    assert got["Bissap mai"].campaign_month is None
    assert got["Gingembre fév26"].product == "gingembre"
    assert got["innovation"].product_parse_failed


def test_order_items(spark):
    texts = ["2 bissap 1L + 1 gingembre 33cl", "6x BIS-1L", "6 x bis-1l et bouye", None, "  ",
             "commande habituelle x3", "1 bissap (bien frais) 33 cl"]
    got = items.order_items(orders(spark, texts))
    lines = [(r.order_ref, r.product, r.format, r.quantity, r.parse_status) for r in
             got.orderBy("order_ref", "segment").collect()]
    assert lines == [
        ("R0", "gingembre", "33cl", 1, "parsed"),
        ("R0", "bissap", "1L", 2, "parsed"),
        ("R1", "bissap", "1L", 6, "parsed"),
        ("R2", "bissap", "1L", 6, "parsed"),
        ("R2", "bouye", None, 1, "missing_format"),
        ("R5", None, None, 3, "unknown_product"),
        ("R6", "bissap", "33cl", 1, "parsed"),
    ]


def test_order_quality(spark):
    texts = ["2 bissap 1L", "2 bissap 1L + truc", "bissap", "bissap + truc", "bissap 1L + bouye"]
    got = items.order_quality(orders(spark, texts, 200000.0), Params()).orderBy("order_ref")
    assert [r.order_parse_status for r in got.collect()] == [
        "fully_parsed", "partially_parsed", "missing_format_only", "unresolved", "unresolved",
    ]
    first = got.first()
    assert first.amount_outlier and first.amount_plausible_fcfa is None
    assert (first.quantity_total, first.bissap_units, first.format_1l_units) == (2, 2, 2)


def test_calendar_and_stores(spark):
    rows = [(date(2026, 1, 30), "P1", "Le Kiosque"), (date(2026, 2, 2), "P9", "LE  KIOSQUE"),
            (date(2026, 2, 2), "P2", "Le Kiosque 2")]
    rows = [(d, i, n, "Cocody", "retail", "BIS-1L", 1, 1.0) for d, i, n in rows]
    sales = cleaning.clean_pos_sales(spark.createDataFrame(rows, SCHEMAS["pos_sales_daily"]))
    calendar = conform.sales_calendar(sales)
    assert calendar.count() == 31 + 28
    assert calendar.where("has_sales_data").count() == 2
    store = conform.pos_dimension(sales).where("pos_key = 'le kiosque'").first()
    assert (store.pos_ids, store.pos_id_changed, store.canonical_pos_id) == (["P1", "P9"], True, "P1")


def test_source_coverage(spark):
    spend = spark.createDataFrame([(date(2026, 1, 1), c, 10.0, 1, 1, 1) for c in "ABE"],
        "month date, channel string, campaign_spend_fcfa double, campaign_rows int, "
        "impressions int, clicks int")  # fmt: skip
    plan = spark.createDataFrame(
        [(date(2026, 1, 1), c, 10.0, v) for c, v in
         [("A", 5.0), ("B", None), ("C", 5.0), ("D", None), ("F", 0.0)]],
        "month date, channel string, planned_budget_fcfa double, invoiced_fcfa double",
    ).selectExpr("*", "0 as invoiced_rows", "1 as media_plan_rows")
    got = {r.channel: r for r in conform.media_reconciliation(spend, plan).collect()}
    assert {c: r.source_coverage for c, r in got.items()} == {
        "A": "both_available", "B": "both_sources_invoice_missing", "C": "media_plan_only",
        "D": "media_plan_only_invoice_missing", "E": "campaign_only", "F": "media_plan_only",
    }
    assert got["A"].campaign_to_invoiced_ratio == 2.0
    assert got["B"].campaign_vs_invoiced_variance_fcfa is None
