from datetime import date

import pytest

from signals.functions import labels
from signals.operators import filters, quality, trends
from signals.params import Params
from signals.plans import marts, metrics
from signals.plans.metrics import Intent
from signals.sources import derive, io
from signals.sources.schemas import SCHEMAS

BASE = "/root/testdata/sf0.001"


def monthly(spark, values):
    rows = [(date(2026, i + 1, 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "month date, value double")


def test_monthly_trend(spark):
    row = trends.monthly_trend(monthly(spark, [10.0, 5.0, 12.0]), "value").first()
    assert row.change == pytest.approx(0.2)
    assert (row.trend, row.recent_trend, row.total_value) == ("up", "up", 27.0)
    assert (row.best_month.month, row.worst_month.month) == (3, 2)
    short = trends.monthly_trend(monthly(spark, [10.0, 10.05]), "value").first()
    assert (short.trend, short.recent_change) == ("stable", None)
    assert trends.monthly_trend(monthly(spark, []), "value").count() == 0


def test_breakdown_and_ranking(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 6.0), ("C", 3.0), ("D", 1.0)],
                               "channel string, value double")
    got = {r.category: (r.place, r.share) for r in
           trends.category_breakdown(df, "channel", "value").collect()}
    assert got["B"] == ("first", pytest.approx(6 / 11)) and got["C"][0] == "second"
    assert (got["A"][0], got["D"][0]) == (None, "last")
    low = trends.ranking(df, "channel", "value", lowest=True).collect()
    assert [r.category for r in low] == ["A", "D", "C"]


def test_compare_members_tie(spark):
    rows = [(date(2026, m, 1), c, v) for m, c, v in
            [(1, "A", 3.0), (1, "B", 1.0), (2, "A", 1.0), (2, "B", 3.0)]]
    df = spark.createDataFrame(rows, "month date, channel string, value double")
    row = trends.compare_members(df, "channel", "value").first()
    assert (row.is_tie, row.gap, row.months_ahead, row.months_compared) == (True, 0.0, 1, 2)


def decision(spark, shares):
    rows = [(c, s, g) for c, s, g in shares]
    df = spark.createDataFrame(
        rows, "channel string, observed_spend_share double, evidence_quality string"
    )
    return df.selectExpr(
        "*", *[f"cast(null as double) as {c}" for c in
               ("campaign_spend_fcfa", "planned_budget_fcfa", "invoiced_fcfa", "spend_share",
                "planned_share", "spend_vs_plan_ratio", "impressions", "clicks", "cpc_fcfa",
                "cpm_fcfa", "data_quality_status", "measurement_profile")],
    )


@pytest.mark.parametrize("shares", [
    [("A", 0.4, "high"), ("B", 0.4, "high"), ("C", 0.2, "limited")],
    [("A", 0.0, "high"), ("B", 0.0, "medium"), ("C", None, "limited")],
])
def test_computed_budget_always_sums_to_total(spark, shares):
    params = Params(decided_budget={})
    got = marts.budget_recommendation(decision(spark, shares), params)
    assert sum(r.proposed_budget_fcfa for r in got.collect()) == params.total_test_budget
    assert quality.assert_budget_total(got, params).count() == 0


def test_partial_or_misspelled_decision_is_caught(spark):
    params = Params(decided_budget={"A": 1e6, "Tiktok": 2e6})
    shares = [("A", 0.5, "high"), ("TikTok", 0.5, "high")]
    got = marts.budget_recommendation(decision(spark, shares), params)
    assert quality.assert_budget_total(got, params).count() == 1
    missing = quality.assert_decided_channels(got, params).collect()
    assert [r.channel for r in missing] == ["Tiktok"]


def test_evidence_month_ranks(spark):
    rows = [(date(2026, m, 1), c, float(m)) for m in range(1, 8) for c in ("A", "B")
            if (m, c) != (7, "B")]
    df = spark.createDataFrame(rows, "month date, channel string, campaign_spend_fcfa double")
    zeros = ("planned_budget_fcfa", "invoiced_fcfa", "campaign_rows", "campaign_count",
             "campaigns_without_product", "product_parse_failure_count",
             "month_parse_failure_count")
    df = df.selectExpr("*", *[f"0L as {z}" for z in zeros], "1L as impressions",
                       "cast(null as bigint) as clicks")
    got = {r.channel: r for r in marts.channel_evidence(df).collect()}
    assert got["A"].latest_month_spend_fcfa == 7.0 and got["B"].latest_month_spend_fcfa is None
    assert (got["A"].recent_3m_spend_fcfa, got["A"].earlier_3m_spend_fcfa) == (18.0, 9.0)
    assert got["B"].recent_3m_spend_fcfa == 11.0
    assert (got["A"].period_coverage, got["B"].period_coverage) == ("full_period", "partial_period")
    assert got["A"].data_quality_status == "limited"


def test_metric_query_refuses_what_is_not_declared():
    def no_tables(name):
        raise AssertionError("must fail before reading a table")

    with pytest.raises(ValueError, match="unknown metric"):
        metrics.metric_query(no_tables, Intent("profit"))
    with pytest.raises(ValueError, match="not a dimension"):
        metrics.metric_query(no_tables, Intent("net_revenue", ("channel",)))
    with pytest.raises(ValueError, match="YYYY-MM"):
        filters.as_month("DROP TABLE")
    with pytest.raises(ValueError, match="unknown value"):
        filters.resolve_members("print", labels.CHANNEL_ALIASES)


def test_metric_results_come_in_order(spark):
    rows = [(date(2026, m, 1), c, float(m)) for m in (3, 1, 2) for c in ("Radio", "Meta")]
    table = spark.createDataFrame(rows, "month date, channel string, campaign_spend_fcfa double").repartition(3)
    made = metrics.metric_query(lambda _: table, Intent("spend", ("month", "channel"))).collect()
    assert [(r.month.month, r.channel) for r in made] == [(m, c) for m in (1, 2, 3) for c in ("Meta", "Radio")]


def test_relative_months_must_be_positive(spark):
    table = monthly(spark, [1.0]).withColumnRenamed("value", "net_revenue_fcfa")
    with pytest.raises(ValueError, match="positive"):
        metrics.metric_query(lambda _: table, Intent("net_revenue", relative_months=0))
    wide = metrics.metric_query(lambda _: table, Intent("net_revenue", relative_months=24))
    assert wide.first().net_revenue == 1.0


def test_contracts_name_the_culprit_and_write_nothing(spark, tmp_path):
    good = {n: derive.BUILDERS[n](spark, BASE) for n in SCHEMAS}
    for broken, message in [
        ({**good, "media_plan": good["media_plan"].drop("owner")}, "media_plan.*owner"),
        ({**good, "media_plan": good["media_plan"].limit(0)}, "media_plan.*empty"),
        ({k: v for k, v in good.items() if k != "media_plan"}, "media_plan.*missing"),
    ]:
        with pytest.raises(io.ContractError, match=message):
            io.load_all(broken, str(tmp_path / "out"))
        assert not (tmp_path / "out").exists()


def test_prediction_contract(spark):
    schema = ("comment_id string, language_model string, sentiment_model string, theme_model "
              "string, product_model string, is_spam_model boolean, model_used boolean, "
              "rules_complete boolean")  # fmt: skip
    row = ("a", "fr", "neutral", "other", "none", False, False, True)
    assert io.check_predictions(spark.createDataFrame([row], schema)).count() == 1
    with pytest.raises(io.ContractError, match="repeated"):
        io.check_predictions(spark.createDataFrame([row, row], schema))
    hole = ("b", None, *row[2:])
    with pytest.raises(io.ContractError, match="language_model"):
        io.check_predictions(spark.createDataFrame([hole], schema))


def test_checks_fail_when_they_should(spark):
    rules = quality.row_checks()["clean_pos_sales"]
    bad = spark.createDataFrame(
        [(None, "p", "c", "r", "s", 1, 5.0, 4.0, -1, 1, 5.0, 0.0)],
        "sale_date date, pos_id string, commune string, channel string, product_sku string, "
        "units_sold int, revenue_fcfa double, net_revenue_fcfa double, gross_units int, "
        "return_units int, gross_revenue_fcfa double, return_revenue_fcfa double",
    )
    got = {r.check_name for r in quality.count_violations(bad, "t", rules).collect() if r.violations}
    assert got == {"not_null_sale_date", "non_negative_gross_units", "non_positive_return_units",
                   "identity_net"}
