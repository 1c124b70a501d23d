"""Checks find planted faults, and one-to-one joins refuse repeated rows."""

from collections import Counter

import pytest

from catalog.queries import QUERIES
from signals.operators import evaluation, quality
from signals.sources import faults

BASE = "/root/testdata/sf0.001"
PLANTED = [
    "id_name_conflicts", "name_id_conflicts", "assert_multiplier", "assert_entity_keys", "assert_calendar_bounds",
    "assert_calendar_flags", "assert_mix_reconciles", "assert_chat_amounts", "assert_budget_total",
    "assert_decided_channels",
]


@pytest.mark.parametrize("name", PLANTED)
def test_planted_faults_are_found(spark, name):
    assert QUERIES[name](spark, BASE).count() > 0


def test_the_report_names_the_damaged_tables(spark):
    from catalog.queries import built

    ws = built(spark, BASE)
    relations = quality.relation_checks(ws), quality.relation_checks(faults.damaged(ws))
    good, bad = ({k: df.count() for k, df in found.items()} for found in relations)
    assert not any(good.values())
    assert {k for k, n in bad.items() if n} == {
        ("calendar_bounds", "sales_calendar"), ("calendar_flags", "sales_calendar"),
        ("mix_reconciles", "product_mix_monthly"), ("amounts_reconcile", "chat_orders_monthly"),
        ("budget_total", "budget_recommendation"), ("decided_channels", "budget_recommendation"),
    }


def test_row_and_key_checks_in_one_pass(spark):
    rows = [("a", 1), ("a", -1), ("b", None), (None, -2), (None, 3), ("c", 5), ("c", -7), ("c", 1)]
    df = spark.createDataFrame(rows, "k string, v int")
    rules = {"negative": "v < 0", "missing": "v is null"}
    got = quality.count_all_violations(df, "t", rules, "k")
    assert Counter({r.check_name: r.violations for r in got.collect()}) == {
        "negative": 3, "missing": 1, "unique_k": 2,
    }
    assert dict(got.dtypes) == dict(quality.count_violations(df, "t", rules).dtypes)
    empty = quality.count_all_violations(df.limit(0), "t", rules, "k").collect()
    assert {r.violations for r in empty} == {0} and len(empty) == 3


def labels(spark, suffix, *ids):
    names = [f"{f}_{suffix}" for f in evaluation.FIELDS]
    rows = [(i, "text", "fr", "neutral", "other", "none", "false") for i in ids]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["comment_id", "comment_text", *names]))


def test_evaluation_refuses_repeated_rows(spark):
    human, model = labels(spark, "human", "a", "b"), labels(spark, "model", "b", "c")
    assert [r.comment_id for r in evaluation.prediction_vs_human(human, model).collect()] == ["b"]
    for left, right, message in [
        (labels(spark, "human", "a", "a", "b"), model, "human labels: rows are not unique: a"),
        (human, labels(spark, "model", "b", "c", "c"), "predictions: rows are not unique: c"),
    ]:
        compared = evaluation.prediction_vs_human(left, right)
        with pytest.raises(Exception, match=message):
            compared.collect()
        with pytest.raises(Exception, match=message):
            evaluation.exact_agreement(compared).collect()
        with pytest.raises(Exception, match=message):
            compared.count()


def test_the_guard_shuffles_no_more_than_the_join(spark):
    human, model = labels(spark, "human", "a"), labels(spark, "model", "a")
    plan = evaluation.prediction_vs_human(human, model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(comment_id") == 2
