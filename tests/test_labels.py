"""Every annotated line is evaluated, by the registered check SQL."""

import pytest
from oracle_check import connect, differences

from catalog.queries import QUERIES
from oracle.build import query
from oracle.queries import ORACLE
from signals.sources import derive

BASE = "/root/testdata/sf0.001"
ON_ALL = (
    "prediction_vs_human", "field_accuracy", "class_report", "exact_agreement", "field_errors", "error_rows",
    "unmatched_labels", "label_normalise", "constant_baseline", "conform_labels",
)


@pytest.fixture(scope="module")
def duck():
    return connect(BASE)


def test_labels_hold_every_line(spark, duck):
    assert differences(derive.human_labels(spark, BASE), duck, query("SELECT * FROM r_human")) is None
    both = query("SELECT * FROM r_human_first UNION ALL SELECT * FROM r_human_next")
    assert differences(derive.human_labels(spark, BASE), duck, both) is None


@pytest.mark.parametrize("name", ON_ALL)
def test_evaluation_of_every_line(spark, duck, name):
    assert differences(QUERIES[name](spark, BASE), duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["merge_refusals", "merge_validated"])
def test_drafts_are_merged_from_two_batches(spark, duck, name):
    assert differences(QUERIES[name](spark, BASE), duck, ORACLE[name]) is None
