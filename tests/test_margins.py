"""Subtotals of reports: every level right on its own, one read of the facts."""

import re

import pytest

from tallyspark.functions.measures import Term, distinct, rate, rows
from tallyspark.operators.aggregate import Dimension, Report, Share, run
from tallyspark.plans.registry import MATRICES, QUERIES
from tests.data import transactions
from tests.test_oracle import FOLDER

OK = "status = 'Success'"


def _facts(spark):
    return transactions(
        spark, {"user_id": "A", "platform": "X", "city": "P"}, {"user_id": "A", "platform": "Y", "city": "P"},
        {"user_id": "B", "platform": "X", "city": None, "status": "Failed"}, {"user_id": "C", "platform": "X", "city": "Q"})


MEASURES = (rows("n"), distinct("users", "user_id"), rate("ok", OK))


def test_levels_have_their_own_distinct_counts_and_rates(spark):
    report = Report(("platform", "city"), MEASURES, margins=(("platform",), ("city",), ()), order=("platform", "city"))
    got = [tuple(r) for r in run(report, _facts(spark)).collect()]
    assert got == [
        ("X", None, False, False, 1, 1, 0.0), ("X", "P", False, False, 1, 1, 100.0), ("X", "Q", False, False, 1, 1, 100.0),
        ("X", None, False, True, 3, 3, 2 / 3 * 100), ("Y", "P", False, False, 1, 1, 100.0), ("Y", None, False, True, 1, 1, 100.0),
        (None, None, True, False, 1, 1, 0.0), (None, "P", True, False, 2, 1, 100.0), (None, "Q", True, False, 1, 1, 100.0),
        (None, None, True, True, 4, 3, 75.0)]


def test_null_groups_go_but_totals_stay(spark):
    report = Report(("city",), MEASURES, margins=((),), keep_null_keys=False, order=("city",))
    assert [tuple(r)[:4] for r in run(report, _facts(spark)).collect()] == [
        ("P", False, 2, 1), ("Q", False, 1, 1), (None, True, 4, 3)]


def test_borrowed_keys_and_shares_by_level(spark):
    users = spark.createDataFrame([("A", "VIP"), ("B", "New")], "user_id string, tier string")
    report = Report(("tier", "platform"), (rows("n"), distinct("users", "user_id")), margins=(("tier",), ()),
                    shares=(Share("pct", Term("rows"), places=None),), order=("tier", "platform"))
    got = [tuple(r) for r in run(report, _facts(spark), [Dimension(users, "user_id", "left")]).collect()]
    assert got == [
        (None, "X", False, False, 1, 1, 25.0), (None, None, False, True, 1, 1, 25.0),
        ("New", "X", False, False, 1, 1, 25.0), ("New", None, False, True, 1, 1, 25.0),
        ("VIP", "X", False, False, 1, 1, 25.0), ("VIP", "Y", False, False, 1, 1, 25.0), ("VIP", None, False, True, 2, 1, 50.0),
        (None, None, True, True, 4, 3, 100.0)]


def test_margins_without_detail_and_of_nothing(spark):
    report = Report(("platform", "city"), MEASURES, margins=((), ("platform",)), detail=False)
    assert run(report, _facts(spark)).count() == 3
    assert run(report, _facts(spark).limit(0)).count() == 0
    with pytest.raises(ValueError):
        run(Report(("platform",), MEASURES, margins=((),), fixed=("platform", ["X"], ("n",))), _facts(spark))


@pytest.mark.parametrize("name, most", [*((n, 1) for n in MATRICES), ("ed_18_findings", 2)])
def test_scans(spark, name, most):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert 1 <= len(re.findall(r"FileScan parquet .*?orders\.parquet", plan)) <= most
