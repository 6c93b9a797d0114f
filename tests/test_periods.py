"""Period measures in a filter context, and how often their plans read the facts."""

import re
from datetime import datetime

import pytest

from tallyspark.functions import derive
from tallyspark.operators import star, timeintel
from tallyspark.plans import semantic
from tallyspark.plans.registry import PERIOD_VISUALS, QUERIES
from tests.data import profiles, transactions
from tests.test_oracle import FOLDER


def _at(y, m, d, amount="100", **kw):
    return {"transaction_datetime": datetime(y, m, d, 12), "amount": amount, **kw}


def _star(spark, *rows, users=({},)):
    return star.build_star(derive.add_row_features(transactions(spark, *rows)), profiles(spark, *users))


def _rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_a_slicer_on_march_still_sees_february(spark):
    tables = _star(spark, _at(2024, 2, 10, "30"), _at(2024, 3, 5, "60"), _at(2024, 3, 6, "5", payment_method="Card"),
                   _at(2024, 2, 1, "7", payment_method="Card"), _at(2023, 12, 1, "1"), _at(2024, 1, 1, "9"))
    out = semantic.visual_query(
        tables, ("dim_date.month_year",), ("total_revenue", "revenue_pm", "revenue_mom_growth_pct", "revenue_ytd",
                                           "cumulative_revenue", "transactions_pm"),
        {"dim_date.month_year": ["Mar 2024"], "dim_payment_method.payment_method": ["UPI"]}).collect()
    assert [tuple(r) for r in out] == [("Mar 2024", 60.0, 30.0, 100.0, 99.0, 100.0, 1)]


def test_whole_months_move_whole_and_parts_move_day_by_day(spark):
    tables = _star(spark, *[_at(2024, 1, d, "1") for d in (27, 28, 29, 30, 31)], _at(2024, 2, 29, "8"), _at(2024, 3, 31))
    by_month = _rows(semantic.visual_query(tables, ("dim_date.month_year",), ("revenue_pm",)), "month_year")
    assert by_month["Feb 2024"].revenue_pm == 5 and by_month["Mar 2024"].revenue_pm == 8
    part = semantic.visual_query(tables, (), ("revenue_pm",), {"dim_date.date": ("2024-02-28", "2024-02-29")})
    assert part.first().revenue_pm == 2
    days = _rows(semantic.visual_query(tables, ("dim_date.date",), ("revenue_pm",)), "date")
    assert str(max(days)) == "2024-03-31" and days[max(days)].revenue_pm == 8
    days = {str(d): r.revenue_pm for d, r in days.items()}
    assert days["2024-02-29"] == 1 and days["2024-03-29"] == 8 and days["2024-03-30"] == 8 and "2024-03-28" not in days


def test_running_figures_carry_over_gaps_per_label(spark):
    tables = _star(spark, _at(2023, 12, 30, "5", platform="A"), _at(2024, 1, 2, "10", platform="A"),
                   _at(2024, 4, 4, "20", platform="B"), _at(2024, 3, 1, "3", platform="B", status="Failed"))
    out = semantic.visual_query(tables, ("platform", "dim_date.month_year"),
                                ("revenue_ytd", "revenue_qtd", "transactions_ytd", "cumulative_revenue"))
    got = {(r.platform, r.month_year): tuple(r)[2:] for r in out.collect()}
    assert got == {
        ("A", "Dec 2023"): (5, 5, 1, 5), ("A", "Jan 2024"): (10, 10, 1, 15), ("A", "Feb 2024"): (10, 10, 1, 15),
        ("A", "Mar 2024"): (10, 10, 1, 15), ("A", "Apr 2024"): (10, None, 1, 15),
        ("B", "Mar 2024"): (None, None, 1, None), ("B", "Apr 2024"): (20, 20, 2, 20)}
    assert [(r.platform, r.month_year) for r in out.collect()] == sorted(got, key=lambda k: (k[0], datetime.strptime(k[1], "%b %Y")))


def test_user_filters_and_labels_meet_the_context(spark):
    tables = _star(spark, _at(2024, 1, 5, "1", user_id="USR1"), _at(2024, 2, 5, "2", user_id="USR1"),
                   _at(2024, 1, 6, "4", user_id="USR2"), _at(2024, 2, 6, "8", user_id="USR9"),
                   users=({"user_id": "USR1"}, {"user_id": "USR2", "customer_tier": "New"}))
    by_tier = _rows(semantic.visual_query(tables, ("dim_users.customer_tier",), ("total_revenue", "revenue_pm"),
                                          {"dim_date.month": [2]}), "customer_tier")
    assert {k: tuple(v)[1:] for k, v in by_tier.items()} == {"VIP": (2, 1), "New": (None, 4), None: (8, None)}
    only = semantic.visual_query(tables, (), ("total_revenue", "revenue_pm", "total_transactions", "success_rate_pct"),
                                 {"dim_date.month": [2], "dim_users.customer_tier": ["New"]}).collect()
    assert [tuple(r) for r in only] == [(None, 4.0, 0, 0.0)]


def test_distinct_counts_are_refused_and_empty_contexts_have_no_rows(spark):
    tables = _star(spark, _at(2024, 1, 5))
    with pytest.raises(ValueError, match="unique_users"):
        semantic.visual_query(tables, (), ("unique_users", "revenue_pm"))
    out = semantic.visual_query(tables, ("platform",), ("revenue_pm", "revenue_ytd"), {"dim_date.year": [1990]})
    assert out.count() == 0
    assert semantic.visual_query(_star(spark), ("platform",), ("revenue_pm", "revenue_ytd")).count() == 0


def _scans(plan):
    return len(re.findall(r"FileScan parquet .*?orders\.parquet", plan))


@pytest.mark.parametrize("name", [*PERIOD_VISUALS, "ti_1_4_month_over_month", "ti_9_12_to_date_by_day",
                                  "ti_9_14_by_day_and_platform", "ti_9_10_year_to_date_by_month"])
def test_the_facts_are_read_once(spark, monkeypatch, name):
    plans = []
    for module in (semantic, timeintel):
        keep = module.stored
        monkeypatch.setattr(module, "stored", lambda df, purpose, keep=keep: (
            plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df, purpose))[1])
    result = QUERIES[name](spark, FOLDER)
    assert [_scans(p) for p in plans] == [1]
    assert not any("orders.parquet" in f for f in result.inputFiles())
