import random
import re
from datetime import date, datetime

import numpy as np
import pytest

from tallyspark.operators import quantiles, timeintel
from tallyspark.plans.registry import QUERIES
from tests.data import transactions
from tests.test_oracle import FOLDER


def _at(y, m, d, amount="100", **kw):
    return {"transaction_datetime": datetime(y, m, d, 12), "amount": amount, **kw}


def test_missing_month_gives_no_previous_figure(spark):
    t = transactions(spark, _at(2024, 1, 5), _at(2024, 3, 5, "50"), _at(2024, 4, 5, "75"))
    out = {r.month_start: r for r in timeintel.month_shift(
        timeintel.monthly(t), 1, "pm", "mom_pct").collect()}
    assert out[date(2024, 1, 1)].revenue_pm is None and out[date(2024, 1, 1)].revenue_mom_pct == 0
    assert out[date(2024, 3, 1)].revenue_pm is None and out[date(2024, 3, 1)].revenue_mom_pct == 0
    assert out[date(2024, 4, 1)].revenue_mom_pct == 50.0


def test_previous_year(spark):
    t = transactions(spark, _at(2023, 2, 1, "200"), _at(2024, 2, 29, "100"))
    out = timeintel.month_shift(timeintel.monthly(t), 12, "py", "yoy_pct").orderBy("month_start")
    assert [r.revenue_yoy_pct for r in out.collect()] == [0.0, -50.0]


def test_day_shift_moves_month_ends(spark):
    t = transactions(spark, _at(2024, 2, 29, "10"), _at(2024, 3, 31, "20"))
    out = {r.date: r for r in timeintel.day_shift(timeintel.daily(t), 1, "pm").collect()}
    assert float(out[date(2024, 3, 31)].revenue_pm) == 10.0


def test_running_totals_carry_over_gaps_and_restart(spark):
    t = transactions(spark, _at(2023, 12, 30, "5"), _at(2024, 1, 2, "10"),
                     _at(2024, 1, 4, "20", status="Failed"))
    out = {r.date: r for r in timeintel.to_date_totals(t).collect()}
    assert len(out) == 6
    assert out[date(2023, 12, 31)].revenue_ytd == 5.0
    assert out[date(2024, 1, 1)].revenue_ytd is None
    assert out[date(2024, 1, 3)].revenue_mtd == 10.0
    assert out[date(2024, 1, 4)].revenue_ytd == 10.0
    assert out[date(2024, 1, 4)].transactions_ytd == 2
    assert out[date(2024, 1, 4)].cumulative_revenue == 15.0


def test_running_totals_cover_the_whole_calendar_for_each_label(spark):
    t = transactions(spark, _at(2024, 1, 1, "1", platform="A"), _at(2024, 1, 5, "2", platform="A"),
                     _at(2024, 1, 3, "3", platform="B"))
    rows = timeintel.to_date_totals(t, ["platform"]).orderBy("platform", "date").collect()
    assert [r.cumulative_revenue for r in rows] == [1, 1, 1, 1, 3, None, None, 3, 3, 3]


def test_december_year_to_date_is_the_year(spark):
    t = transactions(spark, *[_at(2024, m, 1, str(m)) for m in range(1, 13)])
    last = timeintel.month_to_date_totals(t).orderBy("month_start").collect()[-1]
    assert last.revenue_ytd == sum(range(1, 13))


def test_quantiles_match_brute_force_across_ranges(spark):
    rng = random.Random(7)
    values = [round(rng.choice([rng.uniform(0.01, 50), rng.uniform(9000, 11000),
                                rng.uniform(1e6, 5e6)]), 2) for _ in range(501)] + [10.0] * 300
    t = transactions(spark, *[{"amount": f"{v:.2f}", "is_flagged": i % 3 == 0}
                              for i, v in enumerate(values)])
    row = quantiles.numeric_profile(t, "amount").first()
    assert row["count"] == len(values)
    for name, q in (("q25", 25), ("q50", 50), ("q75", 75)):
        assert abs(row[name] - np.percentile(values, q)) < 1e-3
    assert abs(row["std"] - np.std(values, ddof=1)) < 0.01
    for r in quantiles.box_stats(t, "amount", "is_flagged", with_mean=True).collect():
        own = [v for i, v in enumerate(values) if (i % 3 == 0) == r.is_flagged]
        q1, q3 = np.percentile(own, [25, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = [v for v in own if low <= v <= high]
        assert r.n_rows == len(own) and r.n_outliers == len(own) - len(inside)
        assert (r.whisker_low, r.whisker_high) == (min(inside), max(inside))
        assert abs(r.mean - np.mean(own)) < 1e-3


def test_brackets_select_exactly_among_many_rows(spark):
    """Above the steps of the sketch: ties at the quartiles, stretches between the brackets."""
    rows = spark.range(60_000).selectExpr(
        "id % 2 = 0 AS is_flagged",
        "CAST(CASE WHEN id % 10 < 3 THEN 100 ELSE pmod(xxhash64(id), 10000000) / 100.0 END AS decimal(12,2)) AS amount")
    counted = quantiles.counted(rows, "amount", ["is_flagged"], fences=True).collect()
    assert len(counted) < 3_000 and any(r.least < r.most for r in counted)
    found = {r.is_flagged: r for r in quantiles.box_stats(rows, "amount", "is_flagged").collect()}
    for flag, r in found.items():
        own = np.array([float(x.amount) for x in rows.filter(f"is_flagged = {flag}").collect()])
        q1, median, q3 = np.percentile(own, [25, 50, 75])
        assert abs(r.q1 - q1) < 1e-3 and abs(r["median"] - median) < 1e-3 and abs(r.q3 - q3) < 1e-3
        inside = own[(own >= q1 - 1.5 * (q3 - q1)) & (own <= q3 + 1.5 * (q3 - q1))]
        assert (r.whisker_low, r.whisker_high, r.n_outliers) == (inside.min(), inside.max(), len(own) - len(inside))
    one = quantiles.numeric_profile(rows.withColumn("amount", rows.amount * 0 + 5), "amount").first()
    assert (one.q25, one.q75, one["min"], one["max"], one["count"]) == (5.0, 5.0, 5.0, 5.0, 60_000)


@pytest.mark.parametrize("name", ["dq_20_amount_profile", "ed_13b_box_by_flag", "ap_22_box_with_mean", "vz_36e_amount_by_flag"])
def test_two_reads_of_the_facts(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet .*?orders\.parquet", plan)) <= 2


def test_a_single_value(spark):
    row = quantiles.numeric_profile(transactions(spark, {"amount": "7"}), "amount").first()
    assert (row.q25, row.q50, row.q75, row.std) == (7.0, 7.0, 7.0, None)


def test_a_label_without_rows_keeps_its_earlier_figures(spark):
    t = transactions(spark, {"platform": "A", "amount": "100", "transaction_datetime": datetime(2024, 1, 5)},
                     {"platform": "B", "amount": "70", "transaction_datetime": datetime(2024, 2, 5)})
    shifted = timeintel.month_shift(timeintel.monthly(t, ["platform"]), 1, "pm", "mom_pct", ["platform"])
    rows = {(r.platform, r.month_start.month): r for r in shifted.collect()}
    assert set(rows) == {("A", 1), ("A", 2), ("B", 2)}
    gap = rows["A", 2]
    assert gap.revenue is None and float(gap.revenue_pm) == 100 and gap.revenue_mom_pct == -100
    carried = {(r.platform, r.month_start.month): r for r in timeintel.month_to_date_totals(t, ["platform"]).collect()}
    assert carried["A", 2].revenue_ytd == 100 and carried["A", 2].revenue_mtd is None
