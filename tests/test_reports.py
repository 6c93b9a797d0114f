from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyspark.functions.measures import OK, Term, distinct, mean, per, rate, rows, total
from tallyspark.operators import filters, quality, users
from tallyspark.operators.aggregate import Dimension, Report, Share, run
from tallyspark.operators.joins import profile_columns
from tallyspark.plans import dashboard_reports, eda_reports, semantic, sql_reports, workbook_reports
from tallyspark.operators.star import build_star, relationship_check
from tallyspark.functions.derive import add_row_features
from tests.data import profiles, transactions


def test_rounding_is_half_up_and_exact(spark):
    t = transactions(spark, *[{"status": "Success" if i < 1 else "Failed"} for i in range(8)])
    # 1/8 = 12.5 %; 12.5 at 0 places rounds up
    got = run(Report(measures=(rate("a", OK, places=0), rate("b", OK, places=2))), t).first()
    assert (got.a, got.b) == (13.0, 12.5)
    cents = transactions(spark, {"amount": "0.01"}, {"amount": "0.02"})
    assert run(Report(measures=(mean("m", "amount", places=2),)), cents).first().m == 0.02


def test_money_sums_are_exact_for_large_and_negative_values(spark):
    t = transactions(spark, {"amount": "9999999999.99"}, {"amount": "-0.01"},
                     {"amount": "-9999999999.99"}, {"amount": None})
    assert run(Report(measures=(total("s", "amount", exact=True),)), t).first().s == \
        Decimal("-0.01")


def test_empty_denominators(spark):
    none = transactions(spark, {}).filter("false")
    row = run(Report(measures=(rate("r", OK, places=2), rate("z", OK, empty=0.0),
                               mean("m", "amount"), total("s", "amount"), rows("n"))), none).first()
    assert row.asDict() == {"r": None, "z": 0.0, "m": None, "s": None, "n": 0}
    kpis = dashboard_reports.report("1", none).first()
    assert kpis.total_txn == 0 and kpis.success_rate == 0.0 and kpis.avg_txn == 0.0


def test_reduced_join_equals_row_level_join(spark):
    t = transactions(spark, *[{"user_id": f"USR{i % 5}", "amount": str(10 + i),
                               "status": "Success" if i % 3 else "Failed",
                               "payment_method": "UPI" if i % 2 else "Card"} for i in range(60)])
    u = profiles(spark, *[{"user_id": f"USR{i}", "customer_tier": "VIP" if i % 2 else "New"}
                          for i in range(4)])
    measures = (rows("n"), distinct("users", "user_id"), distinct("methods", "payment_method"),
                total("ok", "amount", OK), mean("avg", "amount", places=2),
                per("each", total("v", "amount"), distinct("u", "user_id")))
    keys = ("customer_tier", "payment_method")
    for how in ("inner", "left"):
        reduced = run(Report(keys, measures), t, [Dimension(profile_columns(u), "user_id", how)])
        direct = run(Report(keys, measures), t.join(profile_columns(u), "user_id", how))
        assert sorted(map(str, reduced.collect())) == sorted(map(str, direct.collect()))


def test_shares_add_up_and_use_the_filter(spark):
    t = transactions(spark, *[{"status": "Failed", "failure_reason": r}
                              for r in ("a", "a", "b", None)], {"status": "Success"})
    out = run(Report(("failure_reason",), (rows("n"),), where="status = 'Failed'",
                     shares=(Share("pct", Term("rows")),)), t)
    assert {r.failure_reason: r.pct for r in out.collect()} == {"a": 50.0, "b": 25.0, None: 25.0}


def test_sql_reports_keep_a_null_group_and_eda_drops_it(spark):
    t = transactions(spark, {"status": "Failed", "failure_reason": None},
                     {"status": "Failed", "failure_reason": "a"})
    assert sql_reports.report("3a", t).count() == 2
    assert eda_reports.report("6a", t).count() == 1


def test_limits_break_ties_by_key(spark):
    t = transactions(spark, *[{"transaction_datetime": datetime(2024, 1, 1, h),
                               "status": "Failed"} for h in range(24)])
    assert [r.txn_hour for r in sql_reports.report("3c", t).collect()] == list(range(10))


def test_levels_without_rows_stay(spark):
    t = transactions(spark, {"transaction_datetime": datetime(2024, 1, 6, 9)})
    speeds = eda_reports.report("17b", t).collect()
    assert [(r.processing_speed, r["count"]) for r in speeds] == [
        ("Instant", 1), ("Fast", 0), ("Normal", 0), ("Slow", 0), ("Very Slow", 0)]
    days = eda_reports.report("4", t).collect()
    assert [r.day_name for r in days][5] == "Saturday"
    assert days[5].h09 == 1 and days[5].h10 == 0 and days[0].h09 is None


def test_segments_and_top_users(spark):
    t = transactions(spark, *[{"user_id": u, "amount": a} for u, a, n in (
        ("A", "10", 20), ("B", "50", 10), ("C", "50", 10), ("D", "1", 4)) for _ in range(n)])
    u = profiles(spark, *[{"user_id": x} for x in "ABC"])
    out = {r.user_segment: r.user_count for r in users.segments(t).collect()}
    assert out == {"Power User (20+)": 1, "Regular User (10-19)": 2, "Rare User (1-4)": 1}
    top = users.top_spenders(t, u, 2).collect()
    assert [r.user_id for r in top] == ["B", "C"]
    assert workbook_reports.top_users(t, 3).collect()[2].user_id == "A"


def test_user_without_success_spends_zero(spark):
    t = transactions(spark, {"user_id": "A", "status": "Failed"}, {"user_id": "B"},
                     {"user_id": None})
    e = users.enrich(t, profiles(spark, {"user_id": "A"}))
    got = {r.user_id: r for r in e.collect()}
    assert len(e.columns) == 52
    assert got["A"].user_total_spend == 0 and got["A"].user_avg_txn_amount == 0.0
    assert got["A"].user_failure_rate_pct == 100.0 and got["A"].age_group == "25-34"
    assert got["B"].age_group is None and got["B"].user_total_txns == 1
    assert got[None].user_total_spend == 0 and got[None].user_total_txns is None


def test_a_very_frequent_user_changes_nothing(spark):
    t = transactions(spark, *[{"user_id": "HOT" if i % 3 else f"U{i}"} for i in range(300)])
    e = users.enrich(t, profiles(spark, {"user_id": "HOT"}))
    assert e.count() == 300
    assert e.filter("user_id = 'HOT'").first().user_total_txns == 200


@pytest.fixture
def slicer_rows(spark):
    return transactions(
        spark,
        {"transaction_datetime": datetime(2024, 1, 1), "city": "A"},
        {"transaction_datetime": datetime(2024, 1, 31, 23, 59), "city": "B"},
        {"transaction_datetime": datetime(2024, 2, 1), "city": "A", "payment_method": "Card"},
    )


def test_slicers(slicer_rows):
    def kept(**chosen):
        return filters.apply_filters(slicer_rows, **chosen).count()

    january = {"date_from": date(2024, 1, 1), "date_to": date(2024, 1, 31)}
    assert kept(**january) == 2
    assert kept(date_from=january["date_to"], date_to=january["date_from"]) == 2
    assert kept(cities=[]) == 3 and kept(cities=["A"]) == 2
    assert kept(cities=["A"], methods=["Card"]) == 1
    assert kept(**filters.preset("2024")) == 3 and kept(**filters.preset("2025")) == 0
    share = filters.coverage(slicer_rows, **january).first()
    assert (share.kept_rows, share.total_rows) == (2, 3)
    options = [(r.field, r.option) for r in filters.option_lists(slicer_rows).collect()]
    assert ("city", "A") in options and options == sorted(options)


def test_festival_needs_both_months(spark):
    t = transactions(spark, {"transaction_datetime": datetime(2024, 10, 2)},
                     {"transaction_datetime": datetime(2024, 11, 2)},
                     {"transaction_datetime": datetime(2025, 10, 2)})
    assert [tuple(r) for r in dashboard_reports.festival_periods(t).collect()] == [
        (2024, "2024 Oct", "2024 Nov")]


def test_mobile_comparison_needs_both_systems(spark):
    one = transactions(spark, {"device_type": "iOS"})
    both = transactions(spark, {"device_type": "iOS"}, {"device_type": "Android"})
    assert dashboard_reports.mobile_comparison(one).count() == 0
    assert dashboard_reports.mobile_comparison(both).count() == 2


def test_rollup_of_the_summary_view_equals_the_global_report(spark):
    t = transactions(spark, *[{"amount": str(i), "status": "Failed" if i % 4 == 0 else "Success",
                               "city": f"C{i % 3}"} for i in range(1, 30)])
    view = sql_reports.report("v1", t)
    whole = sql_reports.report("1a", t).first()
    assert view.groupBy().sum("txn_count").first()[0] == whole.total_transactions
    ok = view.filter(OK).groupBy().sum("total_amount").first()[0]
    assert ok == pytest.approx(whole.total_successful_volume)


def test_visuals_hide_blank_groups_and_restrict_by_dimension(spark):
    t = transactions(spark, {"status": "Failed", "failure_reason": "a"}, {},
                     {"platform": "Web Browser", "user_id": "USR2"})
    u = profiles(spark, {}, {"user_id": "USR2", "customer_tier": "New"})
    star = build_star(add_row_features(t), u)
    assert [r.failure_reason for r in semantic.visual("12", star).collect()] == ["a"]
    by_channel = semantic.visual_query(star, ("dim_platform.channel",), ("total_transactions",),
                                       filters={"dim_users.customer_tier": ["VIP"]})
    assert [tuple(r) for r in by_channel.collect()] == [("Mobile", 2)]
    assert all(r.n_rows == 0 for r in relationship_check(star).collect())


def test_others_row_holds_the_remainder(spark):
    t = transactions(spark, *[{"status": "Failed", "failure_reason": r} for r in "aaabbcde"])
    out = [(r.reason, r["count"], r.pct) for r in semantic.top_reasons(t, 2).collect()]
    assert out == [("a", 3, 37.5), ("b", 2, 25.0), ("Others", 3, 37.5)]


def test_distribution_percentages(spark):
    t = transactions(spark, {}, {}, {"status": "Failed"})
    assert [tuple(r) for r in quality.distribution(t, "status").collect()] == [
        ("Success", 2, 66.67), ("Failed", 1, 33.33)]


def test_visuals_show_every_group(spark):
    t = transactions(spark, *[{"merchant": f"m{i}"} for i in range(1200)])
    star = build_star(add_row_features(t), profiles(spark, {}))
    assert semantic.visual_query(star, ("merchant",), ("total_transactions",)).count() == 1200
    assert semantic.visual_query(star, ("merchant",), ("total_transactions",), limit=5).count() == 5


def test_failure_matrix_counts_unlisted_reasons(spark):
    t = transactions(spark, *[{"status": "Failed", "failure_reason": r, "payment_method": "UPI"}
                              for r in ("OTP Failed", "Brand New", "Brand New")])
    row = dashboard_reports.failure_crosstab(t).first()
    assert row["OTP Failed"] == 1 and row["Other"] == 2
    assert {(r.failure_reason, r["count"]) for r in dashboard_reports.failure_counts(t).collect()} == {
        ("OTP Failed", 1), ("Brand New", 2)}


def test_shares_of_very_large_sums(spark):
    t = transactions(spark, {"amount": "9999999999.99", "status": "Failed", "failure_reason": "x"})
    big = t.crossJoin(spark.range(20_000)).drop("id")
    assert sql_reports.report("3d", big).first().pct_of_total_lost == 100.0


def test_savings_far_above_the_amount(spark):
    from tallyspark.functions.derive import savings_pct

    t = transactions(spark, {"amount": "0.01", "cashback_earned": "1000000"},
                     {"amount": "10", "cashback_earned": "1"})
    got = [r.p for r in t.select(savings_pct().alias("p")).collect()]
    assert Decimal("10.00") in got and len(got) == 2


def test_date_and_profile_visuals_scan_once(spark):
    t = transactions(spark, *[{"user_id": f"USR{i % 3}"} for i in range(9)])
    u = profiles(spark, *[{"user_id": f"USR{i}"} for i in range(3)])
    star = build_star(add_row_features(t), u)
    for name in ("2", "6", "8", "21", "36a", "36b"):
        plan = semantic.visual(name, star)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "Join" not in plan
    plan = semantic.visual("16", star)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1


def test_a_hot_user_is_split(spark, tmp_path):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        t = transactions(spark, *[{"user_id": f"USR{i % 40 if i % 2 else 0}", "transaction_id": f"T{i}"} for i in range(4000)])
        t.repartition(8).write.parquet(f"{tmp_path}/t")
        u = profiles(spark, *[{"user_id": f"USR{i}"} for i in range(40)])
        t = spark.read.schema(t.schema).parquet(f"{tmp_path}/t")
        users.user_table(t, u).write.parquet(f"{tmp_path}/u")
        out = users.enrich(t, u, users=spark.read.parquet(f"{tmp_path}/u"))
        assert out.count() == 4000
        rows_ = out.selectExpr(f"sum(hash({', '.join(out.columns)})) AS s")
        rows_.collect()
        assert "skew=true" in rows_._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_labels_and_filtered_distincts_with_a_borrowed_key(spark):
    from tallyspark.functions.measures import Measure, labels

    t = transactions(spark, *[{"user_id": f"USR{i % 4}", "status": "Success" if i % 3 else "Failed",
                               "payment_method": "UPI" if i % 2 else "Card"} for i in range(24)])
    u = profiles(spark, *[{"user_id": f"USR{i}", "customer_tier": "VIP" if i % 2 else "New"} for i in range(4)])
    measures = (labels("m", "payment_method"), Measure("ok", Term("distinct", "user_id", OK)))
    got = run(Report(("customer_tier",), measures), t, [Dimension(profile_columns(u), "user_id")])
    want = run(Report(("customer_tier",), measures), t.join(profile_columns(u), "user_id"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2
