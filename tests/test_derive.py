from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark.functions import derive
from tallyspark.schemas import ENRICHED_COLUMNS, FACT_COLUMNS
from tests.data import column, transactions


def _values(spark, field, values, build):
    t = transactions(spark, *[{"transaction_id": f"{i:02d}", field: v}
                              for i, v in enumerate(values)])
    return column(t.select("transaction_id", build().alias("x")), "x")


def test_amount_bands_are_closed_on_the_left(spark):
    amounts = ["0.01", "99.99", "100", "499.99", "500", "2000", "10000", "50000", "50000.01"]
    got = _values(spark, "amount", amounts, derive.amount_bucket)
    assert [g.split()[0] for g in got] == [
        "Micro", "Micro", "Small", "Small", "Medium", "Large", "High", "Premium", "Premium"]


def test_workbook_amount_bands_are_closed_on_the_right(spark):
    got = _values(spark, "amount", ["-1", "0", "500", "500.01", "50000", "50000.01"],
                  lambda: derive.amount_bucket(rule="workbook"))
    assert got == [None, None, "Micro (<500)", "Small (500-2K)", "High Value (10K+)", None]


def test_time_slots_by_rule(spark):
    hours = [4, 5, 11, 12, 16, 17, 20, 21, 22, 23]
    stamps = [datetime(2024, 1, 1, h) for h in hours]

    def slots(rule):
        return [v.split()[0] for v in _values(
            spark, "transaction_datetime", stamps,
            lambda: derive.time_slot(F.hour("transaction_datetime"), rule))]

    m, a, e, n = "Morning", "Afternoon", "Evening", "Night"
    assert slots("sql") == [n, m, m, a, a, e, e, e, n, n]
    assert slots("pipeline") == [n, m, m, a, a, e, e, n, n, n]
    assert slots("workbook") == [n, n, m, a, a, e, e, e, n, n]
    assert slots("fraud5") == ["Late", m, m, a, a, e, e, e, n, n]


def test_processing_speed(spark):
    got = _values(spark, "processing_time_sec", ["1.00", "1.01", "2.00", "5.00", "15.00", "15.01"],
                  derive.processing_speed)
    assert got == ["Instant", "Fast", "Fast", "Normal", "Slow", "Very Slow"]
    failed = transactions(spark, {"status": "Failed", "processing_time_sec": "0.50"})
    assert failed.select(derive.processing_speed()).first()[0] == "Failed"


def test_savings_tiers(spark):
    got = _values(spark, "cashback_earned", ["0", "199.99", "200", "499.99", "500"],
                  derive.savings_tier)
    assert [g.split()[0] for g in got] == ["No", "Low", "Medium", "Medium", "High"]


def test_net_amount_stops_at_zero_and_keeps_null(spark):
    t = transactions(spark, {"amount": "10", "cashback_earned": "8", "discount_applied": "5"},
                     {"amount": None})
    assert column(t.select("transaction_id", derive.net_amount().alias("x")), "x") == [
        Decimal("0.00"), None]


def test_savings_pct_rounds_half_up_and_is_zero_without_an_amount(spark):
    t = transactions(spark, {"amount": "8", "cashback_earned": "0.01"},
                     {"amount": "0", "cashback_earned": "5"})
    got = column(t.select("transaction_id", derive.savings_pct().alias("x")), "x")
    assert got == [Decimal("0.13"), Decimal("0.00")]


def test_user_bands(spark):
    counts = spark.createDataFrame([(n,) for n in (4, 5, 9, 10, 19, 20)], "txn_count int")
    got = [r[0] for r in counts.orderBy("txn_count").select(derive.user_segment()).collect()]
    assert [g.split()[0] for g in got] == ["Rare", "Occasional", "Occasional", "Regular",
                                           "Regular", "Power"]
    spend = spark.createDataFrame([(v,) for v in (9999.99, 10000.0, 50000.0, 200000.0)],
                                  "user_total_spend double")
    got = [r[0] for r in spend.orderBy("user_total_spend").select(
        derive.user_spending_tier()).collect()]
    assert got == ["Low", "Medium", "High", "Very High"]


def test_refund_types(spark):
    t = transactions(spark, *[{"is_refunded": True, "refund_amount": v}
                              for v in ("98.50", "99.00", "100.00", "101.00")])
    shown = t.select("transaction_id", derive.refund_type().alias("kind"),
                     derive.is_full_refund("exact").alias("exact"))
    assert [k.split()[0] for k in column(shown, "kind")] == ["Partial", "Full", "Full", "Full"]
    assert column(shown, "exact") == [False, False, True, False]


def test_calendar_features(spark):
    t = transactions(spark, {"transaction_datetime": datetime(2024, 12, 30, 21, 5)})
    row = derive.add_row_features(t).first()
    assert (row.week_number, row.day_of_week, row.day_name, row.month_name) == (1, 0, "Monday",
                                                                                "Dec")
    assert (row.is_month_end, row.is_month_start, row.time_bucket) == (1, 0, "Night")
    assert t.select(derive.date_key("transaction_datetime")).first()[0] == 20241230


def test_features_are_added_only_when_mentioned(spark):
    t = transactions(spark, {})
    out = derive.add_features_in(t, "sum(total_savings) WHERE hour > 3 AND amount > 1")
    assert set(out.columns) - set(t.columns) == {"total_savings", "hour"}
    assert derive.add_features_in(out, "hour").columns == out.columns


def test_status_bands(spark):
    rates = spark.createDataFrame([(95.0,), (94.9,), (89.9,)], "r double")
    assert [r[0] for r in rates.select(derive.status_band("r", "success")).collect()] == [
        "good", "warn", "bad"]
    frauds = spark.createDataFrame([(2.0,), (2.1,), (5.1,)], "r double")
    assert [r[0] for r in frauds.select(derive.status_band("r", "fraud")).collect()] == [
        "good", "warn", "bad"]


def test_screening_rules(spark):
    night = datetime(2024, 1, 1, 3)
    t = transactions(
        spark,
        {"category": "Travel", "amount": "10000.01"}, {"category": "Travel", "amount": "10000"},
        {"category": "Travel", "amount": "10000.01", "transaction_datetime": night},
        {"category": " Groceries ", "amount": "3000.01"}, {"category": "Other", "amount": "50000"},
    )
    assert column(derive.add_screening(t), "rule_reason") == [
        "Unusually High Amount", None, "Suspicious Late Night Transaction",
        "Unusually High Amount", None]


def test_unit_text(spark):
    df = spark.createDataFrame([(123456789.0,)], "v double")
    assert df.select(derive.unit_text("v", "crore", "₹")).first()[0] == "₹12.35 Cr"
    assert df.select(derive.unit_text("v", "lakh")).first()[0] == "1234.57 L"


def test_column_orders():
    assert len(ENRICHED_COLUMNS) == len(set(ENRICHED_COLUMNS)) == 52
    assert len(FACT_COLUMNS) == 32
