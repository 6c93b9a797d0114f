from decimal import Decimal

from pyspark.sql import functions as F

from tallyspark.operators import clean, joins, quality
from tests.data import column, profiles, transactions


def test_reason_repairs(spark):
    t = transactions(
        spark,
        {"status": "Failed", "failure_reason": None}, {"status": "Failed", "failure_reason": ""},
        {"status": "Failed", "failure_reason": " "}, {"status": "Failed", "failure_reason": "x "},
        {"status": "Success", "failure_reason": "stale"},
        {"status": "Success", "failure_reason": ""},
        {"status": "Pending", "failure_reason": "Processing"},
    )
    # A blank reason is trimmed only after the missing ones were named.
    assert column(clean.clean(t), "failure_reason") == [
        "Unknown", "Unknown", "", "x", None, "", "Processing"]


def test_refund_and_fraud_repairs(spark):
    t = transactions(
        spark,
        {"status": "Failed", "is_refunded": True, "refund_amount": "50"},
        {"is_refunded": True, "refund_amount": "250"},
        {"is_refunded": False, "refund_amount": "250"},
        {"is_flagged": False, "fraud_reason": "r"}, {"is_flagged": True, "fraud_reason": " r "},
    )
    out = clean.clean(t)
    assert column(out, "is_refunded") == [False, True, False, False, False]
    assert column(out, "refund_amount")[:3] == [Decimal("0.00"), Decimal("100.00"),
                                                Decimal("250.00")]
    assert column(out, "fraud_reason")[3:] == [None, "r"]


def test_cleaning_twice_changes_nothing(spark):
    t = transactions(spark, {"status": "Failed"}, {"failure_reason": "stale"},
                     {"is_refunded": True, "refund_amount": "900"}, {"category": " Travel "})
    once = clean.clean(t)
    assert once.orderBy("transaction_id").collect() == clean.clean(once).orderBy(
        "transaction_id").collect()


def test_strip_takes_every_white_space_and_trim_only_spaces(spark):
    t = transactions(spark, {"category": "\t Travel \n", "merchant": " a b "})
    assert clean.strip_text(t).first().category == "Travel"
    assert clean.trim_spaces(t).first().category == "\t Travel \n"
    assert clean.strip_text(t).first().merchant == "a b"


def test_bad_text_becomes_null_not_an_error(spark):
    raw = transactions(spark, {}).select(*[F.col(c).cast("string").alias(c)
                                           for c in transactions(spark, {}).columns])
    bad = raw.withColumns({"amount": F.lit("abc"), "is_flagged": F.lit("False"),
                           "transaction_datetime": F.lit("no date")})
    row = clean.coerce_types(bad).first()
    assert row.amount is None and row.transaction_datetime is None and row.is_flagged is False


def test_reasons_survive_the_export_form(spark):
    t = transactions(spark, {"failure_reason": None}, {"failure_reason": "x"})
    filled = clean.fill_reasons(t)
    assert column(filled, "failure_reason") == ["None", "x"]
    assert column(clean.blank_reasons(filled), "failure_reason") == [None, "x"]


def test_faults_are_counted(spark):
    t = transactions(
        spark,
        {"amount": "0"}, {"amount": "-1"}, {"status": "Failed", "failure_reason": ""},
        {"failure_reason": "x"}, {"cashback_earned": "-1"}, {"discount_applied": "-1"},
        {"status": "Pending", "is_refunded": True},
        {"is_refunded": True, "refund_amount": "100.01"}, {"fraud_reason": "r"},
    )
    row = quality.fault_counts(t).first().asDict()
    assert row == {"invalid_amounts": 2, "missing_reasons": 1, "incorrect_reasons": 1,
                   "negative_cashback": 1, "negative_discount": 1, "invalid_refunds": 1,
                   "over_refunds": 1, "invalid_fraud_reasons": 1}
    after = quality.scorecard(clean.clean(t)).first()
    assert after.failed_without_reason == after.success_with_reason == 0
    assert after.invalid_refunds == after.orphan_fraud_reasons == 0


def test_orphans_and_duplicates(spark):
    t = transactions(spark, {"user_id": "USR1"}, {"user_id": "USR9"}, {"user_id": "USR9"},
                     {"user_id": None}, {"transaction_id": "TXN0", "user_id": "USR9"})
    u = profiles(spark, {})
    assert joins.orphan_rows(t, u).count() == 4
    assert quality.orphan_count(t, u).first()[0] == 4
    assert quality.duplicate_ids(t).collect() == [("TXN0", 2)]
    assert quality.duplicate_rows(t).first()[0] == 1


def test_check_rules_ignore_unknown_values(spark):
    t = transactions(spark, {"status": None}, {"status": "Done"}, {"amount": "0"})
    u = profiles(spark, {"age_group": "60+"}, {"user_id": "USR2", "gender": None})
    found = {r.rule: r.n_violations for r in quality.check_rules(t, u).collect()}
    assert found["status_domain"] == 1 and found["amount_positive"] == 1
    assert found["age_group_domain"] == 1 and found["gender_domain"] == 0


def test_empty_table_gives_zero_counts(spark):
    t = transactions(spark, {}).filter("false")
    assert quality.duplicate_rows(t).first()[0] == 0
    assert quality.fault_counts(t, "invalid_amounts").first()[0] == 0
