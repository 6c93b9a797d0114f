"""The analysis catalogue of the SQL layer: 36 reports and 3 views.

Reports in ``REPORTS`` run over cleaned transactions; those in ``PROFILE_REPORTS``
also use the user's profile.  Rates are percentages with two decimals.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import derive
from tallyspark.functions.measures import (
    BAD, FLAGGED, OK, PENDING, REFUNDED, Term, distinct, labels, mean, per, rate, rows, total,
)
from tallyspark.operators.aggregate import Dimension, Report, Share, run
from tallyspark.operators.joins import profile_columns, with_profiles
from tallyspark.operators.users import segments, top_spenders

MONTH = derive.month_key("txn_month")
HOUR = ("txn_hour", "hour(transaction_datetime)")
N = rows("total_txn")
SUCCESS = rate("success_rate", OK, places=2)
FAILURE = rate("failure_rate", BAD, places=2)
USERS = distinct("unique_users", "user_id")


def avg(name, value="amount", where=None):
    return mean(name, value, where, places=2)


REPORTS = {
    "1a": Report(measures=(
        rows("total_transactions"), rows("successful", OK), rows("failed", BAD),
        rows("pending", PENDING), SUCCESS.named("success_rate_pct"),
        FAILURE.named("failure_rate_pct"), total("total_successful_volume", "amount", OK),
    )),
    "1b": Report(("payment_method",), (
        N, rows("success_count", OK), rows("fail_count", BAD), SUCCESS, avg("avg_txn_amount"),
        total("total_successful_amount", "amount", OK),
    ), order=("-success_rate", "payment_method")),
    "1c": Report((MONTH, ("month_name", "trunc(transaction_datetime, 'MM')", "date_format({}, 'MMMM')")), (
        N, rows("success_count", OK), SUCCESS, total("total_volume", "amount"),
    ), order=("txn_month",)),
    "1d": Report(("city",), (
        N, SUCCESS, avg("avg_amount"), total("successful_volume", "amount", OK),
    ), order=("-total_txn", "city")),
    "1e": Report(("device_type",), (
        N, SUCCESS, avg("avg_processing_time", "processing_time_sec"),
    ), order=("-total_txn", "device_type")),
    "1f": Report((("day_type", derive.day_type),), (
        N, SUCCESS, avg("avg_amount"), total("total_volume", "amount"),
    ), order=("day_type",)),
    "2a": Report((HOUR,), (
        N, total("total_volume", "amount"), avg("avg_amount"), SUCCESS, FAILURE,
    ), order=("txn_hour",)),
    "2b": Report((("day_name", derive.day_name), ("day_num", "dayofweek(transaction_datetime)")), (
        N, total("total_volume", "amount"), SUCCESS, USERS,
    ), order=("day_num",)),
    "2c": Report(("payment_method", HOUR), (
        rows("txn_count"), total("volume", "amount"),
    ), where=OK, order=("payment_method", "txn_hour")),
    "2d": Report((MONTH, ("season_type", derive.season_type)), (
        rows("txn_count"), total("total_volume", "amount"), USERS, avg("avg_txn_value"),
    ), order=("txn_month",)),
    "2e": Report((("quarter", "quarter(transaction_datetime)", "concat('Q', {})"), "category"), (
        rows("txn_count"), total("successful_volume", "amount", OK),
    ), order=("quarter", "-txn_count", "category")),
    "3a": Report(("failure_reason",), (
        rows("fail_count"), avg("avg_failed_amount"),
        avg("avg_processing_time", "processing_time_sec"),
    ), where=BAD, shares=(Share("pct_of_failures", Term("rows")),),
        order=("-fail_count", "failure_reason")),
    "3b": Report(("payment_method", "failure_reason"), (
        rows("fail_count"), avg("avg_failed_amount"), avg("avg_proc_time", "processing_time_sec"),
    ), where=BAD, order=("payment_method", "-fail_count", "failure_reason")),
    "3c": Report((HOUR,), (
        N, rows("failed_txn", BAD), FAILURE,
    ), order=("-failure_rate", "txn_hour"), limit=10),
    "3d": Report(("payment_method",), (
        rows("failed_txn_count"), total("lost_revenue", "amount"), avg("avg_failed_txn_value"),
    ), where=BAD, shares=(Share("pct_of_total_lost", Term("sum", "amount")),),
        order=("-lost_revenue", "payment_method")),
    "3e": Report(("category",), (
        N, rows("failed_count", BAD), FAILURE, total("lost_amount", "amount", BAD),
    ), order=("-failure_rate", "category")),
    "3f": Report(("platform", "device_type"), (
        N, rows("failed_count", BAD), FAILURE,
    ), order=("-failure_rate", "platform", "device_type")),
    "4d": Report((MONTH,), (
        distinct("monthly_active_users", "user_id"), N,
        per("txn_per_active_user", N, USERS, places=1),
        per("revenue_per_active_user", total("r", "amount", OK), USERS, places=2),
    ), order=("txn_month",)),
    "5a": Report(("payment_method",), (
        N, rows("txn_with_cashback", "cashback_earned > 0"),
        rate("cashback_rate_pct", "cashback_earned > 0", places=2),
        total("total_cashback", "cashback_earned"),
        avg("avg_cashback_per_txn", "cashback_earned", "cashback_earned > 0"),
    ), where=OK, order=("-total_cashback", "payment_method")),
    "5b": Report(("category",), (
        N, rows("txn_with_discount", "discount_applied > 0"),
        total("total_discount_value", "discount_applied"),
        # the mean of the per-row percentages, not the percentage of the sums
        avg("avg_discount_pct",
            "cast(try_divide(discount_applied * 100, amount) AS decimal(20,7))",
            "discount_applied > 0"),
    ), where=OK, order=("-total_discount_value", "category")),
    "5c": Report((("savings_tier", derive.savings_tier),), (
        rows("txn_count"), avg("avg_txn_amount"), total("total_volume", "amount"),
    ), where=OK, order=("-avg_txn_amount", "savings_tier")),
    "6a": Report(("is_flagged",), (
        rows("txn_count"), avg("avg_amount"), total("total_amount", "amount"), FAILURE,
    ), order=("is_flagged",)),
    "6b": Report(("fraud_reason",), (
        rows("flag_count"), avg("avg_flagged_amount"),
        avg("avg_processing_time", "processing_time_sec"),
        labels("methods_involved", "payment_method"),
    ), where=FLAGGED, order=("-flag_count", "fraud_reason")),
    "6c": Report((("time_slot", lambda: derive.time_slot(F.hour("transaction_datetime"),
                                                        "fraud5")),), (
        rows("flagged_count"), avg("avg_flagged_amount"),
    ), where=FLAGGED, order=("-flagged_count", "time_slot")),
    # The refund figures and the revenue they are compared with come from one pass.
    "7a": Report(measures=(
        rows("total_refunds", REFUNDED),
        rows("full_refunds", "is_refunded AND refund_amount = amount"),
        rows("partial_refunds", "is_refunded AND refund_amount < amount AND refund_amount > 0"),
        total("total_refund_value", "refund_amount", REFUNDED, zero=False),
        avg("avg_refund_amount", "refund_amount", REFUNDED),
        per("refund_as_pct_of_revenue", total("v", "refund_amount", REFUNDED, zero=False),
            total("r", "amount", OK, zero=False), scale=100, places=2),
    )),
    "7b": Report(("category",), (
        rows("refund_count"), total("total_refunded", "refund_amount"),
        avg("avg_refund", "refund_amount"),
    ), where=REFUNDED, shares=(Share("pct_of_all_refunds", Term("rows")),),
        order=("-refund_count", "category")),
    "7c": Report(("payment_method",), (
        rows("total_successful"), rows("refunded", REFUNDED),
        rate("refund_rate_pct", REFUNDED, places=2),
        total("total_refund_value", "refund_amount", REFUNDED),
    ), where=OK, order=("-refund_rate_pct", "payment_method")),
    "8a": Report(("platform",), (
        N, USERS, total("successful_volume", "amount", OK), SUCCESS,
        avg("avg_processing_time", "processing_time_sec"),
        total("total_cashback", "cashback_earned"),
    ), order=("-total_txn", "platform")),
    "8b": Report(("device_type", "platform"), (
        N, avg("avg_amount"), SUCCESS, avg("avg_proc_time", "processing_time_sec"),
    ), order=("-total_txn", "device_type", "platform")),
    "8c": Report((("mobile_os", "device_type"),), (
        N, avg("avg_txn_amount"), SUCCESS, total("total_volume", "amount", OK),
        total("total_cashback", "cashback_earned"), rate("fraud_flag_rate", FLAGGED, places=2),
    ), where="device_type IN ('Android', 'iOS')", order=("mobile_os",)),
    "v1": Report((derive.month_key("month"), "payment_method", "category", "platform",
                  "device_type", "city", "status", "is_weekend"), (
        rows("txn_count"), total("total_amount", "amount"), avg("avg_amount"),
        avg("avg_processing_time", "processing_time_sec"),
        total("total_cashback", "cashback_earned"), total("total_discount", "discount_applied"),
        rows("flagged_count", FLAGGED), rows("refund_count", REFUNDED),
        total("total_refund_amount", "refund_amount"), USERS,
    )),
    "v2": Report(measures=(
        rows("total_transactions"), total("total_revenue", "amount", OK), SUCCESS,
        avg("avg_successful_txn", "amount", OK), distinct("total_active_users", "user_id"),
        total("total_promotions_cost", "cashback_earned + discount_applied"),
        rows("fraud_flags", FLAGGED),
        total("total_refunds", "refund_amount", REFUNDED, zero=False),
        avg("avg_success_processing_time", "processing_time_sec", OK),
    )),
}

PROFILE_REPORTS = {
    "4c": Report(("age_group", "payment_method"), (
        rows("txn_count"), USERS, avg("avg_amount"),
    ), order=("age_group", "-txn_count", "payment_method")),
    "4e": Report(("customer_tier",), (
        N, USERS, avg("avg_txn_value"), total("total_revenue", "amount", OK), FAILURE,
        total("total_cashback_given", "cashback_earned"),
    ), order=("-total_revenue", "customer_tier")),
    "4f": Report(("spending_persona",), (
        distinct("users", "user_id"), N, avg("avg_txn_amount"),
        total("total_spent", "amount", OK),
        per("spend_per_user", total("s", "amount", OK), USERS, places=2),
    ), order=("-spend_per_user", "spending_persona")),
    "6d": Report(("customer_tier",), (
        N, rows("flagged_count", FLAGGED), rate("flag_rate_pct", FLAGGED, places=2),
    ), order=("-flag_rate_pct", "customer_tier")),
}


def report(name: str, transactions: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """Run a catalogue report by its label (``1a`` … ``8c``, ``v1``, ``v2``)."""
    if name == "4a":
        return segments(transactions)
    if name == "4b":
        return top_spenders(transactions, profiles)
    if name in PROFILE_REPORTS:
        users = Dimension(profile_columns(profiles), "user_id")
        return run(PROFILE_REPORTS[name], transactions, [users])
    return run(REPORTS[name], transactions)


# The columns of the view, in its order.
CLEAN_VIEW = [
    "transaction_id", "user_id", "transaction_datetime", "txn_date", "txn_hour", "day_of_week",
    "txn_month", "month_name", "txn_quarter", "payment_method", "category", "merchant",
    "platform", "device_type", "city", "amount", "amount_bucket", "discount_applied",
    "cashback_earned", "total_savings", "net_amount", "status", "failure_reason",
    "processing_time_sec", "processing_speed", "is_weekend", "is_flagged", "fraud_reason",
    "is_refunded", "refund_amount", "age_group", "gender", "account_tenure", "customer_tier",
    "spending_persona", "preferred_method", "user_home_city", "season_type", "time_slot",
]


def clean_view(cleaned: DataFrame, profiles: DataFrame) -> DataFrame:
    """The denormalised 39-column view of cleaned transactions and profiles."""
    ts = "transaction_datetime"
    wide = derive.add_generated_columns(cleaned).withColumnRenamed(
        "txn_day_of_week", "day_of_week"
    ).withColumns({
        "month_name": F.date_format(ts, "MMMM"),
        "season_type": derive.season_type(ts),
    })
    return with_profiles(wide, profiles, "left").select(*CLEAN_VIEW)
