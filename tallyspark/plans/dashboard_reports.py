"""Aggregates of the interactive dashboard; each takes an already filtered table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions import derive
from tallyspark.functions.measures import (
    BAD, FLAGGED, OK, REFUNDED, distinct, mean, per, rate, rows, total,
)
from tallyspark.operators.aggregate import Report
from tallyspark.plans.eda_reports import HEATMAP, run_over, users_of

COUNT = rows("count")
SUCCESS = rate("sr", OK)
AVG = mean("avg_amt", "amount")
PROC = mean("avg_proc", "processing_time_sec")
FULL = "is_refunded AND refund_amount >= amount * cast(0.99 AS decimal(3,2))"


def _report(*keys, measures, **kw):
    return Report(keys, measures, keep_null_keys=False, **kw)


def label(year="year", month="month"):
    """``2024 Jan`` from a year and a month number."""
    return F.date_format(F.make_date(year, month, F.lit(1)), "yyyy MMM")


LABEL = (("label", "date_format(make_date(year, month, 1), 'yyyy MMM')"),)

REPORTS = {
    "1": Report(measures=(
        rows("total_txn"), rows("success_txn", OK), rate("success_rate", OK, empty=0.0),
        total("total_volume", "amount", OK, zero=False, empty=0.0),
        mean("avg_txn", "amount", OK, empty=0.0), distinct("unique_users", "user_id"),
        total("total_cashback", "cashback_earned", empty=0.0),
        rows("fraud_count", FLAGGED), rows("refund_count", REFUNDED),
    )),
    "2": _report("year", "month", measures=(
        rows("txn_count"), rows("success", OK), total("volume", "amount"),
        rate("success_rate", OK, places=1),
    ), order=("year", "month"), after=LABEL),
    "3": _report("payment_method", measures=(COUNT,), order=("-count", "payment_method")),
    "4": _report("category", measures=(total("revenue", "amount"),), where=OK,
                 order=("-revenue", "category")),
    "5": _report("city", measures=(COUNT,), order=("-count", "city")),
    "6": _report("day_name", measures=HEATMAP, fixed=("day_name", schemas.WEEKDAYS, ())),
    "7": _report("time_bucket", measures=(COUNT, AVG, SUCCESS),
                 fixed=("time_bucket", schemas.TIME_BUCKETS, ())),
    "8": _report("is_weekend", ("day_type", derive.day_type),
                 measures=(COUNT, AVG, total("volume", "amount"), SUCCESS),
                 order=("is_weekend",)),
    "9": _report("payment_method", measures=(
        COUNT, rate("success_rate", OK), mean("avg_amount", "amount"), PROC,
    ), order=("payment_method",)),
    "10": Report(measures=(
        rows("failed_txn", BAD), rate("failure_rate", BAD, empty=0.0),
        total("lost_revenue", "amount", BAD, zero=False, empty=0.0),
        mean("avg_failed", "amount", BAD, empty=0.0),
    )),
    "11": _report("failure_reason", measures=(COUNT,), where=BAD,
                  order=("-count", "failure_reason"), limit=10),
    "12": _report("payment_method", measures=(COUNT, total("lost", "amount")), where=BAD,
                  order=("-lost", "payment_method")),
    "13": _report("hour", measures=(rows("total"), rows("failed", BAD), rate("rate", BAD)),
                  order=("hour",)),
    "20": Report(measures=(
        rows("flagged_txn", FLAGGED), rate("flag_rate", FLAGGED, empty=0.0),
        mean("avg_flagged", "amount", FLAGGED, empty=0.0),
        total("flagged_volume", "amount", FLAGGED, zero=False, empty=0.0),
    )),
    "21": _report("fraud_reason", measures=(COUNT,), where=FLAGGED,
                  order=("-count", "fraud_reason")),
    "23": Report(measures=(
        rows("refunds", REFUNDED), rate("refund_rate", REFUNDED, empty=0.0),
        total("refund_value", "refund_amount", REFUNDED, zero=False, empty=0.0),
        rows("full_refunds", FULL), rate("full_refund_pct", FULL, REFUNDED, empty=0.0),
    )),
    "24": _report("category", measures=(COUNT, total("total", "refund_amount")),
                  where=REFUNDED, order=("-count", "category")),
    "25": _report("payment_method", measures=(COUNT, total("total", "refund_amount")),
                  where=REFUNDED, order=("-count", "payment_method")),
    "26": _report("platform", measures=(COUNT, SUCCESS, PROC), order=("platform",)),
    "27": _report("device_type", measures=(COUNT, AVG, SUCCESS),
                  order=("-count", "device_type")),
    "28": _report("device_type", measures=(
        rows("txn_count"), mean("avg_amount", "amount"), rate("success_rate", OK),
        total("total_volume", "amount"), PROC, total("cashback", "cashback_earned"),
        rows("flagged", FLAGGED),
    ), where="device_type IN ('Android', 'iOS')", order=("device_type",)),
    "29": _report("payment_method", measures=(total("total", "cashback_earned"), COUNT),
                  where="cashback_earned > 0", order=("-total", "payment_method")),
    "30": _report("category", measures=(total("total", "discount_applied"), COUNT),
                  where="discount_applied > 0", order=("-total", "category")),
    "19": _report("year", "month", measures=(
        distinct("mau", "user_id"), rows("txn_count"),
        per("txn_per_user", rows("n"), distinct("u", "user_id"), places=2),
    ), order=("year", "month"), after=LABEL),
}

PROFILE_REPORTS = {
    "15": _report("age_group", measures=(COUNT, AVG, distinct("users", "user_id")),
                  order=("age_group",), levels={"age_group": schemas.AGE_GROUPS}),
    "16": _report("customer_tier", measures=(
        COUNT, distinct("users", "user_id"), total("volume", "amount", OK, empty=0.0),
    ), order=("customer_tier",), levels={"customer_tier": schemas.TIERS}),
    "17": _report("spending_persona", measures=(
        AVG, total("total", "amount"), distinct("users", "user_id"),
        per("per_user", total("s", "amount"), distinct("u", "user_id")),
    ), where=OK, order=("spending_persona",), levels={"spending_persona": schemas.PERSONAS}),
    "18": _report("gender", measures=(COUNT, AVG), order=("gender",)),
}


def report(name: str, rows_: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    if name in PROFILE_REPORTS:
        return run_over(PROFILE_REPORTS[name], rows_, [users_of(profiles)])
    return run_over(REPORTS[name], rows_)


def festival_periods(rows_: DataFrame) -> DataFrame:
    """Years in which both festival months occur, with the labels of their ends."""
    first, last = derive.FESTIVAL_MONTHS
    seen = derive.add_features_in(rows_, "year month").groupBy("year").agg(
        F.max((F.col("month") == first).cast("int")).alias("_first"),
        F.max((F.col("month") == last).cast("int")).alias("_last"),
    )
    return seen.filter("_first = 1 AND _last = 1").select(
        "year", label("year", F.lit(first)).alias("from_label"),
        label("year", F.lit(last)).alias("to_label"),
    ).orderBy("year")


def failure_counts(rows_: DataFrame) -> DataFrame:
    """(payment_method, failure_reason, count) for every reason that occurs."""
    return run_over(_report("payment_method", "failure_reason", measures=(rows("count"),),
                            where=f"{BAD} AND failure_reason IS NOT NULL",
                            order=("payment_method", "failure_reason")), rows_)


def failure_crosstab(rows_: DataFrame, reasons=None, other="Other") -> DataFrame:
    """Method by failure reason: one column per listed reason and one for all the rest.

    The columns of a table have to be known beforehand; by default they are the reasons of the
    schema.  ``other`` makes the row sums equal the failed transactions with a reason.
    """
    if reasons is None:
        reasons = sorted({r for own in schemas.FAILURE_REASONS.values() for r in own})
    quoted = {r: r.replace("'", "\\'") for r in reasons}
    listed = ", ".join(f"'{q}'" for q in quoted.values())
    counts = (*(rows(r, f"failure_reason = '{q}'") for r, q in quoted.items()),
              rows(other, f"failure_reason NOT IN ({listed})"))
    return run_over(_report("payment_method", measures=counts,
                       where=f"{BAD} AND failure_reason IS NOT NULL",
                       order=("payment_method",)), rows_)


def mobile_comparison(rows_: DataFrame) -> DataFrame:
    """The two mobile systems side by side; empty unless both occur."""
    pair = report("28", rows_)
    both = F.count(F.lit(1)).over(Window.partitionBy())
    return pair.withColumn("_n", both).filter("_n = 2").drop("_n").orderBy("device_type")
