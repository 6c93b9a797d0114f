"""Exploratory aggregates over the enriched rows; groups with a missing label are dropped."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions import derive
from tallyspark.functions.measures import (
    BAD, FLAGGED, OK, PENDING, REFUNDED, distinct, mean, per, rate, rows, total,
)
from tallyspark.functions.rates import plain_ratio
from tallyspark.operators.aggregate import Dimension, Report, mentions, run
from tallyspark.operators.joins import profile_columns

COUNT = rows("count")
TXNS = rows("txn_count")
SUCCESS = rate("success_rate", OK)
AVG = mean("avg_amount", "amount")
VOLUME = total("total_volume", "amount")
USERS = distinct("unique_users", "user_id")
HEATMAP = tuple(rows(f"h{h:02d}", f"hour = {h}") for h in range(24))


def _report(*keys, measures, **kw):
    return Report(keys, measures, keep_null_keys=False, **kw)


REPORTS = {
    "1": Report(measures=(
        rows("total_transactions"), rate("success_rate", OK),
        total("total_volume", "amount", OK, zero=False), USERS,
        mean("avg_txn_value", "amount", OK), rows("fraud_flags", FLAGGED),
        rate("fraud_pct", FLAGGED), rows("refunds", REFUNDED), rate("refund_pct", REFUNDED),
        total("total_savings", "total_savings"),
    )),
    "2": _report("month", measures=(TXNS, rows("success_count", OK), VOLUME,
                                    rate("success_rate", OK, places=2)), order=("month",)),
    "3": _report("payment_method", measures=(COUNT, SUCCESS, AVG),
                 order=("count", "payment_method")),
    "4": _report("day_name", measures=HEATMAP, fixed=("day_name", schemas.WEEKDAYS, ())),
    "5": _report("category", measures=(COUNT, VOLUME, AVG), order=("count", "category")),
    "6a": _report("failure_reason", measures=(COUNT,), where=BAD,
                  order=("-count", "failure_reason"), limit=10),
    "6b": _report("payment_method", measures=(rate("failure_rate", BAD),),
                  order=("failure_rate", "payment_method")),
    "7": _report("payment_method", measures=(total("total_lost", "amount"), rows("fail_count"),
                                             mean("avg_lost", "amount")), where=BAD,
                 order=("-total_lost", "payment_method")),
    "11": _report("city", measures=(TXNS, SUCCESS, AVG, VOLUME), order=("-txn_count", "city")),
    "12a": _report("platform", measures=(COUNT, SUCCESS), order=("-count", "platform")),
    "12b": _report("device_type", measures=(COUNT, AVG), order=("-count", "device_type")),
    "13a": _report("fraud_reason", measures=(COUNT,), where=FLAGGED,
                   order=("-count", "fraud_reason")),
    "14a": _report("payment_method", measures=(total("total", "cashback_earned"), COUNT),
                   where="cashback_earned > 0", order=("-total", "payment_method")),
    "14b": _report("category", measures=(total("total", "discount_applied"), COUNT),
                   where="discount_applied > 0", order=("-total", "category")),
    "15a": _report("category", measures=(rows("refund_count"),
                                         total("total_refunded", "refund_amount")),
                   where=REFUNDED, order=("-refund_count", "category")),
    "15b": _report(("refund_type", derive.refund_type), measures=(COUNT,), where=REFUNDED,
                   order=("-count", "refund_type")),
    "16": _report("is_weekend", ("day_type", derive.day_type),
                  measures=(TXNS, AVG, SUCCESS, VOLUME), order=("is_weekend",)),
    "17a": _report("payment_method", measures=(mean("avg_processing_time",
                                                    "processing_time_sec"),),
                   where=OK, order=("avg_processing_time", "payment_method")),
    "17b": _report("processing_speed", measures=(COUNT,), where="status != 'Failed'",
                   fixed=("processing_speed", schemas.SPEEDS, ("count",))),
}

PROFILE_REPORTS = {
    "8": _report("age_group", measures=(TXNS, USERS, AVG, SUCCESS),
                 order=("age_group",), levels={"age_group": schemas.AGE_GROUPS}),
    "9": _report("customer_tier", measures=(
        TXNS, total("revenue", "amount", OK), AVG, SUCCESS, total("cashback", "cashback_earned"),
    ), order=("customer_tier",), levels={"customer_tier": schemas.TIERS}),
    "10": _report("spending_persona", measures=(
        distinct("users", "user_id"), TXNS, AVG, total("total_spend", "amount"),
        per("spend_per_user", total("s", "amount"), USERS),
    ), where=OK, order=("spending_persona",), levels={"spending_persona": schemas.PERSONAS}),
}


def users_of(profiles: DataFrame) -> Dimension:
    return Dimension(profile_columns(profiles), "user_id", how="left")


def run_over(report_: Report, rows_: DataFrame, dimensions=()) -> DataFrame:
    """Run a report over enriched rows, or over stripped ones that lack a feature it uses."""
    return run(report_, derive.add_features_in(rows_, mentions(report_)), dimensions)


def report(name: str, rows_: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    if name in PROFILE_REPORTS:
        return run_over(PROFILE_REPORTS[name], rows_, [users_of(profiles)])
    return run_over(REPORTS[name], rows_)


# What leads a finding: (key, order figure, shown figure).
LEADERS = {"_method": ("payment_method", "success_pct"), "_reason": ("failure_reason", "failed"),
           "_fraud": ("fraud_reason", "flagged"), "_category": ("category", "refunds")}


def _leader(key, figure):
    """(label, value) of the group with the highest figure above nothing; ties go to the first."""
    level = F.col(key).isNotNull() & ~F.col(f"all_{key}") & (F.col(figure) > 0)
    best = F.min(F.when(level, F.struct((-F.col(figure)).alias("_rank"), F.col(key).alias("label"),
                                        F.col(figure).alias("value"))))
    return F.struct(best["label"].alias("label"), best["value"].alias("value"))


def findings(rows_: DataFrame, profiles: DataFrame) -> DataFrame:
    """The figures of the written findings report on one row.

    One pass gives every global figure and every leader, as the grand total and the one-key
    margins of a report; a second one, reduced to users, gives the demographic figures.
    """
    figures = (
        rows("total_transactions"),
        rows("successful", OK), rate("success_pct", OK),
        rows("failed", BAD), rate("failed_pct", BAD),
        rows("pending", PENDING), rate("pending_pct", PENDING),
        total("success_volume", "amount", OK, zero=False),
        rows("upi_count", "payment_method = 'UPI'"), rate("upi_pct", "payment_method = 'UPI'"),
        rate("net_banking_failure_pct", f"payment_method = 'Net Banking' AND {BAD}",
             "payment_method = 'Net Banking'"),
        rows("weekend", "is_weekend = 1"), rate("weekend_pct", "is_weekend = 1"),
        total("lost_revenue", "amount", BAD, zero=False),
        rows("with_cashback", "cashback_earned > 0"),
        rows("with_discount", "discount_applied > 0"),
        total("total_savings", "total_savings"),
        mean("avg_savings_pct", "savings_pct", "total_savings > 0"),
        rows("flagged", FLAGGED), rate("flagged_pct", FLAGGED),
        rows("refunds", REFUNDED), rate("refund_pct", REFUNDED),
        total("refund_value", "refund_amount"),
        rate("mobile_app_pct", "platform = 'Mobile App'"),
        rows("android", "device_type = 'Android'"), rows("ios", "device_type = 'iOS'"),
    )
    keys = tuple(key for key, _ in LEADERS.values())
    levels = run_over(Report(keys, figures, margins=((), *[(k,) for k in keys]), detail=False), rows_)
    grand = F.lit(True)
    for key in keys:
        grand = grand & F.col(f"all_{key}")
    counts = {m.name for m in figures if m.bottom is None and m.top.kind == "rows"}

    def of_all(name):
        value = F.max(F.when(grand, F.col(name)))
        return (F.coalesce(value, F.lit(0)) if name in counts else value).alias(name)

    base = levels.agg(*[of_all(m.name) for m in figures],
                      *[_leader(key, figure).alias(name) for name, (key, figure) in LEADERS.items()])
    people = run_over(Report(("age_group", "customer_tier", "spending_persona"), (
        rows("n"), total("volume", "amount", exact=True), rows("n_amount", "amount IS NOT NULL"),
        distinct("users", "user_id"),
    )), rows_, [users_of(profiles)])
    spender = F.col("spending_persona") == "High Spender"

    def part(condition, column):
        return F.sum(F.when(condition, F.col(column)))

    people = people.agg(F.struct(
        (F.coalesce(part(F.col("age_group") == "25-34", "n"), F.lit(0)).cast("double")
         / F.sum("n") * 100).alias("age_25_34_pct"),
        plain_ratio(part(spender, "volume"), part(spender, "n_amount"))
         .alias("high_spender_avg"),
        # A user has one profile, so users of different groups are different users.
        F.coalesce(F.sum("users"), F.lit(0)).alias("users"),
        F.coalesce(part(F.col("customer_tier") == "VIP", "users"), F.lit(0)).alias("vip_users"),
    )).scalar()
    return base.select("*", people.alias("_people")).select(
        "total_transactions", "_people.users", *[m.name for m in figures[1:]],
        F.col("_method.label").alias("best_method"),
        F.col("_method.value").alias("best_method_success_pct"),
        F.col("_reason.label").alias("top_failure_reason"),
        F.col("_fraud.label").alias("top_fraud_reason"),
        F.col("_category.label").alias("top_refund_category"),
        "_people.age_25_34_pct", "_people.high_spender_avg", "_people.vip_users",
    )
