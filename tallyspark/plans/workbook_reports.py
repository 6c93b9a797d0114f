"""Tables of the spreadsheet report, over the raw transactions; rates are fractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions import derive
from tallyspark.functions.measures import (
    BAD, OK, PENDING, Term, distinct, mean, per, rate, rows, total,
)
from tallyspark.operators.aggregate import Report, Share, run
from tallyspark.operators.users import segments, user_activity

MONTH = derive.month_key("month")
HOUR = ("hour", "hour(transaction_datetime)")
TOTAL = rows("total")
SUCCESS = rate("success_rate", OK, scale=1)
AVG = mean("avg_amt", "amount")
VOLUME = total("volume", "amount")
USERS = distinct("unique_users", "user_id")


def _report(*keys, measures, **kw):
    return Report(keys, measures, keep_null_keys=False, **kw)


KPIS = Report(measures=(
    rows("total_transactions"), rows("successful", OK), rows("failed", BAD),
    rows("pending", PENDING), SUCCESS, rate("failure_rate", BAD, scale=1),
    total("successful_volume", "amount", OK, zero=False), mean("avg_value", "amount"), USERS,
    per("txn_per_user", rows("n"), USERS), total("lost_revenue", "amount", BAD, zero=False),
))

REPORTS = {
    "2": _report("payment_method", measures=(rows("txn_count"), rows("success", OK), AVG, SUCCESS),
                 order=("-success_rate", "payment_method")),
    "3": _report(MONTH, measures=(TOTAL, rows("success", OK), rows("failed", BAD), VOLUME,
                                  SUCCESS), order=("month",)),
    "4": _report("city", measures=(TOTAL, rows("success", OK), AVG, SUCCESS),
                 order=("-total", "city")),
    "5": _report(HOUR, ("hour_label", "hour(transaction_datetime)", "concat(lpad({}, 2, '0'), ':00')"),
                 measures=(TOTAL, VOLUME, AVG, SUCCESS), order=("hour",)),
    "6": _report(("day_name", derive.day_name), measures=(TOTAL, VOLUME, SUCCESS),
                 fixed=("day_name", schemas.WEEKDAYS, ())),
    "7": _report(("time_slot", lambda: derive.time_slot(F.hour("transaction_datetime"),
                                                        "workbook")),
                 measures=(TOTAL, VOLUME, SUCCESS), order=("time_slot",),
                 levels={"time_slot": schemas.TIME_BUCKETS}),
    "8": _report("failure_reason", measures=(
        rows("count"), AVG, mean("avg_proc", "processing_time_sec"),
    ), where=f"{BAD} AND failure_reason IS NOT NULL",
        shares=(Share("pct", Term("rows"), scale=1, places=None),),
        order=("-count", "failure_reason")),
    "9": _report("payment_method", measures=(
        rows("failed_count"), total("lost_revenue", "amount"), mean("avg_failed_amt", "amount"),
    ), where=BAD, order=("-lost_revenue", "payment_method")),
    "10": Report(measures=(
        total("total_lost", "amount", BAD, zero=False), mean("avg_lost", "amount", BAD),
    )),
    "12": _report(MONTH, measures=(
        distinct("active_users", "user_id"), rows("total_txn"),
        per("txn_per_user", rows("n"), USERS),
    ), order=("month",)),
}


def kpis(t: DataFrame) -> DataFrame:
    """(kpi, value) from one pass."""
    wide = run(KPIS, t)
    return wide.select(*[F.col(c).cast("double").alias(c) for c in wide.columns]).unpivot(
        [], wide.columns, "kpi", "value"
    )


def report(name: str, t: DataFrame) -> DataFrame:
    if name == "1":
        return kpis(t)
    if name == "11":
        return segments(t, places=False)
    if name == "13":
        return top_users(t)
    return run(REPORTS[name], t)


def top_users(t: DataFrame, n=15) -> DataFrame:
    return user_activity(t).orderBy(F.desc("total_spent"), "user_id").limit(n)
