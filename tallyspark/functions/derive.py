"""Derived columns of a transaction, as column builders.

Band tables are lists of (exclusive or inclusive upper bound, label).  Where the
same idea is defined in more than one way, every definition is a named rule set.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas

# ---------------------------------------------------------------------------
# Bands and labels
# ---------------------------------------------------------------------------
AMOUNT_BANDS = [
    (100, "Micro (<₹100)"),
    (500, "Small (₹100-500)"),
    (2000, "Medium (₹500-2K)"),
    (10000, "Large (₹2K-10K)"),
    (50000, "High (₹10K-50K)"),
    (None, "Premium (₹50K+)"),
]
WORKBOOK_AMOUNT_BANDS = [
    (500, "Micro (<500)"),
    (2000, "Small (500-2K)"),
    (5000, "Medium (2K-5K)"),
    (10000, "Large (5K-10K)"),
    (50000, "High Value (10K+)"),
]
# hour -> slot: (first hour, last hour, label); hours outside every range get the last label
TIME_SLOTS = {
    "sql": [(5, 11, "Morning"), (12, 16, "Afternoon"), (17, 21, "Evening"), "Night"],
    "pipeline": [(5, 11, "Morning"), (12, 16, "Afternoon"), (17, 20, "Evening"), "Night"],
    "workbook": [(6, 11, "Morning"), (12, 16, "Afternoon"), (17, 21, "Evening"), "Night"],
    "fraud5": [
        (0, 4, "Late Night (12-5 AM)"),
        (5, 11, "Morning (5 AM-12 PM)"),
        (12, 16, "Afternoon (12-5 PM)"),
        (17, 21, "Evening (5-10 PM)"),
        "Night (10 PM-12 AM)",
    ],
}
SPEED_BANDS = [(1, "Instant"), (2, "Fast"), (5, "Normal"), (15, "Slow"), (None, "Very Slow")]
SAVINGS_BANDS = [
    (200, "Low Savings (<₹200)"),
    (500, "Medium Savings (₹200-500)"),
    (None, "High Savings (₹500+)"),
]
NO_SAVINGS = "No Promotion"
SEGMENT_BANDS = [
    (20, "Power User (20+)"),
    (10, "Regular User (10-19)"),
    (5, "Occasional User (5-9)"),
    (None, "Rare User (1-4)"),
]
SPENDING_TIER_BANDS = [(10000, "Low"), (50000, "Medium"), (200000, "High"), (None, "Very High")]
FESTIVAL_MONTHS = [10, 11]
SALE_MONTHS = [1, 8, 12]
MONTH_END_FROM, MONTH_START_TO = 26, 5
FULL_REFUND_RATIO = {"exact": "1.00", "tolerant": "0.99"}
CLIP_AMOUNT = 50000
# (threshold for the good band, threshold for the warning band, higher is better)
STATUS_BANDS = {
    "success": (95, 90, ">="),
    "fraud": (2, 5, "<="),
    "dashboard_success": (90, 85, ">"),
    "chart_success": (92, 88, ">"),
    "chart_failure": (5, 8, "<="),
}
UNITS = {"crore": (10_000_000, " Cr"), "lakh": (100_000, " L"), "thousand": (1_000, " K")}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _chain(pairs, default=None) -> Column:
    """First label whose condition holds, else ``default``."""
    out = None
    for condition, label in pairs:
        label = F.lit(label)
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out if default is None else out.otherwise(F.lit(default))


def bands(value, table, closed="left") -> Column:
    """Label of the first band above ``value``.

    ``left``: a bound belongs to the band it opens (``<``); ``right``: to the band it
    closes (``<=``).  A value past the last bound gets the open label, or NULL.
    """
    value = _col(value)
    test = (lambda b: value < F.lit(b)) if closed == "left" else (lambda b: value <= F.lit(b))
    tail = next((label for bound, label in table if bound is None), None)
    return _chain([(test(b), label) for b, label in table if b is not None], tail)


# ---------------------------------------------------------------------------
# Amounts
# ---------------------------------------------------------------------------
def amount_bucket(amount="amount", rule="sql") -> Column:
    amount = _col(amount)
    if rule == "workbook":
        # Nothing at or below zero, nothing above the last bound.
        return F.when(amount > 0, bands(amount, WORKBOOK_AMOUNT_BANDS, closed="right"))
    return bands(amount, AMOUNT_BANDS)


def total_savings() -> Column:
    return F.col("cashback_earned") + F.col("discount_applied")


def net_amount() -> Column:
    net = F.col("amount") - F.col("discount_applied") - F.col("cashback_earned")
    # greatest() would skip a NULL and turn it into 0.
    return F.when(net.isNotNull(), F.greatest(net, F.lit(0))).cast("decimal(12,2)")


def savings_pct() -> Column:
    share = F.round(total_savings() * 100 / F.nullif(F.col("amount"), F.lit(0)), 2)
    # One dirty row (savings far above the amount) must not stop a job: it has no percentage.
    return F.when(F.col("amount") > 0, share).otherwise(F.lit(0)).try_cast("decimal(12,2)")


def savings_tier() -> Column:
    saved = total_savings()
    return F.when(saved == 0, F.lit(NO_SAVINGS)).otherwise(bands(saved, SAVINGS_BANDS))


def clipped_amount(limit=CLIP_AMOUNT) -> Column:
    return F.when(F.col("amount").isNotNull(), F.least(F.col("amount"), F.lit(limit))).cast(
        "decimal(12,2)"
    )


def in_units(value, unit) -> Column:
    """``value`` divided by a crore, a lakh or a thousand."""
    return _col(value).cast("double") / F.lit(float(UNITS[unit][0]))


def unit_text(value, unit, sign="") -> Column:
    """Text such as ``12.34 Cr``; rounded half up before formatting."""
    size, suffix = UNITS[unit]
    scaled = F.round(_col(value).cast("decimal(24,2)") / F.lit(size), 2).cast("decimal(24,2)")
    return F.concat(F.lit(sign), scaled.cast("string"), F.lit(suffix))


TS = "transaction_datetime"


# ---------------------------------------------------------------------------
# Time
# ---------------------------------------------------------------------------
def time_slot(hour, rule="sql") -> Column:
    hour = _col(hour)
    *ranges, rest = TIME_SLOTS[rule]
    return _chain([(hour.between(a, b), label) for a, b, label in ranges], rest)


def is_festival_season(ts="transaction_datetime") -> Column:
    return F.month(ts).isin(FESTIVAL_MONTHS).cast("int")


def is_month_start(ts=TS) -> Column:
    return (F.day(ts) <= MONTH_START_TO).cast("int")


def is_month_end(ts=TS) -> Column:
    return (F.day(ts) >= MONTH_END_FROM).cast("int")


def season_type(ts="transaction_datetime") -> Column:
    month = F.month(ts)
    return _chain(
        [(month.isin(FESTIVAL_MONTHS), "Festival Season"), (month.isin(SALE_MONTHS), "Sale Season")],
        "Normal",
    )


def _named(position, names) -> Column:
    """The name at a position from 1; a lookup costs far less than formatting a date."""
    quoted = ", ".join(f"'{n}'" for n in names)
    return F.expr(f"element_at(array({quoted}), {position})")


def day_name(ts="transaction_datetime") -> Column:
    return _named(f"weekday({ts}) + 1", schemas.WEEKDAYS)


def month_name(ts="transaction_datetime") -> Column:
    return _named(f"month({ts})", schemas.MONTHS)


def year_month(ts="transaction_datetime") -> Column:
    return F.date_format(ts, "yyyy-MM")


# Report keys that group on a date and are written out once per group.
def month_key(name):
    return (name, "trunc(transaction_datetime, 'MM')", "date_format({}, 'yyyy-MM')")


def date_key(date) -> Column:
    return F.expr(f"year({date}) * 10000 + month({date}) * 100 + day({date})")


def day_type(is_weekend="is_weekend") -> Column:
    return F.when(F.col(is_weekend) == 1, F.lit("Weekend")).otherwise(F.lit("Weekday"))


# ---------------------------------------------------------------------------
# Status, users, refunds, risk
# ---------------------------------------------------------------------------
def processing_speed() -> Column:
    return F.when(F.col("status") == "Failed", F.lit("Failed")).otherwise(
        bands("processing_time_sec", SPEED_BANDS, closed="right")
    )


def status_flags() -> dict:
    return {
        "is_success": (F.col("status") == "Success").cast("int"),
        "is_failed": (F.col("status") == "Failed").cast("int"),
        "is_pending": (F.col("status") == "Pending").cast("int"),
        "is_flagged_int": F.col("is_flagged").cast("int"),
        "is_refunded_int": F.col("is_refunded").cast("int"),
    }


def user_segment(count="txn_count") -> Column:
    count = _col(count)
    tail = SEGMENT_BANDS[-1][1]
    return _chain([(count >= b, label) for b, label in SEGMENT_BANDS[:-1]], tail)


def user_spending_tier(spend="user_total_spend") -> Column:
    return bands(spend, SPENDING_TIER_BANDS)


def is_full_refund(rule="exact") -> Column:
    refund, amount = F.col("refund_amount"), F.col("amount")
    if rule == "exact":
        return refund == amount
    return refund >= amount * F.lit(FULL_REFUND_RATIO[rule]).cast("decimal(3,2)")


def refund_type(rule="tolerant") -> Column:
    return F.when(is_full_refund(rule), F.lit("Full Refund")).otherwise(F.lit("Partial Refund"))


def flag_label() -> Column:
    return F.when(F.col("is_flagged"), F.lit("Flagged")).when(~F.col("is_flagged"), F.lit("Normal"))


def status_band(value, rule) -> Column:
    """``good`` / ``warn`` / ``bad`` for a rate."""
    value = _col(value)
    good, warn, sign = STATUS_BANDS[rule]
    test = {">=": lambda b: value >= b, ">": lambda b: value > b, "<=": lambda b: value <= b}[sign]
    return _chain([(test(good), "good"), (test(warn), "warn")], "bad")


def screening_reason() -> Column:
    """The deterministic risk rules: the late-night rule outranks the amount rule."""
    limit = F.lit(schemas.DEFAULT_HIGH_AMOUNT)
    for category, threshold in schemas.HIGH_AMOUNT_THRESHOLDS.items():
        limit = F.when(F.trim("category") == category, F.lit(threshold)).otherwise(limit)
    late = (F.hour("transaction_datetime") <= 4) & (F.col("amount") > schemas.LATE_NIGHT_AMOUNT)
    return F.when(late, F.lit(schemas.LATE_NIGHT_REASON)).when(
        F.col("amount") > limit, F.lit(schemas.HIGH_AMOUNT_REASON)
    )


# ---------------------------------------------------------------------------
# Row-level groups of columns
# ---------------------------------------------------------------------------
def add_generated_columns(t: DataFrame) -> DataFrame:
    """The eleven stored columns of the SQL layer."""
    ts = "transaction_datetime"
    return t.withColumns({
        "txn_date": F.to_date(ts),
        "txn_hour": F.hour(ts),
        "txn_day_of_week": day_name(ts),
        "txn_month": year_month(ts),
        "txn_quarter": F.quarter(ts),
        "amount_bucket": amount_bucket(),
        "time_slot": time_slot(F.hour(ts), "sql"),
        "net_amount": net_amount(),
        "total_savings": total_savings(),
        "is_festival_season": is_festival_season(ts),
        "processing_speed": processing_speed(),
    })


# Every feature of the enriched table that needs only the transaction itself.
ROW_FEATURES = {
    "date": lambda: F.to_date(TS),
    "year": lambda: F.year(TS),
    "month": lambda: F.month(TS),
    "month_name": month_name,
    "quarter": lambda: F.quarter(TS),
    "quarter_label": lambda: F.concat(F.lit("Q"), F.quarter(TS)),
    "day": lambda: F.day(TS),
    "day_of_week": lambda: F.weekday(TS),
    "day_name": day_name,
    "hour": lambda: F.hour(TS),
    "time_bucket": lambda: time_slot(F.hour(TS), "pipeline"),
    "week_number": lambda: F.weekofyear(TS),
    "is_month_start": is_month_start,
    "is_month_end": is_month_end,
    "is_festival_season": is_festival_season,
    "amount_bucket": amount_bucket,
    "net_amount": net_amount,
    "total_savings": total_savings,
    "savings_pct": savings_pct,
    "processing_speed": processing_speed,
}


def add_row_features(t: DataFrame, names=None) -> DataFrame:
    """All row features, or the named ones."""
    return t.withColumns({n: ROW_FEATURES[n]() for n in (names or ROW_FEATURES)})


def add_features_in(t: DataFrame, text: str) -> DataFrame:
    """The row features that ``text`` mentions and ``t`` does not carry yet."""
    words = set(re.findall(r"\w+", text)) - set(t.columns)
    names = [n for n in ROW_FEATURES if n in words]
    return add_row_features(t, names) if names else t


def add_screening(t: DataFrame) -> DataFrame:
    return t.withColumn("rule_reason", screening_reason()).withColumn(
        "rule_flag", F.col("rule_reason").isNotNull()
    )
