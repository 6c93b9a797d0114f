"""Typing and cleaning of the two base tables.

Every rule is a column expression of one input row, so a whole cleaning pass is a
single projection over the scan.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which text columns each rule set trims
SQL_TRIM = ["payment_method", "category", "merchant", "city", "platform", "device_type",
            "failure_reason", "fraud_reason"]
PROFILE_TRIM = ["city", "age_group", "gender"]
PIPELINE_STRIP = ["transaction_id", "user_id", "payment_method", "category", "merchant",
                  "status", "failure_reason", "platform", "device_type", "city",
                  "fraud_reason"]
NUMERIC = {"amount": "decimal(12,2)", "processing_time_sec": "decimal(5,2)",
           "cashback_earned": "decimal(10,2)", "discount_applied": "decimal(10,2)",
           "refund_amount": "decimal(12,2)"}
REASONS = ["failure_reason", "fraud_reason"]
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
               "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
MISSING_REASON = "Unknown"
NO_REASON = "None"


def coerce_types(raw: DataFrame) -> DataFrame:
    """Text columns to their types; what cannot be read becomes NULL."""
    columns = {"transaction_datetime": F.col("transaction_datetime").try_cast("timestamp_ntz")}
    for name, kind in NUMERIC.items():
        columns[name] = F.col(name).try_cast(kind)
    for name in ("is_flagged", "is_refunded"):
        columns[name] = F.col(name).try_cast("boolean")
    columns["is_weekend"] = F.col("is_weekend").try_cast("int")
    return raw.withColumns(columns)


def _text_columns(df: DataFrame, wanted) -> list:
    text = {name for name, kind in df.dtypes if kind == "string"}
    return [c for c in wanted if c in text]


def strip_text(t: DataFrame) -> DataFrame:
    """Remove every kind of white space around the text columns.

    A character-set trim looks at the ends only, where a pattern would scan the text.
    """
    return t.withColumns({
        c: F.btrim(c, F.lit(WHITE_SPACE)) for c in _text_columns(t, PIPELINE_STRIP)
    })


def trim_spaces(t: DataFrame) -> DataFrame:
    """Remove spaces, and only spaces, around the text columns."""
    return t.withColumns({c: F.trim(c) for c in _text_columns(t, SQL_TRIM)})


def clean_profiles(u: DataFrame) -> DataFrame:
    return u.withColumns({c: F.trim(c) for c in _text_columns(u, PROFILE_TRIM)})


def failure_reason_fixed() -> Column:
    """A failure without a reason is Unknown; a success loses the one it has."""
    reason, status = F.col("failure_reason"), F.col("status")
    missing = reason.isNull() | (reason == "")
    return (
        F.when((status == "Failed") & missing, F.lit(MISSING_REASON))
        .when((status == "Success") & (reason != ""), F.lit(None).cast("string"))
        .otherwise(reason)
    )


def fraud_reason_fixed() -> Column:
    return F.when(F.col("is_flagged") | F.col("is_flagged").isNull(), F.col("fraud_reason"))


def refund_fixed() -> tuple[Column, Column]:
    """(is_refunded, refund_amount): withdrawn unless Success, then capped at the amount."""
    refunded, refund = F.col("is_refunded"), F.col("refund_amount")
    withdrawn = (F.col("status") != "Success") & refunded
    keep = F.when(withdrawn, F.lit(False)).otherwise(refunded)
    capped = (
        F.when(withdrawn, F.lit(0))
        .when(refunded & (refund > F.col("amount")), F.col("amount"))
        .otherwise(refund)
    ).cast("decimal(12,2)")
    return keep, capped


def clean(t: DataFrame) -> DataFrame:
    """All repairs of the SQL layer, in their order: reasons, refunds, then trimming."""
    refunded, refund = refund_fixed()
    fixed = t.withColumns({
        "failure_reason": failure_reason_fixed(),
        "fraud_reason": fraud_reason_fixed(),
        "is_refunded": refunded,
        "refund_amount": refund,
    })
    return trim_spaces(fixed)


def fill_reasons(t: DataFrame, text=NO_REASON) -> DataFrame:
    """Export form: NULL reasons written as text."""
    return t.fillna(text, subset=[c for c in REASONS if c in t.columns])


def blank_reasons(t: DataFrame, text=NO_REASON) -> DataFrame:
    """The inverse of :func:`fill_reasons`, applied on reading an export back."""
    return t.withColumns({
        c: F.nullif(F.col(c), F.lit(text)) for c in REASONS if c in t.columns
    })
