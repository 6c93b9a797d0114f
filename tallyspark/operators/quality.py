"""Data-quality checks; each returns rows rather than printing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions.derive import day_name
from tallyspark.functions.measures import (
    BAD, FLAGGED, OK, REFUNDED, Term, mean, rate, rows, total,
)
from tallyspark.operators.aggregate import Dimension, Report, Share, run
from tallyspark.operators.joins import orphan_ids, orphan_rows

CRITICAL = {"null_txn_id": "transaction_id", "null_user_id": "user_id",
            "null_amount": "amount", "null_status": "status", "null_device": "device_type"}

# condition of a faulty row, by check
FAULTS = {
    "invalid_amounts": "amount <= 0",
    "missing_reasons": f"{BAD} AND (failure_reason IS NULL OR failure_reason = '')",
    "incorrect_reasons": f"{OK} AND failure_reason IS NOT NULL AND failure_reason != ''",
    "negative_cashback": "cashback_earned < 0",
    "negative_discount": "discount_applied < 0",
    "invalid_refunds": "is_refunded AND status != 'Success'",
    "over_refunds": "is_refunded AND refund_amount > amount",
    "invalid_fraud_reasons": "NOT is_flagged AND fraud_reason IS NOT NULL AND fraud_reason != ''",
}


def _in(column, values):
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


# condition every row must meet (or leave unknown), by rule
TRANSACTION_RULES = {
    "status_domain": _in("status", schemas.STATUSES),
    "amount_positive": "amount > 0",
    "processing_positive": "processing_time_sec > 0",
    "cashback_not_negative": "cashback_earned >= 0",
    "discount_not_negative": "discount_applied >= 0",
    "refund_not_negative": "refund_amount >= 0",
}
PROFILE_RULES = {
    "age_group_domain": _in("age_group", schemas.AGE_GROUPS),
    "gender_domain": _in("gender", schemas.GENDERS),
    "tier_domain": _in("customer_tier", schemas.TIERS),
    "persona_domain": _in("spending_persona", schemas.PERSONAS),
}


def row_counts(t: DataFrame, u: DataFrame) -> DataFrame:
    def one(name, df):
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
    return one("user_profiles", u).unionByName(one("transactions", t))


def critical_nulls(t: DataFrame) -> DataFrame:
    return t.agg(*[F.count_if(F.col(c).isNull()).alias(n) for n, c in CRITICAL.items()])


def orphan_count(t: DataFrame, u: DataFrame, name="orphan_transactions") -> DataFrame:
    """Rows without a profile; counted per user first so that the join moves users."""
    per_user = t.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return orphan_rows(per_user, u).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def orphan_id_count(t: DataFrame, u: DataFrame) -> DataFrame:
    return orphan_ids(t, u).agg(F.count(F.lit(1)).alias("orphan_user_ids"))


def duplicate_ids(t: DataFrame) -> DataFrame:
    return (
        t.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)
    )


def duplicate_rows(t: DataFrame) -> DataFrame:
    """Rows beyond the first of each id; NULL ids count as one id."""
    per_id = t.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("cnt"))
    return per_id.agg(F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).alias("duplicate_rows"))


def statuses(t: DataFrame) -> DataFrame:
    return t.select("status").distinct()


def fault_counts(t: DataFrame, *names) -> DataFrame:
    """One column per named fault, one pass over the rows."""
    return t.agg(*[F.count_if(F.expr(FAULTS[n])).alias(n) for n in (names or FAULTS)])


def future_dated(t: DataFrame, as_of=None) -> DataFrame:
    """Rows later than ``as_of`` (a timestamp literal); the clock when it is None."""
    limit = F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp()
    return t.agg(F.count_if(F.col("transaction_datetime") > limit).alias("future_txn"))


def device_platforms(t: DataFrame) -> DataFrame:
    return t.select("device_type", "platform").distinct().orderBy("platform", "device_type")


def weekend_by_day(t: DataFrame) -> DataFrame:
    return (
        t.groupBy("is_weekend", day_name().alias("day_name"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("is_weekend", "day_name")
    )


def scorecard(t: DataFrame) -> DataFrame:
    """The final check after cleaning: every column but the first should be 0."""
    return t.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.expr(f"failure_reason IS NULL AND {BAD}")).alias("failed_without_reason"),
        F.count_if(F.expr(f"failure_reason IS NOT NULL AND {OK}")).alias("success_with_reason"),
        F.count_if(F.expr(FAULTS["invalid_refunds"])).alias("invalid_refunds"),
        F.count_if(F.expr("refund_amount > amount")).alias("over_refunds"),
        F.count_if(F.expr(FAULTS["negative_cashback"])).alias("negative_cashback"),
        F.count_if(F.expr("NOT is_flagged AND fraud_reason IS NOT NULL"))
         .alias("orphan_fraud_reasons"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_null) for every column, plus their sum as ``TOTAL``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    whole = sum((F.col(c) for c in df.columns[1:]), F.col(df.columns[0]))
    return counts.withColumn("TOTAL", whole).unpivot(
        [], [*df.columns, "TOTAL"], "column_name", "n_null"
    )


def _violations(df: DataFrame, rules: dict) -> DataFrame:
    counts = df.agg(*[F.count_if(F.expr(f"NOT ({sql})")).alias(n) for n, sql in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n_violations")


def check_rules(t: DataFrame, u: DataFrame) -> DataFrame:
    return _violations(u, PROFILE_RULES).unionByName(_violations(t, TRANSACTION_RULES))


def key_rules(t: DataFrame, u: DataFrame) -> DataFrame:
    """Primary keys, required columns and the foreign key as (rule, n_violations)."""
    def named(name, df, column):
        return df.select(F.lit(name).alias("rule"), F.col(column).alias("n_violations"))

    required = [c for c in schemas.TRANSACTION_REQUIRED if c in t.columns]
    out = _violations(t, {f"transaction_{c}_required": f"{c} IS NOT NULL" for c in required})
    out = out.unionByName(_violations(u, {f"profile_{c}_required": f"{c} IS NOT NULL"
                                          for c in u.columns}))
    out = out.unionByName(named("transaction_primary_key", duplicate_rows(t), "duplicate_rows"))
    users = u.withColumnRenamed("user_id", "transaction_id")
    out = out.unionByName(named("profile_primary_key", duplicate_rows(users),
                                "duplicate_rows"))
    return out.unionByName(named("transaction_user_fk", orphan_count(t, u),
                                 "orphan_transactions"))


def value_counts(df: DataFrame, columns) -> DataFrame:
    """(field, value, n) for several label columns in one pass over the rows."""
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "field", "value")
    return (
        long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
        .orderBy("field", F.desc("n"), "value")
    )


def ranges(t: DataFrame) -> DataFrame:
    return t.agg(
        F.min("transaction_datetime").alias("first_at"),
        F.max("transaction_datetime").alias("last_at"),
        F.min("amount").cast("double").alias("amount_min"),
        F.max("amount").cast("double").alias("amount_max"),
    )


def promotion_and_flag_profile(t: DataFrame) -> DataFrame:
    return run(Report(measures=(
        rows("flagged", FLAGGED), rate("flagged_pct", FLAGGED),
        rows("refunded", REFUNDED), rate("refunded_pct", REFUNDED),
        rows("with_cashback", "cashback_earned > 0"), total("cashback_total", "cashback_earned"),
        rows("with_discount", "discount_applied > 0"), total("discount_total", "discount_applied"),
        rows("success_without_reason", f"{OK} AND failure_reason IS NULL"),
        rows("failed_with_reason", f"{BAD} AND failure_reason IS NOT NULL"),
    )), t)


def savings_summary(e: DataFrame) -> DataFrame:
    return run(Report(measures=(
        rows("with_cashback", "cashback_earned > 0"),
        rows("with_discount", "discount_applied > 0"),
        total("total_savings", "total_savings"),
        mean("avg_savings_pct", "savings_pct", "total_savings > 0", places=2),
    )), e)


def feature_distributions(e: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Counts of the four banded features.

    The spending tier belongs to the user, so the transactions are counted per user and
    the tier is joined to those counts rather than to every transaction.
    """
    bands = value_counts(e, ["time_bucket", "amount_bucket", "processing_speed"])
    tier = Dimension(behaviour.select("user_id", "user_spending_tier"), "user_id", "left")
    tiers = run(Report(("user_spending_tier",), (rows("n"),)), e, [tier]).select(
        F.lit("user_spending_tier").alias("field"),
        F.col("user_spending_tier").alias("value"), "n",
    )
    return bands.unionByName(tiers)


def distribution(t: DataFrame, column: str, with_pct=True) -> DataFrame:
    share = (Share("pct", Term("rows")),) if with_pct else ()
    return run(Report(keys=(column,), measures=(rows("cnt"),), shares=share,
                      order=("-cnt", column)), t)


def profile_combinations(u: DataFrame, n=15) -> DataFrame:
    keys = ("age_group", "customer_tier", "spending_persona")
    return run(Report(keys=keys, measures=(rows("user_count"),),
                      order=("-user_count", *keys), limit=n), u)
