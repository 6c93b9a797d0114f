"""Per-user behaviour and the enriched table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.derive import add_row_features, user_segment, user_spending_tier
from tallyspark.functions.measures import BAD, OK, count_of, distinct, mean, rate, rows, total
from tallyspark.operators.aggregate import Report, run
from tallyspark.operators.clean import strip_text
from tallyspark.operators.joins import profile_columns
from tallyspark.schemas import ENRICHED_COLUMNS, SEGMENTS


def user_behaviour(t: DataFrame) -> DataFrame:
    """One row per user: count, Success spend, mean Success amount, failure rate, tier."""
    per_user = run(Report(keys=("user_id",), measures=(
        count_of("user_total_txns", "transaction_id"),
        total("user_total_spend", "amount", OK, exact=True),
        mean("user_avg_txn_amount", "amount", OK, places=2, empty=0.0),
        rate("user_failure_rate_pct", BAD, places=2),
    )), t)
    spend = F.coalesce("user_total_spend", F.lit(0)).cast("decimal(22,2)")
    return per_user.withColumn("user_total_spend", spend).withColumn(
        "user_spending_tier", user_spending_tier("user_total_spend")
    )


def user_table(t: DataFrame, u: DataFrame, behaviour: DataFrame | None = None) -> DataFrame:
    """Behaviour and profile of every user with a transaction, at user grain."""
    if behaviour is None:
        behaviour = user_behaviour(t)
    return behaviour.join(profile_columns(u), "user_id", "left")


def enrich(t: DataFrame, u: DataFrame, behaviour: DataFrame | None = None,
           users: DataFrame | None = None) -> DataFrame:
    """The 52-column enriched table.

    Profile and behaviour are put together at user grain first, so the transactions
    meet one join, not five.  ``users`` is a stored :func:`user_table`: with it both sides of
    the join are plain scans, and Spark splits a user that holds a large part of all rows
    (it cannot split below an aggregation).  Otherwise the table is built from ``behaviour``
    or from the transactions.  A NULL user matches nothing and counts as spending 0.
    """
    base = add_row_features(strip_text(t))
    joined = base.join(user_table(base, u, behaviour) if users is None else users, "user_id", "left")
    zero = F.col("user_id").isNull()
    return joined.withColumns({
        "user_total_spend": F.when(zero, F.lit(0)).otherwise(F.col("user_total_spend"))
                             .cast("decimal(22,2)"),
        "user_avg_txn_amount": F.when(zero, F.lit(0.0)).otherwise(F.col("user_avg_txn_amount")),
        "user_spending_tier": F.when(zero, user_spending_tier(F.lit(0)))
                               .otherwise(F.col("user_spending_tier")),
    }).select(*[c for c in ENRICHED_COLUMNS if c in joined.columns])


def user_activity(t: DataFrame) -> DataFrame:
    """One row per user: transactions, Success spend, mean amount, methods used."""
    return run(
        Report(keys=("user_id",), measures=(
            rows("txn_count"), total("total_spent", "amount", OK),
            mean("avg_amount", "amount"), distinct("methods_used", "payment_method"),
        )),
        t,
    )


def segments(t: DataFrame, places=True) -> DataFrame:
    """Users grouped by how often they pay; ``places`` rounds as the SQL layer does."""
    per_user = run(Report(keys=("user_id",), measures=(
        rows("txn_count"), total("total_spent", "amount", OK, exact=True), rows("failed", BAD),
    )), t).withColumns({
        "segment": user_segment("txn_count"),
        "failure_rate": (F.col("failed").cast("decimal(14,0)") * 100
                         / F.col("txn_count").cast("decimal(14,0)")).cast("decimal(12,6)"),
    })
    if places:
        report = Report(keys=(("user_segment", "segment"),), measures=(
            rows("user_count"), mean("avg_txn_per_user", "txn_count", places=1),
            mean("avg_spend", "total_spent", places=2),
            mean("avg_failure_rate", "failure_rate", places=2),
        ), order=("-avg_txn_per_user", "user_segment"))
    else:
        report = Report(keys=("segment",), measures=(
            rows("user_count"), mean("avg_txn", "txn_count"), mean("avg_spend", "total_spent"),
        ), order=("segment",), levels={"segment": SEGMENTS})
    return run(report, per_user)


def top_spenders(t: DataFrame, u: DataFrame, n=20) -> DataFrame:
    """The ``n`` users with the highest Success spend among those with a profile.

    The ranking needs sums only, one row per user.  The distinct counts are taken in a
    second pass over the transactions of the ``n`` users found, so no distinct shuffle
    of the whole table takes place; the broadcast side has ``n`` rows.
    """
    profile = u.select("user_id", "age_group", "customer_tier", "spending_persona")
    top = run(Report(keys=("user_id",), measures=(
        rows("total_txn"), total("total_spent", "amount", OK),
        mean("avg_txn_value", "amount", places=2), total("total_cashback", "cashback_earned"),
    )), t).join(profile, "user_id").orderBy(F.desc("total_spent"), "user_id").limit(n)
    used = t.select("user_id", "payment_method", "category").join(F.broadcast(top), "user_id")
    return used.groupBy(*top.columns).agg(
        F.count_distinct("payment_method").alias("methods_used"),
        F.count_distinct("category").alias("categories_used"),
    ).orderBy(F.desc("total_spent"), "user_id")
