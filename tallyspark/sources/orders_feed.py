"""Transactions and user profiles derived from order, customer and nation tables.

The order tables carry no payment data, so every payment column is a fixed rule over
the order key (``k``).  The rules plant known faults (missing and stale reasons,
padded labels, refunds of failed payments) for the quality and cleaning operators.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas

ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])
CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_mktsegment", T.StringType()),
])
NATION = T.StructType([
    T.StructField("n_nationkey", T.IntegerType()),
    T.StructField("n_name", T.StringType()),
])

# Fixed values of the derivation
FEED_REASONS = ["Bank Server Down", "Insufficient Balance", "Server Timeout",
                "Session Expired", "Card Declined"]
METHOD_BY_PRIORITY = {"1-URGENT": "UPI", "2-HIGH": "Credit Card", "3-MEDIUM": "Debit Card",
                      "4-NOT SPECIFIED": "Net Banking"}
METHOD_BY_SEGMENT = {"AUTOMOBILE": "UPI", "BUILDING": "Credit Card",
                     "FURNITURE": "Debit Card", "HOUSEHOLD": "Net Banking"}
DISCOUNTED = ["Shopping", "Food & Dining", "Groceries"]
REFUNDABLE = ["Shopping", "Travel", "Food & Dining", "Entertainment"]


def _pick(index: str, labels) -> str:
    quoted = ", ".join("'" + v + "'" for v in labels)
    return f"element_at(array({quoted}), cast({index} + 1 as int))"


def _lookup(column: str, table: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {column} {arms} ELSE '{default}' END"


def _in(column, values):
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def table(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str, city=False) -> DataFrame:
    """The raw transactions; ``city`` adds the column that needs two lookups.

    Customers are looked up with a left join on their primary key, so leaving the city
    out changes no other column and no row.
    """
    orders = table(spark, folder, "orders", ORDERS)
    if city:
        customers = table(spark, folder, "customer", CUSTOMER).select("c_custkey", "c_nationkey")
        nations = table(spark, folder, "nation", NATION).withColumnRenamed("n_name", "city")
        orders = orders.join(customers, F.expr("o_custkey = c_custkey"), "left").join(
            nations, F.expr("c_nationkey = n_nationkey"), "left")
    step1 = orders.selectExpr(
        "o_orderkey AS k", "o_custkey", "o_orderpriority",
        "timestampadd(HOUR, o_orderkey % 24, o_orderdate) AS transaction_datetime",
        "cast((cast(round(o_totalprice * 100) AS bigint) div CASE WHEN o_orderkey % 10 = 0 THEN 1"
        " WHEN o_orderkey % 10 <= 3 THEN 10 WHEN o_orderkey % 10 <= 6 THEN 100 ELSE 1000 END)"
        " * 0.01 AS decimal(12,2)) AS amount",
        "CASE o_orderstatus WHEN 'O' THEN 'Success' WHEN 'F' THEN 'Failed' ELSE 'Pending' END"
        " AS status",
        f"{_pick('(o_orderkey div 24) % 10', schemas.CATEGORIES)} AS label",
        f"{_pick('(o_orderkey div 10) % 4', schemas.PLATFORMS)} AS platform",
        *(["city"] if city else []),
    )
    refundable = f"{_in('label', REFUNDABLE)} AND (k div 5) % 7 = 2"
    high = _high_amount()
    step2 = step1.selectExpr(
        "*",
        f"({refundable}) AS is_refunded",
        f"CASE WHEN hour(transaction_datetime) <= 4 AND amount > {schemas.LATE_NIGHT_AMOUNT}"
        f" THEN '{schemas.LATE_NIGHT_REASON}' WHEN amount > {high}"
        f" THEN '{schemas.HIGH_AMOUNT_REASON}' END AS fraud_reason",
    )
    return step2.selectExpr(
        "k AS transaction_id", "o_custkey AS user_id", "transaction_datetime",
        f"{_lookup('o_orderpriority', METHOD_BY_PRIORITY, 'Mobile Wallet')} AS payment_method",
        "CASE WHEN k % 13 = 0 THEN concat(' ', label, ' ') ELSE label END AS category",
        "concat('Merchant ', k % 70) AS merchant",
        "amount", "status",
        "CASE status WHEN 'Failed' THEN CASE WHEN k % 11 = 0 THEN NULL"
        f" ELSE {_pick('(k div 7) % 5', FEED_REASONS)} END"
        " WHEN 'Pending' THEN 'Processing'"
        " ELSE CASE WHEN k % 50 = 7 THEN 'Stale Reason' END END AS failure_reason",
        "platform",
        "CASE platform WHEN 'POS Terminal' THEN 'POS'"
        f" WHEN 'Web Browser' THEN {_pick('(k div 40) % 3', ['Windows', 'Mac', 'Linux'])}"
        f" ELSE {_pick('(k div 40) % 2', ['Android', 'iOS'])} END AS device_type",
        *(["city"] if city else []),
        "cast((50 + (k * 37) % 2950) * 0.01 AS decimal(5,2)) AS processing_time_sec",
        "cast(weekday(transaction_datetime) >= 5 AS int) AS is_weekend",
        "CASE WHEN status = 'Success' AND (k div 3) % 4 = 1"
        " THEN cast(round(amount * 0.05, 2) AS decimal(10,2))"
        " ELSE cast(0 AS decimal(10,2)) END AS cashback_earned",
        f"CASE WHEN status = 'Success' AND {_in('label', DISCOUNTED)} AND k % 3 = 0"
        " THEN cast(round(amount * 0.10, 2) AS decimal(10,2))"
        " ELSE cast(0 AS decimal(10,2)) END AS discount_applied",
        "(fraud_reason IS NOT NULL AND k % 2 = 0) AS is_flagged",
        "fraud_reason", "is_refunded",
        "cast(CASE WHEN NOT is_refunded THEN 0 WHEN k % 17 = 0 THEN amount * 2"
        " WHEN k % 5 < 3 THEN amount ELSE round(amount * 0.5, 2) END AS decimal(12,2))"
        " AS refund_amount",
    )


def _high_amount() -> str:
    arms = " ".join(
        f"WHEN '{c}' THEN {v}" for c, v in schemas.HIGH_AMOUNT_THRESHOLDS.items()
    )
    return f"CASE label {arms} ELSE {schemas.DEFAULT_HIGH_AMOUNT} END"


def user_profiles(spark: SparkSession, folder: str, city=False) -> DataFrame:
    customers = table(spark, folder, "customer", CUSTOMER)
    if city:
        nations = table(spark, folder, "nation", NATION)
        customers = customers.join(nations, F.expr("c_nationkey = n_nationkey"), "left")
    return customers.selectExpr(
        "c_custkey AS user_id", *(["n_name AS city"] if city else []),
        f"{_pick('c_custkey % 5', schemas.AGE_GROUPS)} AS age_group",
        f"{_pick('c_custkey % 3', schemas.GENDERS)} AS gender",
        f"{_pick('(c_custkey div 2) % 5', schemas.TENURES)} AS account_tenure",
        f"{_pick('(c_custkey div 3) % 4', schemas.TIERS)} AS customer_tier",
        f"{_pick('(c_custkey div 5) % 4', schemas.PERSONAS)} AS spending_persona",
        f"{_lookup('c_mktsegment', METHOD_BY_SEGMENT, 'Mobile Wallet')} AS preferred_method",
    )


def with_faults(t: DataFrame) -> DataFrame:
    """Adds the faults the feed lacks: amounts at or below zero, duplicates, orphans."""
    k = F.col("transaction_id")
    negated = {
        "amount": F.when(k % 991 == 0, (-F.col("amount")).cast("decimal(12,2)"))
                   .otherwise(F.col("amount")),
        **{c: F.when(k % 991 == 0, F.lit(-1).cast("decimal(10,2)")).otherwise(F.col(c))
           for c in ("cashback_earned", "discount_applied")},
    }
    # Rows that are repeated for a user nobody knows come out of the same scan.
    copies = F.when(k % 997 == 0, F.array(F.col("user_id"), F.lit(-1).cast("bigint"))).otherwise(
        F.array("user_id")
    )
    out = t.withColumn("user_id", F.explode(copies))
    copy = F.col("user_id") == -1
    return out.withColumns({
        c: F.when(copy, F.col(c)).otherwise(v) for c, v in negated.items()
    })
