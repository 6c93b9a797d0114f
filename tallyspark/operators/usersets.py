"""Exact user counts that add up: one bitmap of users per month and label.

Users get dense numbers once.  A stored table then holds, per month, label and block of 32,768
user numbers, a bitmap of the users with rows, and their transactions and revenue.  Bitmaps of
several months or labels merge into the set of all their users, so any roll-up of the stored
table has exact user counts without reading the facts again.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.measures import OK
from tallyspark.functions.rates import money_sum_sql, plain_ratio
from tallyspark.sources.writers import stored

NUMBER_BUCKETS = 4096
PERIODS = {"month": "month", "quarter": "quarter", "year": "year"}


def user_numbers(facts: DataFrame) -> DataFrame:
    """(user_id, number): the users of the facts numbered from 1 without gaps, stored.

    Users are dealt into buckets by hash and numbered inside each; a bucket starts where those
    before it end.  No task sees more than a bucket, and the window over bucket sizes has one
    row per bucket.
    """
    users = facts.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    users = stored(users.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(NUMBER_BUCKETS))), "users")
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = users.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("user_id"))
    numbered = users.withColumn("place", place).join(F.broadcast(starts), "bucket")
    return stored(numbered.select("user_id", (F.col("start") + F.col("place")).alias("number")), "user-numbers")


@dataclass
class UserSets:
    """Stored bitmaps of the users of each month and label."""

    table: DataFrame     # month_start, keys, block, users, transactions, revenue
    keys: tuple

    def figures(self, period: str | None = "month", keys=None) -> DataFrame:
        """Users, transactions and revenue, and both per user, by period and label.

        ``period`` is month, quarter, year or None (all time); ``keys`` are any of the labels
        (all, if not given).  Label values that are not asked for are merged.
        """
        keys = list(self.keys if keys is None else keys)
        if unknown := [k for k in keys if k not in self.keys]:
            raise ValueError(f"no sets by {', '.join(unknown)}")
        start = [F.trunc("month_start", PERIODS[period]).alias("period_start")] if period else []
        by = [*(["period_start"] if period else []), *keys]
        blocks = self.table.groupBy(*start, *keys, "block").agg(
            F.bitmap_or_agg("users").alias("users"), F.sum("transactions").alias("transactions"),
            F.sum("revenue").alias("revenue"))
        found = blocks.groupBy(*by).agg(
            F.sum(F.bitmap_count("users")).alias("unique_users"),
            F.sum("transactions").alias("transactions"), F.sum("revenue").alias("revenue"))
        users = F.nullif("unique_users", F.lit(0))
        return found.select(
            *by, "unique_users", "transactions", F.col("revenue").cast("double").alias("revenue"),
            F.coalesce(plain_ratio(F.col("transactions"), users, 1), F.lit(0.0)).alias("avg_transactions_per_user"),
            F.coalesce(plain_ratio(F.col("revenue"), users, 1), F.lit(0.0)).alias("avg_revenue_per_user"))


def user_sets(facts: DataFrame, keys=(), numbers: DataFrame | None = None) -> UserSets:
    """The stored sets of the facts by month and ``keys``.

    The facts are reduced to one row per month, label and user before they meet the numbers.
    Rows without a user count as transactions of nobody; rows without a date fall into a month
    of their own (NULL).
    """
    numbers = user_numbers(facts) if numbers is None else numbers
    month = F.trunc("transaction_datetime", "month").alias("month_start")
    reduced = facts.groupBy(month, *keys, "user_id").agg(
        F.count(F.lit(1)).alias("transactions"), F.expr(money_sum_sql("amount", OK)).alias("revenue"))
    placed = reduced.join(numbers, "user_id", "left")
    # A number is NULL for rows of nobody: they set no bit.
    block = F.coalesce(F.bitmap_bucket_number("number"), F.lit(0)).alias("block")
    table = placed.groupBy("month_start", *keys, block).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"),
        F.sum("transactions").alias("transactions"), F.sum("revenue").alias("revenue"))
    return UserSets(stored(table, "user-sets"), tuple(keys))
