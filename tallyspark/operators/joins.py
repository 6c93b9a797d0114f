"""Joins used by the pipeline and the reports.

No join here hints a broadcast of a table that grows with the data.  Profiles and
per-user aggregates are joined without a hint: Spark broadcasts them only when
their size is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles (with
AQE splitting a skewed user) when it is not.  Hints are kept for sides whose row
count is fixed by construction: literal dimensions, level lists, one row per day.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.schemas import PROFILE_ATTRIBUTES


def profile_columns(profiles: DataFrame) -> DataFrame:
    """Profiles ready to join: the home city renamed so that it cannot clash."""
    kept = [c for c in PROFILE_ATTRIBUTES if c in profiles.columns]
    out = profiles.withColumnRenamed("city", "user_home_city")
    return out.select("user_id", *kept, *(["user_home_city"] if "city" in profiles.columns else []))


def with_profiles(transactions: DataFrame, profiles: DataFrame, how="left") -> DataFrame:
    """Each transaction with the attributes of its user (``inner`` or ``left``)."""
    return transactions.join(profile_columns(profiles), "user_id", how)


def orphan_rows(transactions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Transactions whose user has no profile; a NULL user is one of them."""
    return transactions.join(profiles.select("user_id"), "user_id", "left_anti")


def orphan_ids(transactions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Distinct user ids without a profile; deduplicated before the join."""
    ids = transactions.select("user_id").distinct()
    return ids.join(profiles.select("user_id"), "user_id", "left_anti")


def unmatched_keys(fact: DataFrame, dim: DataFrame, key: str, fixed_size: bool) -> DataFrame:
    """Fact key values absent from ``dim``, with how many rows carry each."""
    counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    side = dim.select(key)
    return counted.join(F.broadcast(side) if fixed_size else side, key, "left_anti")
