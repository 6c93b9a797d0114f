"""Helpers of the operators: stored intermediate tables and ranks without a hot task."""

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.sources.writers import shared_folder

SEEDED_BITS = 60


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark, purpose)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def seeded_order(seed: str, *parts: Column) -> Column:
    """A pseudo-random BIGINT of 60 bits from the seed and the parts (NULL counts as '')."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, SEEDED_BITS // 4), 16, 10).cast("bigint")


def bucket_count(spark: SparkSession) -> int:
    """Buckets to rank by: a power of two, some for every shuffle partition."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 2 ** math.ceil(math.log2(8 * max(1, partitions)))


def seeded_bucket(spark: SparkSession, order: Column) -> Column:
    """The bucket of a ``seeded_order`` value; buckets rise with it."""
    return F.shiftright(order, SEEDED_BITS - int(math.log2(bucket_count(spark))))


def running_before(df: DataFrame, by: list[str], bucket: str, order: list[str], out: str,
                   value: str | None = None, total: str | None = None) -> DataFrame:
    """Adds to each row the number of rows (or the sum of ``value``) before it within ``by``.

    Rows are ordered by ``bucket`` and then ``order``; ``bucket`` must rise with the order.
    Only a bucket is ever sorted in one task: bucket totals are aggregated (map side first),
    summed over the buckets of a group, and added to the running figure inside the bucket.
    A group with a third of all rows is thus spread over all its buckets.  ``total`` names a
    column for the figure of the whole group.  ``df`` is read twice.
    """
    amount = F.lit(1).cast("bigint") if value is None else F.col(value)
    keys = [*by, bucket]
    sums = df.groupBy(*keys).agg(F.sum(amount).alias("_sum"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"),
        F.sum("_sum").over(group).alias("_total"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = df.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    match = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    joined = ranked.join(sums, match).withColumn(out, F.col("_earlier") + F.col("_inside"))
    if total:
        joined = joined.withColumn(total, F.col("_total"))
    return joined.drop("_inside", "_earlier", "_total", *[f"_key{i}" for i in range(len(keys))])


# The white space that separates words, as the words pattern has it.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text (none for NULL): runs of characters that are not blanks."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a stored table of narrow rows, with a broadcast hint if it has few rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> list[Column]:
    """Join conditions ``left.k <=> right._on_k``."""
    return [left[k].eqNullSafe(right[f"_on_{k}"]) for k in keys]


def row_hash(text: str) -> Column:
    """Tells rows apart that share an id: a hash of the text, 0 for NULL."""
    return F.coalesce(F.when(F.col(text).isNotNull(), F.xxhash64(text)), F.lit(0).cast("bigint"))


def kept_rows(docs: DataFrame, verdicts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``verdicts`` (doc_id, row_hash, kept) keep, as they are.

    Rows alike in id and text share a verdict: they are one document.
    """
    keep = verdicts.filter("kept").select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_own"), row_hash(text).alias("_own_hash"))
    return rows.join(keep, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_own_hash") == F.col("_hash")),
                     "left_semi").select("_row.*")
