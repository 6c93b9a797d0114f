"""Sharding by proportional stratified interleaving."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.shared import bucket_count, materialise, running_before, seeded_bucket, seeded_order


def interleaved_shards(docs: DataFrame, shards: int = 24, seed: str = "shards", key: str = "doc_id",
                       source: str = "source", text: str = "text") -> DataFrame:
    """Deals all rows to ``shards`` shards so that every shard holds the mixture of sources.

    Rows of a source are shuffled by a seeded hash and ranked 0..n-1; the rank plus a half,
    over n, is the row's fraction.  Sorted by fraction, every stretch of the table holds each
    source in proportion, and the table is cut into stretches whose row counts differ by one
    at most (law ``rows``).  ``slot`` is the place within the shard, gapless from 0.

    Defined results: a NULL source is a source of its own, a NULL text has size 8 and the
    checksum of the empty text, a NULL key is hashed as ''.  Rows alike in key, size and
    checksum are interchangeable, so repeated rows change nothing.  An empty table gives an
    empty result; extra columns are ignored.  With fewer rows than shards some stay empty.

    Ranks are found bucket by bucket (``running_before``): neither a source nor the table is
    ever sorted in one task.  Texts are read once and never shuffled.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialise(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"),
        (F.octet_length(body) + 8).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        seeded_order(seed, F.col(key)).alias("_h"),
    ), "shards")
    rows = rows.withColumn("_bucket", seeded_bucket(spark, F.col("_h")))
    ties = ["doc_id", "size", "text_crc32"]
    rows = running_before(rows, ["source"], "_bucket", ["_h", *ties], "_rank", total="_of")
    rows = rows.withColumn("fraction", (F.col("_rank") + F.lit(0.5)) / F.col("_of"))
    rows = rows.withColumn("_bucket", F.floor(F.col("fraction") * bucket_count(spark)))
    rows = running_before(rows, [], "_bucket", ["fraction", "source", *ties], "_place", total="_all")
    shard = F.expr(f"_place * {int(shards)} div _all")
    first = F.expr(f"(shard * _all + {int(shards) - 1}) div {int(shards)}")
    return rows.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), (F.col("_place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "source", "fraction",
    )
