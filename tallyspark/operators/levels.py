"""Fixed level lists: reindexing a report to them and ordering by them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def level_table(spark: SparkSession, key: str, levels) -> DataFrame:
    """A literal table (key, level_rank); its size is the length of ``levels``."""
    rows = F.array(*[F.struct(F.lit(v).alias(key), F.lit(i).alias("level_rank"))
                     for i, v in enumerate(levels)])
    return spark.range(1).select(F.inline(rows))


def level_rank(key: str, levels) -> Column:
    """Position in ``levels``; a value outside the list sorts last."""
    out = F.lit(len(levels))
    for i, v in reversed(list(enumerate(levels))):
        out = F.when(F.col(key) == F.lit(v), F.lit(i)).otherwise(out)
    return out


def reindex(report: DataFrame, key: str, levels, fill=()) -> DataFrame:
    """One row per level in list order; a level without rows gives NULLs, or 0 in ``fill``.

    ``report`` has at most one row per key value, so after the filter the broadcast
    side holds no more rows than there are levels.
    """
    present = report.filter(F.col(key).isin(list(levels)))
    out = level_table(report.sparkSession, key, levels).join(F.broadcast(present), key, "left")
    return (
        out.fillna(0, subset=list(fill)) if fill else out
    ).orderBy("level_rank").drop("level_rank")
