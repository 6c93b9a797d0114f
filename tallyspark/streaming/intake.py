"""Incremental form of the batch load: new transaction files are typed, stripped and
given their row features as they land, and appended to a Parquet table.

Only row-level work runs here.  User behaviour needs the whole history and is computed
in batch over the written table (``operators.users``).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyspark import schemas
from tallyspark.functions.derive import add_row_features, year_month
from tallyspark.operators.clean import coerce_types, strip_text
from tallyspark.operators.joins import with_profiles
from tallyspark.sources.readers import CSV


def read_transaction_stream(spark: SparkSession, folder: str, files_per_batch=1000) -> DataFrame:
    """CSV files of ``folder`` as a stream; every column is read as text, then coerced."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.TRANSACTIONS])
    raw = spark.readStream.schema(text).options(**CSV, maxFilesPerTrigger=files_per_batch)
    return coerce_types(raw.csv(folder))


def feature_stream(stream: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """Row features, and the profile of the user when ``profiles`` is given."""
    rows = add_row_features(strip_text(stream))
    return rows if profiles is None else with_profiles(rows, profiles, "left")


def start_intake(stream: DataFrame, path: str, checkpoint: str, available_now=True):
    """Append to Parquet by month; the checkpoint makes a restart exactly-once."""
    writer = (
        stream.withColumn("txn_month", year_month()).writeStream.format("parquet")
        .outputMode("append").partitionBy("txn_month")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
