"""Readers with declared schemas; nothing is inferred from the data."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas
from tallyspark.operators.clean import blank_reasons, coerce_types

CORRUPT = "_corrupt_record"
CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8",
       "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def _csv(spark, path, schema, **options) -> DataFrame:
    return spark.read.schema(schema).options(**{**CSV, **options}).csv(path)


def read_user_profiles(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.USER_PROFILES)


def read_transactions(spark: SparkSession, path: str, keep_corrupt=False) -> DataFrame:
    """Typed rows; with ``keep_corrupt`` the text of a row that does not fit is kept."""
    schema = schemas.TRANSACTIONS
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return _csv(spark, path, schema, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)


def read_transactions_lenient(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text first, then coerced: one bad value spoils one cell, not a row."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.TRANSACTIONS])
    return coerce_types(_csv(spark, path, text))


def read_raw_pair(spark: SparkSession, transactions_path: str, profiles_path: str):
    """(transactions, user_profiles) for the feature pipeline."""
    return read_transactions(spark, transactions_path), read_user_profiles(spark, profiles_path)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def enriched_csv_schema() -> T.StructType:
    """Types of the 52 columns as they stand in a CSV export."""
    known = {f.name: f.dataType for f in [*schemas.TRANSACTIONS, *schemas.USER_PROFILES]}
    whole = {"year", "month", "quarter", "day", "day_of_week", "hour", "week_number",
             "is_month_start", "is_month_end", "is_festival_season"}
    special = {"date": T.DateType(), "total_savings": T.DecimalType(11, 2),
               "savings_pct": T.DecimalType(12, 2), "net_amount": T.DecimalType(12, 2),
               "user_total_txns": T.LongType(), "user_total_spend": T.DecimalType(22, 2),
               "user_avg_txn_amount": T.DoubleType(), "user_failure_rate_pct": T.DoubleType()}
    fields = []
    for name in schemas.ENRICHED_COLUMNS:
        kind = special.get(name) or known.get(name)
        kind = kind or (T.IntegerType() if name in whole else T.StringType())
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def read_enriched_csv(spark: SparkSession, path: str) -> DataFrame:
    """An enriched export; the text that stands for a missing reason is NULL again."""
    return blank_reasons(_csv(spark, path, enriched_csv_schema()))


def year_month_label(ts="transaction_datetime"):
    return F.date_format(ts, "yyyy MMM")


def load_star(spark: SparkSession, folder: str, form="csv", months=False) -> dict:
    """The six star tables from one folder, with their declared types.

    With ``months`` the Parquet fact keeps ``txn_month``, the month it is stored by, so that
    date filters skip the folders of other months.
    """
    out = {}
    for name, schema in schemas.STAR_TABLES.items():
        path = f"{folder}/{name}"
        if form == "csv":
            out[name] = _csv(spark, path, schema)
        else:
            table = spark.read.parquet(path)
            columns = [*schema.fieldNames(), *(["txn_month"] if months else [])]
            out[name] = table.select(*[c for c in columns if c in table.columns])
    return out
