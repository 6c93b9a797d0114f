"""Writers: enriched table, star schema, findings, raw export."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.derive import year_month
from tallyspark.operators.clean import fill_reasons
from tallyspark.schemas import ENRICHED_COLUMNS

# Columns of the raw export and their headings
RAW_EXPORT = [
    ("transaction_id", "Transaction ID"), ("user_id", "User ID"),
    ("transaction_datetime", "DateTime"), ("payment_method", "Payment Method"),
    ("category", "Category"), ("merchant", "Merchant"), ("amount", "Amount (₹)"),
    ("status", "Status"), ("failure_reason", "Failure Reason"), ("platform", "Platform"),
    ("city", "City"), ("processing_time_sec", "Processing Time (s)"),
]
CSV_OUT = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8",
           "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "emptyValue": ""}


# A raw export keeps blanks at the ends of its texts.
AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the place in ``spark.checkpoint.dir``.  Only a session on one
    machine may lack that setting; it gets a temporary folder.  On a cluster such a folder
    would be a different one on every executor, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.match(r"local($|\[)", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        return tempfile.mkdtemp(prefix=f"tallyspark-{purpose}-")
    return f"{base.rstrip('/')}/tallyspark-{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read back."""
    path = f"{shared_folder(df.sparkSession, purpose)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, **options) -> None:
    df.write.mode("overwrite").options(**{**CSV_OUT, **options}).csv(path)


def write_by_month(df: DataFrame, path: str, ts="transaction_datetime") -> None:
    """Parquet, one folder per month.

    The rebalance hint gathers a month into few files and splits a month that is far
    larger than the others, so neither small files nor one long task result.
    """
    df.withColumn("txn_month", year_month(ts)).hint("rebalance", "txn_month").write.mode(
        "overwrite"
    ).partitionBy("txn_month").parquet(path)


def write_enriched(e: DataFrame, path: str, form="parquet") -> None:
    table = e.select(*[c for c in ENRICHED_COLUMNS if c in e.columns])
    if form == "csv":
        write_csv(fill_reasons(table), path)
    else:
        write_by_month(table, path)


def write_star(star: dict, folder: str, form="parquet") -> None:
    """All six tables; the fact by month, the dimensions as they are."""
    for name, table in star.items():
        path = f"{folder}/{name}"
        if form == "csv":
            write_csv(table, path)
        elif name == "fact_transactions":
            write_by_month(table, path)
        else:
            table.write.mode("overwrite").parquet(path)


def write_findings(findings: DataFrame, path: str) -> None:
    """The one-row findings report as JSON."""
    findings.write.mode("overwrite").json(path)


def raw_export(t: DataFrame) -> DataFrame:
    """Twelve renamed columns; a missing reason becomes an empty text."""
    shown = t.withColumn("failure_reason", F.coalesce("failure_reason", F.lit("")))
    return shown.select(*[F.col(c).alias(title) for c, title in RAW_EXPORT])


def ordered_by_time(t: DataFrame) -> DataFrame:
    """The whole table in time order, range-partitioned: the concatenated files are sorted."""
    return t.orderBy("transaction_datetime", "transaction_id")


def write_raw_export(t: DataFrame, path: str) -> None:
    write_csv(raw_export(t), path, **AS_IS)


def read_raw_export(spark: SparkSession, path: str, schema) -> DataFrame:
    """The exported file; a missing reason is the empty text again."""
    shown = spark.read.schema(schema).options(**CSV_OUT, **AS_IS).csv(path)
    return shown.withColumn("Failure Reason", F.coalesce("Failure Reason", F.lit("")))
