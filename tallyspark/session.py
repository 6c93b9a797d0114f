"""Session settings used by the bench, the tests and standalone runs.

The operators never change the settings of a session they are handed; a cluster
sets its own.  These are the values the plans were looked at with.
"""

import os

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: coalesce small shuffle partitions, split skewed ones,
    # switch a join to broadcast once the real size of a side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM leaves methods over 8000 bytes of code to its interpreter.  A wide projection
    # (the enriched table) exceeds that as one fused method; above the limit Spark uses its
    # split projection code, which is compiled (three times faster here).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Do not record a Python call site for every column built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app="tallyspark", cpus=None, shuffle_partitions=None, extra=None):
    """A session on ``local[cpus]``, or on the master spark-submit names if ``cpus`` is None."""
    builder = SparkSession.builder.appName(app)
    if cpus is not None:
        builder = (
            builder.master(f"local[{cpus}]")
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("TALLYSPARK_DRIVER_MEMORY", "8g"))
        )
        shuffle_partitions = shuffle_partitions or cpus
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
