"""Payment-transaction analytics expressed as Spark DataFrame operators.

``sources``    readers and writers (CSV, Parquet, star schema, order tables)
``functions``  column builders: derived columns, rates, measures
``operators``  clean, quality, joins, filters, users, star, time intelligence
``plans``      the report catalogue built from the operators
``streaming``  incremental intake of newly landed transaction files
"""

__version__ = "0.1.0"
