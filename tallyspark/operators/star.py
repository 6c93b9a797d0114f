"""Star schema: one fact, five dimensions."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions.derive import (
    date_key, day_name, is_festival_season, is_month_end, is_month_start, month_name, status_flags,
)
from tallyspark.operators.joins import profile_columns, unmatched_keys
from tallyspark.operators.users import user_table

# Attributes of a date; each follows from the date alone.
DATE_ATTRIBUTES = {
    "year": F.year, "month": F.month, "month_name": month_name,
    "month_year": lambda d: F.concat_ws(" ", month_name(d), F.year(d)),
    "quarter": F.quarter, "quarter_label": lambda d: F.concat(F.lit("Q"), F.quarter(d)),
    "day": F.day, "day_of_week": F.weekday, "day_name": day_name, "week_number": F.weekofyear,
    "is_weekend": lambda d: (F.weekday(d) >= 5).cast("int"),
    "is_month_start": is_month_start, "is_month_end": is_month_end,
    "is_festival_season": is_festival_season, "date_key": date_key,
}
KEYS = {"dim_date": "date_key", "dim_users": "user_id",
        "dim_payment_method": "payment_method", "dim_category": "category",
        "dim_platform": "platform"}


def literal_table(spark: SparkSession, rows, columns) -> DataFrame:
    structs = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, columns)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dim_payment_method(spark):
    return literal_table(spark, schemas.PAYMENT_METHOD_ROWS,
                         schemas.DIM_PAYMENT_METHOD.fieldNames())


def dim_category(spark):
    return literal_table(spark, schemas.CATEGORY_ROWS, schemas.DIM_CATEGORY.fieldNames())


def dim_platform(spark):
    return literal_table(spark, schemas.PLATFORM_ROWS, schemas.DIM_PLATFORM.fieldNames())


def dim_date(e: DataFrame) -> DataFrame:
    """One row per date that occurs.

    The dates are made distinct first (a hash aggregate of one column, map side included) and
    the attributes are derived from the few rows left.
    """
    dates = e.select("date").distinct()
    return dates.withColumns({name: make("date") for name, make in DATE_ATTRIBUTES.items()}) \
        .select(*schemas.DIM_DATE.fieldNames()).orderBy("date")


def dim_users(e: DataFrame, u: DataFrame) -> DataFrame:
    """One row per user who occurs, built at user grain rather than from enriched rows."""
    users = user_table(e, u)
    return users.select(*[c for c in schemas.DIM_USERS.fieldNames() if c in users.columns])


def fact_transactions(e: DataFrame) -> DataFrame:
    fact = e.withColumns({"date_key": date_key("date"), **status_flags()})
    return fact.select(*[c for c in schemas.FACT_COLUMNS if c in fact.columns])


class Star(Mapping):
    """The six tables by name; each plan is put together when it is first asked for."""

    def __init__(self, builders: dict, profiles: DataFrame | None = None):
        self._builders, self._tables = builders, {}
        self.profiles = profiles   # user attributes that need no behaviour

    def __getitem__(self, name):
        if name not in self._tables:
            self._tables[name] = self._builders[name]()
        return self._tables[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


def build_star(e: DataFrame, u: DataFrame) -> Star:
    """The star schema of row-featured transactions and profiles."""
    spark = e.sparkSession
    return Star({
        "fact_transactions": lambda: fact_transactions(e),
        "dim_date": lambda: dim_date(e),
        "dim_users": lambda: dim_users(e, u),
        "dim_payment_method": lambda: dim_payment_method(spark),
        "dim_category": lambda: dim_category(spark),
        "dim_platform": lambda: dim_platform(spark),
    }, profile_columns(u))


def relationship_check(star: dict) -> DataFrame:
    """(dimension, n_keys, n_rows): fact keys that find no row in their dimension."""
    out = None
    for name, key in KEYS.items():
        fixed = name not in ("dim_users", "dim_date")
        missing = unmatched_keys(star["fact_transactions"], star[name], key, fixed).agg(
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        ).select(F.lit(name).alias("dimension"), "n_keys", "n_rows")
        out = missing if out is None else out.unionByName(missing)
    return out
