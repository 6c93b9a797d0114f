"""Time intelligence: previous period, growth, to-date and cumulative figures.

The transactions are reduced to one row per day or month (and label) first; every
window below runs on that calendar grain, whose size is set by the calendar.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.measures import OK
from tallyspark.functions.rates import money_sum_sql
from tallyspark.sources.writers import stored

FIGURES = ["revenue", "transactions"]


def _figures():
    return [F.expr(money_sum_sql("amount", OK)).alias("revenue"),
            F.count(F.lit(1)).alias("transactions")]


def daily(t: DataFrame, keys=()) -> DataFrame:
    return t.groupBy(*keys, F.to_date("transaction_datetime").alias("date")).agg(*_figures())


def monthly(t: DataFrame, keys=()) -> DataFrame:
    start = F.trunc("transaction_datetime", "month").alias("month_start")
    return t.groupBy(*keys, start).agg(*_figures())


def growth(current: Column, previous: Column) -> Column:
    """(current - previous) / previous in percent; 0 when there is no previous figure."""
    now, then = F.coalesce(current, F.lit(0)).cast("double"), previous.cast("double")
    return F.coalesce(F.try_divide(now - then, then) * 100, F.lit(0.0))


def month_shift(months: DataFrame, back: int, suffix: str, growth_suffix: str, keys=()) -> DataFrame:
    """Each month with the figures of the month ``back`` months earlier.

    A range frame over the running month number finds exactly that month, so a month
    missing from the data gives NULL, never the last one present.  A label without rows in a
    month still has a line there if it has earlier figures to show, up to the last month of
    the whole table.  The months are stored first: the facts behind them are read once.
    """
    months = stored(months, "months")
    last = months.agg(F.max("month_start")).scalar()
    later = months.select(*keys, F.add_months("month_start", back).alias("month_start"),
                          *[F.lit(None).cast(months.schema[n].dataType).alias(n) for n in FIGURES])
    months = months.unionByName(later.filter(F.col("month_start") <= last)) \
        .groupBy(*keys, "month_start").agg(*[F.max(n).alias(n) for n in FIGURES])
    number = F.year("month_start") * 12 + F.month("month_start")
    frame = Window.partitionBy(*keys).orderBy(number).rangeBetween(-back, -back)
    out = months
    for name in FIGURES:
        out = out.withColumn(f"{name}_{suffix}", F.max(name).over(frame))
    return out.withColumns({
        f"{name}_{growth_suffix}": growth(F.col(name), F.col(f"{name}_{suffix}"))
        for name in FIGURES
    })


def day_shift(days: DataFrame, back: int, suffix: str, keys=()) -> DataFrame:
    """Each day with the figures of the same day ``back`` months earlier.

    Month ends move to the last day of the shorter month.  Both sides are one row per
    day (and label), and the join is an equality on the shifted date.
    """
    earlier = days.select(*keys, F.col("date").alias("_then"),
                          *[F.col(n).alias(f"{n}_{suffix}") for n in FIGURES])
    return (
        days.withColumn("_then", F.add_months("date", -back))
        .join(earlier, [*keys, "_then"], "left").drop("_then")
    )


def calendar_fill(rows: DataFrame, keys=(), column="date") -> DataFrame:
    """One row per day (or month, by ``column``) from the first to the last of the whole
    table, per label.

    Each row is stretched up to the one before the next (and the first row of a label back to
    the start), so the gaps appear without a join.  The figures stay on their own row; filled
    rows hold NULL.  The rows, one per day or month and label, are stored first: the facts behind
    them are read once, and the ends of the table come from what is stored.
    """
    rows = stored(rows, "days")
    label = Window.partitionBy(*keys).orderBy(column)
    spread = rows.withColumns({
        "_next": F.lead(column).over(label),
        "_first": F.lag(column).over(label).isNull(),
    })
    low, high = rows.agg(F.min(column)).scalar(), rows.agg(F.max(column)).scalar()
    start = F.when(F.col("_first"), low).otherwise(F.col(column))
    before = F.date_sub("_next", 1) if column == "date" else F.add_months("_next", -1)
    step = F.expr("INTERVAL 1 DAY" if column == "date" else "INTERVAL 1 MONTH")
    spread = spread.withColumn("_at", F.explode(F.sequence(start, F.coalesce(before, high), step)))
    own = F.col("_at") == F.col(column)
    return spread.select(
        *keys, F.col("_at").alias(column), *[F.when(own, F.col(n)).alias(n) for n in FIGURES]
    )


def to_date_totals(t: DataFrame, keys=()) -> DataFrame:
    """Year-, quarter- and month-to-date and cumulative figures for every calendar day."""
    filled = calendar_fill(daily(t, keys), keys)
    year, quarter, month = F.year("date"), F.quarter("date"), F.month("date")

    def running(name, *parts):
        frame = Window.partitionBy(*keys, *parts).orderBy("date").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return F.sum(name).over(frame)

    return filled.select(
        *keys, "date",
        running("revenue", year).cast("double").alias("revenue_ytd"),
        running("transactions", year).alias("transactions_ytd"),
        running("revenue", year, quarter).cast("double").alias("revenue_qtd"),
        running("revenue", year, month).cast("double").alias("revenue_mtd"),
        running("revenue").cast("double").alias("cumulative_revenue"),
        running("transactions").alias("cumulative_transactions"),
    )


def month_to_date_totals(t: DataFrame, keys=()) -> DataFrame:
    """The same running figures read at the end of every month, for every label: a label
    without rows in a month carries its figures on."""
    months = calendar_fill(monthly(t, keys), keys, "month_start")
    year, quarter = F.year("month_start"), F.quarter("month_start")

    def running(name, *parts):
        frame = Window.partitionBy(*keys, *parts).orderBy("month_start").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return F.sum(name).over(frame)

    return months.select(
        *keys, "month_start",
        running("revenue", year).cast("double").alias("revenue_ytd"),
        running("transactions", year).alias("transactions_ytd"),
        running("revenue", year, quarter).cast("double").alias("revenue_qtd"),
        F.col("revenue").cast("double").alias("revenue_mtd"),
        running("revenue").cast("double").alias("cumulative_revenue"),
        running("transactions").alias("cumulative_transactions"),
    )


def period_label(t: DataFrame) -> DataFrame:
    first, last = F.min("transaction_datetime"), F.max("transaction_datetime")
    return t.agg(F.concat(
        F.lit("Period: "), F.date_format(first, "dd MMM yyyy"), F.lit(" – "),
        F.date_format(last, "dd MMM yyyy"),
    ).alias("period_label"))
