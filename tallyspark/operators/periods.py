"""Period measures in a filter context: previous periods, to-date and cumulative figures.

A visual evaluates its measures once per cell.  The dates of a cell are its context: all dates
of the calendar that meet the date filters and the cell's date attributes.  A period measure
replaces that set of dates by another one and leaves every other filter as it is, so a slicer
on March does not hide February from a previous-month figure.

The facts come as a daily table: one row per date, per label of the visual and per outcome of
the filters that are not about dates.  It is read once from the facts; everything below works
on it and on a calendar of one row per day.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.timeintel import growth

DATE = "_date"


@dataclass(frozen=True)
class PeriodMeasure:
    base: str              # name of the additive measure it evaluates
    period: str            # a key of SHIFTS or RUNS
    grown: bool = False    # growth of the base over the period, in percent


SHIFTS = {"pm": 1, "py": 12}          # months back
RUNS = {"ytd": (F.year,), "qtd": (F.year, F.quarter), "mtd": (F.year, F.month), "ever": ()}

PERIOD_MEASURES = {
    "revenue_pm": PeriodMeasure("total_revenue", "pm"),
    "revenue_mom_growth_pct": PeriodMeasure("total_revenue", "pm", True),
    "transactions_pm": PeriodMeasure("total_transactions", "pm"),
    "transactions_mom_growth_pct": PeriodMeasure("total_transactions", "pm", True),
    "revenue_py": PeriodMeasure("total_revenue", "py"),
    "revenue_yoy_growth_pct": PeriodMeasure("total_revenue", "py", True),
    "transactions_py": PeriodMeasure("total_transactions", "py"),
    "transactions_yoy_growth_pct": PeriodMeasure("total_transactions", "py", True),
    "revenue_ytd": PeriodMeasure("total_revenue", "ytd"),
    "transactions_ytd": PeriodMeasure("total_transactions", "ytd"),
    "revenue_qtd": PeriodMeasure("total_revenue", "qtd"),
    "revenue_mtd": PeriodMeasure("total_revenue", "mtd"),
    "cumulative_revenue": PeriodMeasure("total_revenue", "ever"),
    "cumulative_transactions": PeriodMeasure("total_transactions", "ever"),
}


def calendar(daily: DataFrame) -> DataFrame:
    """One row per day from the first to the last date of the facts, filtered or not."""
    ends = daily.agg(F.min(DATE).alias("low"), F.max(DATE).alias("high"))
    return ends.select(F.explode(F.sequence("low", "high", F.expr("INTERVAL 1 DAY"))).alias(DATE))


def context(days: DataFrame, attributes: dict, wanted: Column) -> DataFrame:
    """The calendar rows inside the date filters, with the date attributes of their cell and the
    days that the calendar has of their month."""
    month = Window.partitionBy(F.trunc(DATE, "month"))
    days = days.withColumn("_days", F.count(F.lit(1)).over(month))
    return days.filter(wanted).withColumns({name: make(DATE) for name, make in attributes.items()})


def shifted(cells: DataFrame, keys: list[str], months: int, by_day: bool) -> DataFrame:
    """The dates of each cell moved ``months`` back.

    Month ends move to the last day of a shorter month.  A cell that holds a whole month (all
    days of it that the calendar has) holds the whole month before, also if that one is longer;
    cells of single days (``by_day``) do not.
    """
    month = Window.partitionBy(*keys, F.trunc(DATE, "month"))
    then = F.add_months(DATE, -months)
    last = F.col(DATE) == F.max(DATE).over(month)
    whole = F.lit(not by_day) & last & (F.count(F.lit(1)).over(month) == F.col("_days"))
    spread = cells.withColumn("_whole", whole).select(
        *keys, F.explode(F.sequence(then, F.when(F.col("_whole"), F.last_day(then)).otherwise(then),
                                    F.expr("INTERVAL 1 DAY"))).alias(DATE))
    return spread.distinct()


def over_sets(kept: DataFrame, sets: dict, keys: list[str], labels: list[str], values: list[str]) -> DataFrame:
    """Sums of ``values`` by cell and label over each named set of (cell, date).

    The sets have at most one row per cell, date and name; they follow from the calendar alone
    and are small whatever the facts.
    """
    pairs = None
    for name, rows in sets.items():
        rows = rows.select(DATE, *keys, F.lit(name).alias("_set"))
        pairs = rows if pairs is None else pairs.unionByName(rows)
    met = kept.join(F.broadcast(pairs), DATE)
    return met.groupBy(*keys, *labels).agg(*[
        F.sum(F.when(F.col("_set") == name, F.col(v))).alias(f"{v}_{name}") for name in sets for v in values])


def over_runs(kept: DataFrame, days: DataFrame, cells: DataFrame, runs: list[str], keys: list[str],
              labels: list[str], values: list[str]) -> DataFrame:
    """Sums from the start of a period up to the last date of each cell, by cell and label.

    The last dates of the cells cut the calendar into spans.  Each label is reduced to one row
    per span, a label without rows in a span is carried on by stretching the row before, and
    running sums over the spans of a label give every cell its figure: no cell reads the days
    of another one again.
    """
    ends = cells.groupBy(*keys).agg(F.max(DATE).alias("_end"))
    marks = ends.select("_end").distinct()
    # Windows over the calendar: one row per day or per cell's end.
    places = marks.withColumns({"_place": F.row_number().over(Window.orderBy("_end")),
                                "_places": F.count(F.lit(1)).over(Window.partitionBy())})
    ahead = Window.orderBy(F.desc(DATE)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = days.join(F.broadcast(places), F.col(DATE) == F.col("_end"), "left").select(
        DATE, *[F.last(c, ignorenulls=True).over(ahead).alias(c) for c in ("_end", "_place", "_places")])
    rows = kept.join(F.broadcast(spans.filter(F.col("_end").isNotNull())), DATE)

    def same(run):
        inside = F.lit(True)
        for part in RUNS[run]:
            inside = inside & (part(DATE) == part("_end"))
        return inside

    parts = rows.groupBy(*labels, "_place", "_places").agg(*[
        F.sum(F.when(same(run), F.col(v))).alias(f"{v}_{run}") for run in runs for v in values])
    names = [f"{v}_{run}" for run in runs for v in values]
    of_label = Window.partitionBy(*labels).orderBy("_place")
    upto = F.coalesce(F.lead("_place").over(of_label) - 1, F.col("_places"))
    filled = parts.withColumn("_upto", upto).select(
        *labels, F.explode(F.sequence("_place", "_upto")).alias("_at"), "_place", *names)
    filled = filled.select(*labels, "_at", *[F.when(F.col("_at") == F.col("_place"), F.col(n)).alias(n) for n in names])
    dated = filled.join(F.broadcast(places.select(F.col("_place").alias("_at"), "_end")), "_at")

    def running(run, name):
        by = Window.partitionBy(*labels, *[part("_end") for part in RUNS[run]]).orderBy("_at")
        return F.sum(name).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    sums = dated.select(*labels, "_end", *[
        running(run, f"{v}_{run}").alias(f"{v}_{run}") for run in runs for v in values])
    return sums.join(F.broadcast(ends), "_end").drop("_end")


def evaluate(kept: DataFrame, days: DataFrame, cells: DataFrame, periods: list[str], keys: list[str],
             labels: list[str], values: list[str], by_day: bool = False) -> DataFrame:
    """(keys, labels, <value>_<period>) for the context itself (period ``now``) and each of
    ``periods``.  NULL is a figure without rows; a row without any figure does not occur."""
    sets = {"now": cells}
    sets.update((p, shifted(cells, keys, SHIFTS[p], by_day)) for p in periods if p in SHIFTS)
    found = over_sets(kept, sets, keys, labels, values)
    runs = [p for p in periods if p in RUNS]
    if runs:
        found = found.unionByName(over_runs(kept, days, cells, runs, keys, labels, values), allowMissingColumns=True)
        figures = [c for c in found.columns if c not in (*keys, *labels)]
        found = found.groupBy(*keys, *labels).agg(*[F.max(c).alias(c) for c in figures])
    return found


def period_column(name: str, column_of) -> Column:
    """A period measure from the columns of its base now and in the period."""
    measure = PERIOD_MEASURES[name]
    then = F.col(column_of(measure.base, measure.period))
    if measure.grown:
        return growth(F.col(column_of(measure.base, "now")), then).alias(name)
    return then.cast("bigint" if measure.base == "total_transactions" else "double").alias(name)
