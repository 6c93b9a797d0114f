"""Slicers: the filter selection of the dashboard as plain parameters."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.rates import or_zero, plain_ratio

# Calendar presets (a missing end is the last date in the data)
DATE_PRESETS = {
    "2024": (date(2024, 1, 1), date(2024, 12, 31)),
    "2025": (date(2025, 1, 1), date(2025, 12, 31)),
    "6M": (date(2025, 7, 1), None),
    "All": (None, None),
}
SLICERS = {"methods": "payment_method", "statuses": "status", "cities": "city",
           "categories": "category"}


def selection(date_from=None, date_to=None, methods=(), statuses=(), cities=(),
              categories=()) -> Column:
    """The condition of an inclusive date range and of every chosen list.

    An empty list filters nothing and an inverted range is turned round.  The range is
    put on the timestamp itself, so it reaches the scan.
    """
    plain = not isinstance(date_from, Column) and not isinstance(date_to, Column)
    if plain and date_from is not None and date_to is not None and date_from > date_to:
        date_from, date_to = date_to, date_from
    ts = F.col("transaction_datetime")
    wanted = F.lit(True)
    if date_from is not None:
        wanted = wanted & (ts >= _literal(date_from).cast("timestamp_ntz"))
    if date_to is not None:
        wanted = wanted & (ts < F.date_add(_literal(date_to), 1).cast("timestamp_ntz"))
    chosen = {"methods": methods, "statuses": statuses, "cities": cities,
              "categories": categories}
    for name, values in chosen.items():
        if values:
            wanted = wanted & F.col(SLICERS[name]).isin(list(values))
    return wanted


def _literal(day) -> Column:
    return day if isinstance(day, Column) else F.lit(day)


def apply_filters(e: DataFrame, **chosen) -> DataFrame:
    """The selected rows.  In a table stored by month the date range is put on the month
    folders, too, so that other months are not read."""
    kept = e.filter(selection(**chosen))
    if "txn_month" in e.columns:
        ends = [chosen.get("date_from"), chosen.get("date_to")]
        if None not in ends and not any(isinstance(d, Column) for d in ends):
            ends.sort()
        for day, inside in zip(ends, (F.col("txn_month").__ge__, F.col("txn_month").__le__)):
            if day is not None:
                kept = kept.filter(inside(F.date_format(_literal(day).cast("date"), "yyyy-MM")))
    return kept


def preset(name: str, presets=None) -> dict:
    """The date parameters of a preset, ready for :func:`apply_filters`."""
    start, end = (presets or DATE_PRESETS)[name]
    return {"date_from": start, "date_to": end}


def preset_counts(e: DataFrame, presets=None) -> DataFrame:
    """(preset, rows): how many rows each preset selects, in one pass."""
    presets = presets or DATE_PRESETS
    days = {name: [None if d is None else F.lit(d).cast("date") for d in ends]
            for name, ends in presets.items()}
    counted = e.agg(*[F.count_if(selection(*ends)).alias(name) for name, ends in days.items()])
    return counted.unpivot([], list(presets), "preset", "rows")


def option_lists(e: DataFrame) -> DataFrame:
    """(field, option): the sorted distinct values of every slicer column.

    The four columns are unpivoted before one distinct, so the table is read once.
    """
    long = e.unpivot([], list(SLICERS.values()), "field", "option")
    return long.filter(F.col("option").isNotNull()).distinct().orderBy("field", "option")


def date_bounds(e: DataFrame) -> DataFrame:
    return e.agg(
        F.to_date(F.min("transaction_datetime")).alias("date_min"),
        F.to_date(F.max("transaction_datetime")).alias("date_max"),
    )


def coverage(e: DataFrame, **chosen) -> DataFrame:
    """Rows kept by a selection, rows in all, and the percentage; one pass."""
    kept, whole = F.count_if(selection(**chosen)), F.count(F.lit(1))
    return e.agg(
        kept.alias("kept_rows"), whole.alias("total_rows"),
        or_zero(plain_ratio(kept, whole, 100)).alias("kept_pct"),
    )
