"""The semantic layer: named measures, and queries of dimensions by measures.

Measures are unrounded; a ratio without a denominator is 0.  ``visual_query`` joins
the dimensions a query names to the fact after the fact has been reduced to one row
per foreign key.
"""

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import derive
from tallyspark.functions.measures import (
    BAD, FLAGGED, Measure, OK, PENDING, REFUNDED, Term, distinct, mean, per, rate, rows, total,
)
from tallyspark.functions.derive import TS
from tallyspark.operators.aggregate import Dimension, Report, Share, run
from tallyspark.operators import periods
from tallyspark.operators.filters import apply_filters
from tallyspark.operators.periods import PERIOD_MEASURES
from tallyspark.operators.star import DATE_ATTRIBUTES, KEYS
from tallyspark.sources.writers import stored

_N = rows("total_transactions")
_U = distinct("unique_users", "user_id")
_REVENUE = total("total_revenue", "amount", OK, zero=False)

MEASURES = {m.name: m for m in (
    _N,
    rows("successful_transactions", OK),
    rows("failed_transactions", BAD),
    rows("pending_transactions", PENDING),
    rate("success_rate_pct", OK, empty=0.0),
    rate("failure_rate_pct", BAD, empty=0.0),
    rate("pending_rate_pct", PENDING, empty=0.0),
    _REVENUE,
    mean("avg_transaction_amount", "amount", OK),
    total("total_net_revenue", "net_amount", OK, zero=False),
    total("total_cashback", "cashback_earned"),
    total("total_discounts", "discount_applied"),
    total("total_savings", "total_savings"),
    total("lost_revenue", "amount", BAD, zero=False),
    _U,
    per("avg_transactions_per_user", _N, _U, empty=0.0),
    per("avg_revenue_per_user", _REVENUE, _U, empty=0.0),
    rows("flagged_transactions", FLAGGED),
    rate("fraud_rate_pct", FLAGGED, empty=0.0),
    mean("avg_flagged_amount", "amount", FLAGGED),
    total("total_flagged_volume", "amount", FLAGGED, zero=False),
    rows("total_refunds", REFUNDED),
    rate("refund_rate_pct", REFUNDED, empty=0.0),
    total("total_refund_value", "refund_amount"),
    mean("avg_refund_amount", "refund_amount", REFUNDED),
    mean("avg_processing_time", "processing_time_sec", OK),
    mean("avg_failed_processing_time", "processing_time_sec", BAD),
    mean("avg_failed_amount", "amount", BAD),
)}

# Measures that count rows: nothing counted is shown as a blank, not as 0.
COUNTS = {"total_transactions", "successful_transactions", "failed_transactions",
          "pending_transactions", "flagged_transactions", "total_refunds"}
FIXED_SIZE = {"dim_date", "dim_payment_method", "dim_category", "dim_platform"}

VISUALS = {
    "1": ((), ("total_transactions", "total_revenue", "success_rate_pct", "unique_users",
               "fraud_rate_pct", "total_cashback")),
    "2": (("dim_date.month_year",), ("total_transactions", "success_rate_pct")),
    "3": (("payment_method",), ("total_transactions",)),
    "4": (("category",), ("total_revenue",)),
    "5": (("city",), ("total_transactions",)),
    "6": (("dim_date.day_name", "hour"), ("total_transactions",)),
    "7": (("time_bucket",), ("total_transactions", "success_rate_pct")),
    "8": (("dim_date.day_name",), ("total_transactions", "success_rate_pct")),
    "9": (("payment_method",), ("success_rate_pct",)),
    "10": (("amount_bucket",), ("total_transactions",)),
    "11": ((), ("failed_transactions", "failure_rate_pct", "lost_revenue", "avg_failed_amount")),
    "12": (("failure_reason",), ("failed_transactions",)),
    "13": (("payment_method",), ("lost_revenue",)),
    "14": (("hour",), ("total_transactions", "failure_rate_pct")),
    "15": (("payment_method", "failure_reason"), ("failed_transactions",)),
    "16": (("dim_users.age_group",), ("total_transactions", "avg_transaction_amount")),
    "17": (("dim_users.customer_tier",), ("total_transactions",)),
    "18": (("dim_users.spending_persona",), ("avg_transaction_amount",)),
    "19": (("dim_users.gender",), ("total_transactions",)),
    "20": (("dim_users.account_tenure",), ("total_transactions",)),
    "21": (("dim_date.month_year",), ("unique_users", "avg_transactions_per_user")),
    "22": ((), ("flagged_transactions", "fraud_rate_pct", "avg_flagged_amount",
                "total_flagged_volume")),
    "23": (("fraud_reason",), ("flagged_transactions",)),
    "24": (("category",), ("total_flagged_volume",)),
    "25": ((), ("total_refunds", "refund_rate_pct", "total_refund_value", "avg_refund_amount")),
    "26": (("category",), ("total_refund_value",)),
    "27": (("payment_method",), ("total_refund_value",)),
    "28": (("platform",), ("total_transactions",)),
    "29": (("device_type",), ("total_transactions",)),
    "30": (("platform",), ("success_rate_pct",)),
    "31": (("dim_platform.channel",), ("total_transactions",)),
    "32": (("payment_method",), ("total_cashback",)),
    "33": (("category",), ("total_discounts",)),
    "34": (("processing_speed",), ("total_transactions",)),
    "35": ((), ("avg_processing_time",)),
    "36a": (("dim_date.is_weekend",), ("total_transactions",)),
    "36b": (("dim_date.month_year",), ("avg_transaction_amount", "fraud_rate_pct")),
    "36c": (("category",), ("total_refunds",)),
    "36d": (("device_type",), ("success_rate_pct", "avg_transaction_amount")),
}


def visual_query(star: dict, dims=(), measures=(), filters=None, where=None,
                 limit=None, margins=()) -> DataFrame:
    """Measures by dimension attributes (``dim_date.month_year``) or fact columns.

    ``filters`` maps an attribute of a dimension to a list of values, or to a
    (first, last) tuple for a range; filtered dimensions restrict the fact and nothing
    else.  ``month_year`` is put in calendar order.  A chart that shows only so many groups
    passes ``limit``.

    Attributes of a date follow from the fact's own date, so ``dim_date`` is not joined: keys
    are derived from the fact row, and a date filter is a condition on the fact.  Profile
    attributes of ``dim_users`` come from the profiles, without the users' behaviour.

    ``margins`` are subsets of ``dims`` that get subtotals, () being the grand total; a column
    ``all_<attribute>`` marks them.  Rates and distinct counts of a total are its own.

    Period measures (``PERIOD_MEASURES``) may stand beside the others: see ``period_visual``.
    """
    if any(m in PERIOD_MEASURES for m in measures):
        if margins:
            raise ValueError("period measures have no margins")
        return period_visual(star, dims, measures, filters, where, limit)
    fact = star["fact_transactions"]
    dated = TS in fact.columns
    keys, order, hidden, dimensions = [], [], [], []
    for dim in dims:
        table, _, column = dim.rpartition(".")
        own_date = dated and table == "dim_date" and column in DATE_ATTRIBUTES
        keys.append((column, _date_key(column)) if own_date else column)
        if column == "month_year":
            hidden = [(c, _date_key(c)) if own_date else c for c in ("year", "month")]
            order += ["year", "month"]
        else:
            order.append(column)
        if own_date:
            continue
        if table == "dim_users" and column in getattr(star, "profiles", fact).columns and hasattr(star, "profiles"):
            if "profiles" not in [name for name, _ in dimensions]:
                dimensions.append(("profiles", Dimension(star.profiles, "user_id", "left")))
            continue
        if table and table not in [name for name, _ in dimensions]:
            dimensions.append((table, _dimension(star, table)))
    chosen = tuple(
        replace(MEASURES[m], blank_zero=bool(dims) and m in COUNTS) for m in measures
    )
    report = Report(tuple(keys + hidden), chosen, where=where, order=tuple(order),
                    limit=limit if dims else None,
                    drop=("year", "month") if hidden else (), hide_blank=bool(dims),
                    margins=tuple(_with_hidden(m) for m in margins))
    for attribute, values in (filters or {}).items():
        table, _, column = attribute.rpartition(".")
        if dated and table == "dim_date" and (column == "date" or column in DATE_ATTRIBUTES):
            fact = _on_dates(fact, values) if column == "date" else \
                fact.filter(_wanted(DATE_ATTRIBUTES[column](TS), values))
    rest = {a: v for a, v in (filters or {}).items() if not (dated and a.startswith("dim_date."))}
    return run(report, fact, [d for _, d in dimensions], _restrictions(star, rest))


def period_visual(star: dict, dims=(), measures=(), filters=None, where=None, limit=None) -> DataFrame:
    """``visual_query`` for measures some of which replace the dates of their context.

    The fact is read once, into a stored daily table: a row per date, label and outcome of each
    filter that is not about dates.  Filters on dates stay conditions on the calendar, which
    reaches over all dates of the fact.  Rows without a date belong to no period.  Distinct
    counts are refused, as those of days do not add up to those of a period.
    """
    fact, filters = star["fact_transactions"], dict(filters or {})
    named = [m for m in measures if m not in PERIOD_MEASURES]
    bases = dict.fromkeys([*named, *(PERIOD_MEASURES[m].base for m in measures if m in PERIOD_MEASURES)])
    if refused := [m for m in bases if not all(t.additive for t in MEASURES[m].terms())]:
        raise ValueError(f"{', '.join(refused)} cannot stand beside period measures")
    terms = list(dict.fromkeys(t for m in bases for t in MEASURES[m].terms()))
    values = {t: f"_t{i}" for i, t in enumerate(terms)}

    attributes, hidden, order, tables = {}, [], [], {}
    keys, labels, shown = [(periods.DATE, lambda: F.to_date(TS))], {}, {}
    for dim in dims:
        table, _, column = dim.rpartition(".")
        if table == "dim_date":
            name = f"_c{len(attributes)}"
            if column == "month_year":
                attributes.update({"_year": F.year, "_month": F.month})
                order += ["_year", "_month"]
            else:
                order.append(name)
            attributes[name] = DATE_ATTRIBUTES[column] if column != "date" else F.col
            shown[column] = name
            continue
        name = f"_l{len(labels)}"
        labels[name] = shown[column] = name
        order.append(name)
        keys.append((name, column))
        if table and column not in fact.columns:
            tables.setdefault(table, (_source(star, table, column), {}))
    in_dates, flags = F.lit(True), []
    for attribute, chosen in filters.items():
        table, _, column = attribute.rpartition(".")
        if table == "dim_date":
            make = DATE_ATTRIBUTES.get(column, F.col)
            chosen = [F.lit(v).cast("date") for v in chosen] if column == "date" else chosen
            wanted = tuple(chosen) if isinstance(filters[attribute], tuple) else chosen
            in_dates = in_dates & _wanted(make(periods.DATE), wanted)
            continue
        name = f"_in{len(flags)}"
        flags.append(name)
        if column in fact.columns:
            keys.append((name, lambda c=column, v=chosen: _wanted(F.col(c), v)))
        else:
            base, extra = tables.setdefault(table, (_source(star, table, column), {}))
            extra[name] = _wanted(F.col(column), chosen)
            keys.append((name, name))
    if where:
        flags.append("_in_where")
        keys.append(("_in_where", where))
    dimensions = [_dimension(star, t, base.withColumns(extra) if extra else base)
                  for t, (base, extra) in tables.items()]
    sums = tuple(replace(_term_sum(t), name=v) for t, v in values.items())
    daily = stored(run(Report(tuple(keys), sums), fact, dimensions), "daily")

    days = periods.calendar(daily)
    cells = periods.context(days, attributes, in_dates)
    kept = daily.filter(" AND ".join(flags)) if flags else daily
    wanted = list(dict.fromkeys(PERIOD_MEASURES[m].period for m in measures if m in PERIOD_MEASURES))
    found = periods.evaluate(kept, days, cells, wanted, list(attributes), list(labels), list(values.values()),
                             by_day="dim_date.date" in dims)

    def column_of(base, period):
        return f"{values[MEASURES[base].top]}_{period}"

    out = [F.col(name).alias(column) for column, name in shown.items()]
    for m in measures:
        if m in PERIOD_MEASURES:
            out.append(periods.period_column(m, column_of))
        else:
            measure = replace(MEASURES[m], blank_zero=bool(dims) and m in COUNTS)
            out.append(measure.finish(lambda t: _term_now(t, f"{values[t]}_now")))
    # Growth is 0 where there is nothing to grow from: it does not keep a row by itself.
    figures = [m for m in measures if m not in PERIOD_MEASURES or not PERIOD_MEASURES[m].grown]
    result = found.orderBy(*[F.col(o).asc_nulls_first() for o in order]).select(*out) if dims else found.select(*out)
    if dims and figures:
        result = result.dropna(how="all", subset=figures)
    return result.limit(limit) if limit is not None and dims else result


def _with_hidden(dims):
    """Names of the keys of dimensions: a month comes with the keys that order it."""
    names = [d.rpartition(".")[2] for d in dims]
    return (*names, "year", "month") if "month_year" in names else tuple(names)


def _source(star, table, column):
    """The table that has an attribute: profile attributes do not need the users' behaviour."""
    profiles = getattr(star, "profiles", None)
    return profiles if table == "dim_users" and profiles is not None and column in profiles.columns else star[table]


def _term_sum(term):
    """A measure that is the bare sum of an additive term."""
    return Measure("", term, exact=True)


def _term_now(term, column):
    """A term's daily sums added up; counts of nothing are 0."""
    return f"coalesce({column}, 0)" if term.kind in ("rows", "values") else column


def _date_key(column):
    return lambda: DATE_ATTRIBUTES[column](TS)


def _on_dates(fact, values):
    """A date filter; a range is put on the timestamp itself, so it reaches the scan."""
    days = [F.lit(v).cast("date") for v in values]
    if isinstance(values, tuple):
        return apply_filters(fact, date_from=days[0], date_to=days[1])
    return fact.filter(F.to_date(TS).isin(days))


def _wanted(column, values):
    """In a list of values, or within a (first, last) tuple."""
    return column.between(*values) if isinstance(values, tuple) else column.isin(list(values))


def _dimension(star, table, rows_=None, how="left"):
    return Dimension(star[table] if rows_ is None else rows_, KEYS[table], how,
                     fixed_size=table in FIXED_SIZE)


def _restrictions(star, filters):
    kept = {}
    for attribute, values in filters.items():
        table, _, column = attribute.rpartition(".")
        base = star[table]
        if table == "dim_users" and column in getattr(star, "profiles", base.limit(0)).columns:
            base = getattr(star, "profiles", base)
        rows_ = kept.get(table, base)
        kept[table] = rows_.filter(_wanted(F.col(column), values))
    return [_dimension(star, table, rows_) for table, rows_ in kept.items()]


def visual(name: str, star: dict, **kw) -> DataFrame:
    dims, measures = VISUALS[name]
    return visual_query(star, dims, measures, **kw)


def measure_table(star: dict, names, keys=()) -> DataFrame:
    """Any measures by any fact columns, without the limit of a visual."""
    return run(Report(tuple(keys), tuple(MEASURES[n] for n in names), order=tuple(keys)),
               star["fact_transactions"])


def status_bands(star: dict, keys=()) -> DataFrame:
    """Success and fraud rates with their bands."""
    rates = measure_table(star, ["success_rate_pct", "fraud_rate_pct"], keys)
    return rates.withColumns({
        "success_band": derive.status_band("success_rate_pct", "success"),
        "fraud_band": derive.status_band("fraud_rate_pct", "fraud"),
    })


def revenue_texts(star: dict, keys=(), sign="₹") -> DataFrame:
    """Revenue as text in crores and lakhs."""
    revenue = measure_table(star, ["total_revenue"], keys)
    return revenue.withColumns({
        "revenue_in_crores": derive.unit_text("total_revenue", "crore", sign),
        "revenue_in_lakhs": derive.unit_text("total_revenue", "lakh", sign),
    })


def platform_shares(t: DataFrame) -> DataFrame:
    """Each platform's share of all transactions (one decimal) and ratio to the largest."""
    n = Term("rows")
    return run(Report(("platform",), (rows("txn"),), shares=(
        Share("share_pct", n, places=1), Share("ratio_to_max", n, scale=1, places=None,
                                               against="max"),
    ), order=("-txn", "platform")), t)


def top_reasons(t: DataFrame, n=5) -> DataFrame:
    """The ``n`` most frequent failure reasons and one row for all the others.

    The ranking window runs over the counted reasons, one row each.
    """
    counted = run(Report(("failure_reason",), (rows("count"), total("lost", "amount")),
                         where=BAD, keep_null_keys=False), t)
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("count"), "failure_reason"))
    named = counted.withColumn("_rank", rank).withColumn(
        "reason", F.when(F.col("_rank") <= n, F.col("failure_reason")).otherwise(F.lit("Others"))
    ).withColumn("_rank", F.least("_rank", F.lit(n + 1)))
    return run(Report(("reason", ("_rank", "_rank")), (
        total("count", "count"), total("lost", "lost"),
    ), shares=(Share("pct", Term("sum", "count"), places=1),), order=("_rank",),
        drop=("_rank",)), named).withColumn("count", F.col("count").cast("bigint"))
