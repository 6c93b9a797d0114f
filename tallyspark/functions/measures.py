"""Measures: named figures built from additive terms.

A measure is one term, or a term over another.  Every term except ``distinct`` is
additive, so the aggregate operator can compute it in two steps (per foreign key,
then per report key) and join dimensions in between on the already reduced rows.
Conditions and values are SQL text over the columns of the row-level table.
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.rates import (
    MONEY, money_sum_sql, plain_ratio_sql, rounded_ratio_sql,
)


AGGREGATES = {"sum": "sum", "values": "count", "labels": "collect_set"}


@dataclass(frozen=True)
class Term:
    kind: str                 # rows | sum | values | distinct | labels
    value: str = "1"
    where: str | None = None
    zero: bool = False        # count rows outside ``where`` as 0 rather than NULL

    @property
    def additive(self) -> bool:
        return self.kind not in ("distinct", "labels")

    def first_sql(self) -> str:
        """The aggregate over row-level input."""
        value = self.value
        if self.kind == "rows":
            return f"count_if({self.where})" if self.where else "count(1)"
        if self.kind == "sum" and value in MONEY:
            return money_sum_sql(value, self.where, self.zero)
        if self.where:
            value = f"CASE WHEN {self.where} THEN {value}{' ELSE 0' if self.zero else ''} END"
        if self.kind == "distinct":
            return f"count(DISTINCT {value})"
        return f"{AGGREGATES[self.kind]}({value})"

    def first(self) -> Column:
        return F.expr(self.first_sql())

    def again(self, partial: str) -> Column:
        """The aggregate that merges values of :meth:`first`."""
        if self.kind in ("rows", "values"):
            return F.expr(f"cast(coalesce(sum({partial}), 0) AS bigint)")
        return F.expr(f"sum({partial})")


@dataclass(frozen=True)
class Measure:
    name: str
    top: Term
    bottom: Term | None = None
    scale: int = 1
    places: int | None = None
    empty: float | None = None     # what an empty denominator or sum becomes
    blank_zero: bool = False       # a count of 0 is shown as NULL (semantic-layer blank)
    exact: bool = False            # keep a sum as DECIMAL, for figures computed from it

    def terms(self):
        return (self.top,) if self.bottom is None else (self.top, self.bottom)

    def finish_sql(self, column_of) -> str:
        """The figure from the columns that hold its terms."""
        top = column_of(self.top)
        if self.bottom is not None:
            bottom = column_of(self.bottom)
            if self.places is None:
                out = plain_ratio_sql(top, bottom, self.scale)
            else:
                out = rounded_ratio_sql(top, bottom, self.places, self.scale)
        elif self.top.kind == "sum":
            out = top if self.exact else f"cast({top} AS double)"
        elif self.top.kind == "labels":
            out = f"array_join(sort_array({top}), ',')"
        else:
            out = f"cast({top} AS bigint)"
        if self.empty is not None:
            out = f"coalesce({out}, {self.empty}D)"
        return f"nullif({out}, 0)" if self.blank_zero else out

    def finish(self, column_of) -> Column:
        return F.expr(self.finish_sql(column_of)).alias(self.name)

    def named(self, name: str) -> "Measure":
        return replace(self, name=name)


# ---------------------------------------------------------------------------
# Conditions
# ---------------------------------------------------------------------------
OK = "status = 'Success'"
BAD = "status = 'Failed'"
PENDING = "status = 'Pending'"
FLAGGED = "is_flagged"
REFUNDED = "is_refunded"


# ---------------------------------------------------------------------------
# Builders
# ---------------------------------------------------------------------------
def rows(name, where=None, blank_zero=False):
    return Measure(name, Term("rows", where=where), blank_zero=blank_zero)


def count_of(name, value):
    """Rows in which ``value`` is not NULL."""
    return Measure(name, Term("values", value))


def total(name, value, where=None, zero=True, empty=None, exact=False):
    """Sum of ``value``; rows outside ``where`` add 0 (``zero``) or nothing."""
    return Measure(name, Term("sum", value, where, zero and where is not None), empty=empty,
                   exact=exact)


def mean(name, value, where=None, places=None, empty=None):
    return Measure(name, Term("sum", value, where), Term("values", value, where),
                   places=places, empty=empty)


def rate(name, hit, of=None, scale=100, places=None, empty=None):
    """Rows meeting ``hit`` per row meeting ``of``."""
    return Measure(name, Term("rows", where=hit), Term("rows", where=of), scale, places, empty)


def distinct(name, value):
    return Measure(name, Term("distinct", value))


def labels(name, value):
    """The distinct values of a label column, sorted and joined; for small domains."""
    return Measure(name, Term("labels", value))


def per(name, top, bottom, scale=1, places=None, empty=None):
    """One single-term measure over another."""
    return Measure(name, top.top, bottom.top, scale, places, empty)
