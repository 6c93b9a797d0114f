"""The grouped-report operator.

A :class:`Report` names its keys, measures, filter, order and limit.  :func:`run`
turns it into one ``groupBy``.  When a key is an attribute of a dimension, the
fact is first reduced per foreign key, so that the join and its shuffle move one
row per key instead of one per transaction and a user holding a third of all
rows costs no more than any other.
"""

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.measures import Term
from tallyspark.functions.rates import plain_ratio_sql, rounded_ratio_sql
from tallyspark.operators.levels import level_rank, reindex


@dataclass(frozen=True)
class Dimension:
    """A table joined on ``key`` when a report asks for one of its attributes."""

    table: DataFrame
    key: str
    how: str = "inner"
    fixed_size: bool = False   # row count bounded by construction: may be broadcast


@dataclass(frozen=True)
class Share:
    """A measure as a share of its sum (or of its largest value) over all groups."""

    name: str
    of: Term
    scale: int = 100
    places: int | None = 2
    against: str = "sum"


@dataclass(frozen=True)
class Report:
    # A key is a name, (name, SQL text or column builder), or (name, SQL text, form):
    # grouped on the cheap value, shown through ``form`` ("{}" is the value) afterwards.
    keys: tuple = ()
    measures: tuple = ()
    where: str | None = None
    order: tuple = ()              # "-x" is descending
    limit: int | None = None
    keep_null_keys: bool = True
    shares: tuple = ()
    levels: dict = field(default_factory=dict)    # key -> list, for ordering
    fixed: tuple | None = None     # (key, levels, columns filled with 0)
    after: tuple = ()              # (name, SQL expression) over the finished row
    drop: tuple = ()               # keys grouped on but not shown
    hide_blank: bool = False       # drop groups whose measures are all NULL
    # Subsets of the keys that get rows of their own, () being the grand total.  A column
    # ``all_<key>`` tells a total over a key from a group whose key is NULL.
    margins: tuple = ()
    detail: bool = True            # with margins: keep the rows of the full keys


def run(report: Report, facts: DataFrame, dimensions=(), restrict=()) -> DataFrame:
    """``dimensions`` lend attributes to the keys; ``restrict`` only keep matching rows."""
    keys = [k[:2] if isinstance(k, tuple) else (k, k) for k in report.keys]
    forms = {k[0]: F.expr(k[2].format(f"`{k[0]}`")) for k in report.keys if len(k) == 3
             and isinstance(k, tuple)}
    rows = facts.filter(report.where) if report.where else facts
    used, own, borrowed = _resolve(keys, rows, dimensions)
    rows = rows.withColumns({f"_k{i}": _column(sql) for i, (_, sql) in own})
    own_columns = [f"_k{i}" for i, _ in own]

    for d in [d for d in restrict if d.fixed_size]:
        rows = rows.join(F.broadcast(d.table.select(d.key)), d.key, "left_semi")
    growing = [d for d in used if not d.fixed_size]
    checks = [replace(d, how="left_semi") for d in restrict if not d.fixed_size]
    if growing or checks:
        # A large dimension is joined to the reduced rows.  The small ones go first: their
        # attributes take fewer values than their keys, so the rows reduce further.
        for d in [d for d in used if d.fixed_size]:
            side, names_of = _side(d, borrowed)
            rows = rows.join(F.broadcast(side), d.key, d.how).withColumnsRenamed(names_of)
            own_columns += names_of.values()
            borrowed = [(i, sql) for i, sql in borrowed if sql not in names_of]
        used = growing + checks

    terms = []
    for item in [t for m in report.measures for t in m.terms()] + [s.of for s in report.shares]:
        if item not in terms:
            terms.append(item)
    names = {t: f"_t{i}" for i, t in enumerate(terms)}

    if used or report.margins:
        grouped = _reduce_then_join(rows, used, own_columns, borrowed, terms, names, _sets(report, keys))
    else:
        grouped = rows.groupBy(*own_columns).agg(*[t.first().alias(names[t]) for t in terms])
    grouped = grouped.withColumnsRenamed({
        was: now for i, (name, _) in enumerate(keys) for was, now in ((f"_k{i}", name), (f"_g{i}", f"all_{name}"))})

    if forms:
        grouped = grouped.withColumns(forms)

    if not report.keep_null_keys and keys:
        total = (lambda name: F.col(f"all_{name}")) if report.margins else (lambda name: F.lit(False))
        for name, _ in keys:
            grouped = grouped.filter(F.col(name).isNotNull() | total(name))
    return _present(report, grouped, [name for name, _ in keys], names)


def _resolve(keys, rows, dimensions):
    """Split the keys into those of the fact and those borrowed from a dimension."""
    used, own, borrowed = [], [], []
    for i, (name, sql) in enumerate(keys):
        home = next((d for d in dimensions
                     if sql in d.table.columns and sql not in rows.columns), None)
        if home is None:
            own.append((i, (name, sql)))
            continue
        borrowed.append((i, sql))
        if home not in used:
            used.append(home)
    return used, own, borrowed


def mentions(report: Report) -> str:
    """All SQL text of a report, for finding the derived columns it uses."""
    texts = [report.where or ""]
    for key in report.keys:
        sql = key[1] if isinstance(key, tuple) else key
        texts.append(sql if isinstance(sql, str) else "")
    terms = [t for m in report.measures for t in m.terms()] + [s.of for s in report.shares]
    return " ".join(texts + [f"{t.value} {t.where or ''}" for t in terms])


def _column(key) -> Column:
    return F.expr(key) if isinstance(key, str) else key()


def _side(dimension, borrowed):
    """The columns of a dimension a report needs, and their key names."""
    names_of = {} if dimension.how == "left_semi" else {
        sql: f"_k{i}" for i, sql in borrowed if sql in dimension.table.columns
    }
    return dimension.table.select(dimension.key, *names_of), names_of


def _sets(report, keys):
    """The grouping sets of a report with margins, as key columns; none without."""
    if not report.margins:
        return []
    if report.fixed:
        raise ValueError("a report of fixed levels has no margins")
    wanted = [*([[name for name, _ in keys]] if report.detail else []), *report.margins]
    return [[f"_k{i}" for i, (name, _) in enumerate(keys) if name in chosen] for chosen in wanted]


def _reduce_then_join(rows, used, own_columns, borrowed, terms, names, sets=()):
    """Figures from rows reduced to the report's keys, foreign keys and distinct values.

    With grouping ``sets`` every level is made from the reduced rows, not from the facts: sums
    and counts of rows add up, distinct values are still there to be counted on each level.
    """
    links = list(dict.fromkeys(d.key for d in used))
    counted = [t for t in terms if not t.additive]
    # Distinct values are not additive: keep their column (NULL outside the term's condition,
    # which no distinct count or set takes in) until the last step.
    held = {t: t.value if t.value in links and not t.where else f"_d{i}" for i, t in enumerate(counted)}
    rows = rows.withColumns({c: F.expr(f"CASE WHEN {t.where} THEN {t.value} END" if t.where else t.value)
                             for t, c in held.items() if c not in links})
    additive = [t for t in terms if t.additive]
    marker = [] if additive else [F.count(F.lit(1)).alias("_n")]
    reduced = rows.groupBy(*dict.fromkeys([*own_columns, *links, *held.values()])).agg(
        *[t.first().alias(names[t]) for t in additive], *marker
    )
    for d in used:
        side, names_of = _side(d, borrowed)
        reduced = reduced.join(F.broadcast(side) if d.fixed_size else side, d.key, d.how)
        reduced = reduced.withColumnsRenamed(names_of)
    outputs = []
    for t in terms:
        if t.additive:
            outputs.append(t.again(names[t]).alias(names[t]))
        else:
            merge = F.collect_set if t.kind == "labels" else F.count_distinct
            outputs.append(merge(held[t]).alias(names[t]))
    columns = [*own_columns, *[f"_k{i}" for i, _ in borrowed]]
    if sets:
        marks = [(F.grouping(c) == 1).alias(c.replace("_k", "_g")) for c in columns]
        return reduced.groupingSets(sets, *columns).agg(*outputs, *marks)
    return reduced.groupBy(*columns).agg(*outputs)


def _present(report, grouped, keys, names):
    def column_of(term: Term) -> str:
        return names[term]

    extra, marks = [], [f"all_{k}" for k in keys] if report.margins else []
    level = f"PARTITION BY {', '.join(marks)}" if marks else ""
    for s in report.shares:
        own = column_of(s.of)
        # The window runs over the finished groups of a level: one row per label.
        whole = f"{s.against}({own}) OVER ({level})"
        value = (plain_ratio_sql(own, whole, s.scale) if s.places is None
                 else rounded_ratio_sql(own, whole, s.places, s.scale))
        extra.append(F.expr(value).alias(s.name))
    out = grouped.select(*keys, *marks, *[m.finish(column_of) for m in report.measures], *extra)
    if report.hide_blank:
        out = out.dropna(how="all", subset=[m.name for m in report.measures])
    if report.after:
        out = out.withColumns({name: F.expr(sql) for name, sql in report.after})
    if report.fixed:
        key, levels, fill = report.fixed
        return reindex(out, key, levels, fill)
    if report.order:
        out = out.orderBy(*[c for o in report.order for c in _ordering(o, report.levels, marks)])
    if report.limit is not None:
        out = out.limit(report.limit)
    return out.drop(*report.drop, *[f"all_{k}" for k in report.drop]) if report.drop else out


def _ordering(name, levels, marks=()):
    """Sort columns of one item; totals over a key come after its groups."""
    last = [F.col(f"all_{name.lstrip('-')}")] if f"all_{name.lstrip('-')}" in marks else []
    return [*last, _direction(name, levels)]


def _direction(name, levels):
    descending = name.startswith("-")
    name = name.lstrip("-")
    column = level_rank(name, levels[name]) if name in levels else F.col(name)
    return column.desc_nulls_last() if descending else column.asc_nulls_first()
