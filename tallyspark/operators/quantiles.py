"""Exact quantiles and box-plot figures of a money column in two passes.

The first pass keeps a mergeable rank sketch per group, whose quantiles lie within a known rank
error of the true ones: they bracket every value that is asked for.  The second pass counts:
values inside a bracket one by one, all others by the stretch between brackets they fall in.
The counts give the rank of every value inside a bracket, so the selection is exact.  Only the
few values inside brackets are shuffled, never all distinct values of the column.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000      # the sketch errs by at most one rank in so many
MARGIN = 3             # brackets reach so many times further
QUARTILES = (0.25, 0.5, 0.75)


def cents(value: str) -> Column:
    """A two-decimal column as whole cents."""
    return (F.col(value) * 100).cast("bigint")


def brackets(rows: DataFrame, value: str, keys=(), fences=False) -> DataFrame:
    """(keys, brackets): a struct of the ends of every bracket, in cents, per group.

    Bracket i holds from ``low<i>`` up to, not including, ``high<i>``.  With ``fences`` there
    are also brackets for the ends of the box plot's reach, which follow from
    those of the quartiles.  A group of fewer rows than the sketch has steps is one bracket:
    there the reach of a bracket would be less than a rank.
    """
    wanted = [min(1.0, max(0.0, p + side * MARGIN / ACCURACY)) for p in QUARTILES for side in (-1, 1)]
    sketch = F.percentile_approx(cents(value), wanted, ACCURACY)
    found = rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        sketch.alias("_q"), F.count(F.lit(1)).alias("_n"), F.min(cents(value)).alias("_min"), F.max(cents(value)).alias("_max"))
    few = F.col("_n") < ACCURACY
    low = {p: F.when(few, F.col("_min")).otherwise(F.col("_q")[2 * i]) for i, p in enumerate(QUARTILES)}
    high = {p: F.when(few, F.col("_max")).otherwise(F.col("_q")[2 * i + 1]) for i, p in enumerate(QUARTILES)}
    pairs = [(low[p], high[p]) for p in QUARTILES]
    if fences:
        widest, narrowest = high[0.75] - low[0.25], low[0.75] - high[0.25]
        pairs.append((low[0.25] - 1.5 * widest, high[0.25] - 1.5 * narrowest))
        pairs.append((low[0.75] + 1.5 * narrowest, high[0.75] + 1.5 * widest))
    # Fences are rounded to a hundredth of a cent: one cent more on each side holds that, too.
    ends = [end for i, (a, b) in enumerate(pairs) for end in (
        (F.floor(a) - 1).cast("bigint").alias(f"low{i}"), (F.ceil(b) + 2).cast("bigint").alias(f"high{i}"))]
    return found.select(*keys, F.struct(*ends).alias("brackets"))


def counted(rows: DataFrame, value: str, keys=(), fences=False) -> DataFrame:
    """(keys, least, most, n, sum, squares, first_rank, last_rank, total): the column in order.

    A row is either one value inside a bracket or a whole stretch between brackets.  Groups are
    joined to their bounds, one row per group: ``keys`` are flags of a few values.
    """
    own = [f"_b_{k}" for k in keys]
    bounds = brackets(rows, value, keys, fences).select(*[F.col(k).alias(b) for k, b in zip(keys, own)], "brackets")
    kept = rows.filter(F.col(value).isNotNull()).select(*keys, cents(value).alias("cents"))
    if keys:
        same = [F.col(k).eqNullSafe(F.col(b)) for k, b in zip(keys, own)]
        kept = kept.join(F.broadcast(bounds), same).drop(*own)
    else:
        kept = kept.withColumn("brackets", bounds.scalar())
    at = F.col("cents")
    ends = [(F.col(f"brackets.low{i}"), F.col(f"brackets.high{i}")) for i in range(len(QUARTILES) + 2 * fences)]
    inside, passed = F.lit(False), F.lit(0)
    for low, high in ends:
        inside = inside | ((at >= low) & (at < high))
        passed = passed + (at >= low).cast("int") + (at >= high).cast("int")
    exact = at.cast("decimal(20,0)")
    table = kept.groupBy(*keys, passed.alias("_stretch"), F.when(inside, at).alias("_value")).agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("least"), F.max(at).alias("most"),
        F.sum(exact).alias("sum"), F.sum((exact * exact).cast("decimal(30,0)")).alias("squares"))
    # A group's window holds its stretches and the distinct values inside its brackets.
    group = Window.partitionBy(*keys)
    upto = group.orderBy("least").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = table.withColumns({"_upto": F.sum("n").over(upto), "total": F.sum("n").over(group)})
    return table.select(*keys, "least", "most", "n", "sum", "squares", "total",
                        (F.col("_upto") - F.col("n")).alias("first_rank"), (F.col("_upto") - 1).alias("last_rank"))


def quantile(p: float, over=None) -> Column:
    """The linearly interpolated quantile of :func:`counted` rows, in units: an aggregate, or a
    window function ``over`` a group."""
    position = F.lit(float(p)) * (F.col("total") - 1)

    def best(column):
        return F.max(column) if over is None else F.max(column).over(over)

    def at(rank):
        hit = (F.col("first_rank").cast("double") <= rank) & (F.col("last_rank").cast("double") >= rank)
        # The sketch's error is bounded, so a rank never falls into a stretch of several values.
        value = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(
            F.raise_error(F.lit("a quantile fell outside its bracket")).cast("bigint"))
        return best(F.when(hit, value)) / F.lit(100.0)

    low, high = at(F.floor(position).cast("double")), at(F.ceil(position).cast("double"))
    return low + (high - low) * best(position - F.floor(position))


def numeric_profile(rows: DataFrame, value: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of the whole column."""
    figures = counted(rows, value).agg(
        F.sum("n").alias("count"), F.sum("sum").alias("_total"), F.sum("squares").alias("_squares"),
        (F.min("least") / F.lit(100.0)).alias("min"), (F.max("most") / F.lit(100.0)).alias("max"),
        *[quantile(p).alias(name) for name, p in zip(("q25", "q50", "q75"), QUARTILES)],
    )
    size = F.col("count").cast("double")
    mean = F.col("_total").cast("double") / 100 / size
    spread = F.col("_squares").cast("double") / 10000 - size * mean * mean
    return figures.select(
        "count",
        F.round(mean, 4).alias("mean"),
        F.round(F.sqrt(F.try_divide(spread, size - 1)), 4).alias("std"),
        "min", *[F.round(q, 4).alias(q) for q in ("q25", "q50", "q75")], "max",
    )


def box_stats(rows: DataFrame, value: str, by: str, with_mean=False) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and the number of outliers for each value of a flag.

    ``by`` is a boolean, so the table of brackets that is broadcast has at most two rows.  The
    fences have brackets of their own: a stretch lies on one side of them.
    """
    group = Window.partitionBy(by)
    table = counted(rows.filter(F.col(by).isNotNull()), value, [by], fences=True)
    table = table.withColumns({name: F.round(quantile(p, group), 4)
                               for name, p in zip(("q1", "median", "q3"), QUARTILES)})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.round(F.col("q1") - reach, 4), F.round(F.col("q3") + reach, 4)
    least, most = F.col("least") / F.lit(100.0), F.col("most") / F.lit(100.0)
    inside = least.between(low, high)
    mean = F.sum("sum").cast("double") / 100 / F.sum("n")
    return table.groupBy(by, "q1", "median", "q3").agg(
        F.sum("n").alias("n_rows"),
        F.min(F.when(inside, least)).alias("whisker_low"),
        F.max(F.when(inside, most)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
        *([F.round(mean, 4).alias("mean")] if with_mean else []),
    )
