"""Mixing sources to target weights by hierarchical budgets."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.shared import (
    broadcast_if_small, materialise, null_safe, running_before, seeded_bucket, seeded_order, words_of,
)

LEVELS = ["domain", "lang", "source"]
LEAF = LEVELS


def domain_of(source: Column, domains: int = 4) -> Column:
    """A source's domain where the table names none: its number modulo ``domains``."""
    number = F.regexp_extract(source, r"(\d{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (number.cast("bigint") % domains).cast("string"))) \
        .otherwise("other")


def _weight(name: Column, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(1).cast("bigint")
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.element_at(table, F.coalesce(name, F.lit(""))), F.lit(1)).cast("bigint")


def _fill(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Splits ``budget`` of each parent among its children by weight, no child above its capacity.

    Children are taken in rising order of capacity per weight; one that its share would
    overfill keeps its capacity, and the shortage goes to the siblings left, by their weights.
    A parent never holds more than its children's capacity, so what the siblings cannot take
    has already gone to the parent's own siblings.  Whole numbers throughout.
    """
    siblings = Window.partitionBy(*parents)
    order = siblings.orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    full = F.col("capacity") * F.col("_weight_left") <= (F.col("budget") - F.col("_before")) * F.col("weight")
    return (
        nodes.withColumn("_before", before).withColumn("_weight_left", weight_left)
        .withColumn("_full", full)
        .withColumn("_rest", F.col("budget") - F.sum(
            F.when(F.col("_full"), F.col("capacity")).otherwise(0)).over(siblings))
        .withColumn("_open", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(siblings))
        .withColumn("budget", F.when(F.col("_full"), F.col("capacity"))
                    .otherwise(F.expr("_rest * weight div greatest(_open, 1)")))
        .drop("_before", "_weight_left", "_full", "_rest", "_open")
    )


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], share: float,
                 max_epochs: int) -> DataFrame:
    """Budgets of (domain, lang, source, supply) leaves, from the root down.

    The root gets ``share`` of all tokens; a leaf can give ``max_epochs`` times its tokens.
    Weights are whole numbers, 1 where none is named.
    """
    tree = leaves.withColumn("capacity", F.col("supply") * int(max_epochs))
    tree = tree.withColumn("leaf_capacity", F.col("capacity"))
    whole = Window.partitionBy()
    per_thousand = round(share * 1000)
    tree = tree.withColumn("budget", F.least(
        F.expr(f"sum(supply) over () * {per_thousand} div 1000"), F.sum("capacity").over(whole)))
    for depth, level in enumerate(LEVELS):
        parents, own = LEVELS[:depth], LEVELS[:depth + 1]
        nodes = tree.groupBy(*own).agg(F.sum("leaf_capacity").alias("capacity"),
                                       F.max("budget").alias("budget"))
        nodes = _fill(nodes.withColumn("weight", _weight(F.col(level), weights.get(level, {}))),
                      parents, level)
        found = nodes.select(*[F.col(k).alias(f"_on_{k}") for k in own], F.col("budget").alias("_budget"))
        tree = tree.join(found, null_safe(tree, found, own)).withColumn("budget", F.col("_budget")) \
            .drop("_budget", *[f"_on_{k}" for k in own])
    supply = F.greatest(F.col("supply"), F.lit(1))
    return tree.select(
        *LEAF, "supply", F.col("budget").alias("quota"),
        F.when(F.col("supply") == 0, 1).otherwise(F.floor(F.col("quota") / supply)).cast("int").alias("epochs"),
    ).withColumn("rest", F.col("quota") - F.col("epochs") * F.col("supply"))


def _order(seed: str, key: str) -> Column:
    """The place of a row in the shuffle of its leaf's last, partial epoch."""
    return seeded_order(seed, F.col("epochs"), F.col(key))


def mixture_plan(docs: DataFrame, weights: dict, share: float = 0.5, max_epochs: int = 2,
                 seed: str = "mix", key: str = "doc_id", domain: Column | None = None,
                 tokens: Column | None = None) -> DataFrame:
    """One stored row per leaf: supply, quota, whole ``epochs``, the ``rest`` of the quota and
    ``cut``, the place in the next epoch's shuffle up to which rows fill that rest.

    Rows of the partial epoch are taken in shuffled order until the rest is reached, so the
    last one may overshoot it; rows that tie with the last one are taken too.
    """
    spark = docs.sparkSession
    rows = materialise(docs.select(
        F.col(key).alias("_id"), (domain_of(F.col("source")) if domain is None else domain).alias("domain"),
        F.col("lang").alias("lang"), F.col("source").alias("source"),
        (F.size(words_of(F.col("text"))) if tokens is None else tokens).cast("bigint").alias("tokens"),
    ), "mixing")
    leaves = materialise(leaf_budgets(
        rows.groupBy(*LEAF).agg(F.sum("tokens").alias("supply")), weights, share, max_epochs), "leaves")
    found = leaves.select(*[F.col(k).alias(f"_on_{k}") for k in LEAF], "epochs", "rest")
    partial = rows.join(broadcast_if_small(found), null_safe(rows, found, LEAF)) \
        .drop(*[f"_on_{k}" for k in LEAF]).filter("rest > 0")
    partial = partial.withColumn("_h", _order(seed, "_id"))
    partial = partial.withColumn("_bucket", seeded_bucket(spark, F.col("_h")))
    partial = running_before(partial, LEAF, "_bucket", ["_h", "_id", "tokens"], "_before", value="tokens")
    cuts = partial.filter("_before < rest").groupBy(*[F.col(k).alias(f"_on_{k}") for k in LEAF]) \
        .agg(F.max("_h").alias("cut"))
    return materialise(leaves.join(cuts, null_safe(leaves, cuts, LEAF), "left")
                       .drop(*[f"_on_{k}" for k in LEAF]), "mixture")


def apply_mixture(docs: DataFrame, plan: DataFrame, seed: str = "mix", key: str = "doc_id",
                  domain: Column | None = None, marks: bool = True) -> DataFrame:
    """The rows of ``docs`` that the plan takes, once for every epoch that takes them.

    With ``marks``, ``mix_domain`` and ``mix_epoch`` are added (in place of columns of that
    name).  A row is judged on its own, against its
    leaf's line of the plan: texts are not shuffled.
    """
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_id"), "lang", "source",
                       (domain_of(F.col("source")) if domain is None else domain).alias("mix_domain"))
    found = plan.select(F.col("domain").alias("_on_domain"), F.col("lang").alias("_on_lang"),
                        F.col("source").alias("_on_source"), F.col("epochs").alias("_epochs"),
                        F.col("cut").alias("_cut"))
    on = [rows["mix_domain"].eqNullSafe(found["_on_domain"]), rows["lang"].eqNullSafe(found["_on_lang"]),
          rows["source"].eqNullSafe(found["_on_source"])]
    place = seeded_order(seed, F.col("_epochs"), F.col("_id"))
    copies = F.col("_epochs") + F.coalesce((place <= F.col("_cut")).cast("int"), F.lit(0))
    epochs = F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))
    taken = rows.join(broadcast_if_small(found), on).select("_row", "mix_domain", F.explode(epochs).alias("mix_epoch"))
    if not marks:
        return taken.select("_row.*")
    own = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("mix_domain", "mix_epoch")]
    return taken.select(*own, "mix_domain", "mix_epoch")


def mix_to_weights(docs: DataFrame, weights: dict, share: float = 0.5, max_epochs: int = 2,
                   seed: str = "mix") -> DataFrame:
    """Documents mixed to the target weights of a domain, language, source tree.

    Defined results: NULL labels are labels of their own with weight 1; a NULL or empty text
    has no tokens, and a leaf without tokens is taken whole once; repeated rows (equal ids)
    share one place in the shuffle and are taken or left together; an empty table gives an
    empty result.  ``docs`` needs doc_id, text, lang and source; other columns pass through.
    """
    return apply_mixture(docs, mixture_plan(docs, weights, share, max_epochs, seed), seed)
