"""Stored user sets against counting distinct users again."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import usersets
from tests.data import transactions


def _facts(spark, n=400):
    random.seed(4)
    return transactions(spark, *[{
        "user_id": random.choice([None, "hot", "hot", *[f"u{i}" for i in range(60)]]), "platform": random.choice(["A", "B", None]),
        "payment_method": random.choice(["X", "Y"]), "transaction_datetime": datetime(2023 + i % 2, 1 + i % 12, 1 + i % 28),
        "status": random.choice(["Success", "Failed"]), "amount": f"{i + 1}.25"} for i in range(n)])


@pytest.mark.parametrize("period", ["month", "quarter", "year", None])
@pytest.mark.parametrize("keys", [[], ["platform"], ["payment_method", "platform"]])
def test_every_roll_up_counts_exactly(spark, period, keys):
    facts = _facts(spark)
    sets = usersets.user_sets(facts, ["platform", "payment_method"])
    by = [*([F.trunc("transaction_datetime", period).alias("period_start")] if period else []), *keys]
    want = facts.groupBy(*by).agg(F.count_distinct("user_id").alias("u"), F.count(F.lit(1)).alias("n"),
                                  F.coalesce(F.sum(F.expr("CASE WHEN status = 'Success' THEN amount END")), F.lit(0)).cast("double").alias("r"))
    shown = [*(["period_start"] if period else []), *keys]
    got = sets.figures(period, keys).select(*shown, "unique_users", "transactions", F.coalesce("revenue", F.lit(0.0)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(*shown, "u", "n", "r").collect()), key=str)


def test_numbers_are_dense_and_blocks_add_up(spark):
    facts = transactions(spark, {}).select(*[c for c in transactions(spark, {}).columns if c != "user_id"]) \
        .crossJoin(spark.range(70_000).select(F.concat(F.lit("u"), "id").alias("user_id")))
    numbers = usersets.user_numbers(facts)
    found = numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(found) == (1, 70_000, 70_000)
    sets = usersets.user_sets(facts, numbers=numbers)
    assert sets.table.count() == 3
    assert sets.figures(None).first().unique_users == 70_000


def test_unknown_labels_and_no_rows(spark):
    sets = usersets.user_sets(_facts(spark, 3).limit(0), ["platform"])
    assert sets.figures("month").count() == 0
    with pytest.raises(ValueError, match="city"):
        sets.figures("month", ["city"])
