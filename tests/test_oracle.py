"""Every registered query against its SQL oracle on the smallest data set."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from oracles.catalogue import ORACLES
from tallyspark.plans.registry import QUERIES
from tests.compare import differences, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_the_comparison_notices_a_difference(spark, con):
    sql = entry_module.oracle_sql()["sql_1b_success_by_method"]
    df = entry_module.queries()["sql_1b_success_by_method"](spark, FOLDER)
    assert differences(df.withColumn("total_txn", df.total_txn + 1), sql, con)
    assert differences(df.limit(4), sql, con)
    assert differences(df.drop("total_txn"), sql, con)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), ORACLES[name], con) == ""
