"""Every registered query that has SQL equals it on the given tables, bit for bit."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from rowsmith.plans.oracle import ORACLE
from rowsmith.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_table_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["user_id", "mean_rolling_mean_cents"] and not result.isEmpty()
