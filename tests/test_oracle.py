import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import differences, duck

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_duckdb(spark, con, name):
    assert differences(queries()[name](spark, FOLDER), con, oracle_sql()[name]) == []


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).limit(1).count() == 1
