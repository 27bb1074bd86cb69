import importlib
import re

import duckdb
import pytest

entry = importlib.import_module("__spark_entry__")
SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

# One query per layer; all of them are compared at a larger scale outside the tests.
COMPARED = ("scan_custody_positions", "calcs_staking_events", "custody_balances", "fee_accruals", "period_close_gate", "monthly_statement_salted")


def test_every_query_has_sql():
    """Training-data queries that SQL cannot express are held against brute force in tests of their own."""
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 100
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in without)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, duck, name):
    result = entry.queries()[name](spark, SMALL)
    columns = sorted(result.columns)
    answer = duck.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    found = [tuple(row) for row in result.select(*columns).collect()]
    assert found and sorted(map(str, found)) == sorted(map(str, answer))


def test_entry_is_the_statement(spark):
    assert entry.entry(spark).columns[0] == "StatementId"
