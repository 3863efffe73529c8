"""Every registered query against its SQL, at ``ORACLE_SF`` (default the smallest)."""

from __future__ import annotations

import os

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as contract
from checks.registry import ORACLES as OWN_ORACLES
from checks.registry import QUERIES as OWN_QUERIES

SF_DIR = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(OWN_QUERIES) == set(OWN_ORACLES)
    assert set(OWN_QUERIES) <= set(QUERIES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(OWN_QUERIES))
def test_query_equals_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
