"""Every registered query against its DuckDB equivalent on the generated tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from catalogue import oracle
from catalogue import queries as catalogue
from tests import compare

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no generated tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(DATA)


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_duckdb(spark, duck, name):
    names, rows = compare.spark_rows(entry.queries()[name](spark, DATA))
    expected_names, expected = compare.duckdb_rows(duck, entry.oracle_sql()[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows, "an empty answer proves nothing"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
