"""Every registered query against DuckDB on the smallest data."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

FOLDER = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.load_queries()))
def test_query(spark, db, name):
    same, note = compare(spark, db, FOLDER, name)
    assert same, note


def test_every_query_has_its_counterpart():
    assert set(entry.load_queries()) == set(entry.load_oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
