"""Every registered query against its SQL over the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from storelake.registry import QUERIES
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, tables, name):
    assert difference(entry_points.queries()[name](spark, SF_DIR), SQL[name], tables) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns[0] == "year_month"
