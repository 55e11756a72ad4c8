"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    good, note = compare(spark, con, SF_DIR, name)
    assert good, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
