"""Every registered query next to its DuckDB statement on the smallest data."""

import os
import sys

import pytest
from conftest import ROOT, SF

sys.path.insert(0, os.path.join(ROOT, "tests"))
import compare  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402

from leakscope.catalog import QUERIES  # noqa: E402
from oracle.statements import statements  # noqa: E402

STATEMENTS = statements()


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in STATEMENTS:
        assert compare.compare(df, con, STATEMENTS[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 80


def test_statements_belong_to_queries():
    assert set(STATEMENTS) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
