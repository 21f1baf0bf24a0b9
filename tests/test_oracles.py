"""Every registered query equals its SQL equivalent: types, rows and values."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as entry
from tools.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, name, SF) == []


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
