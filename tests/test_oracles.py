"""Every registered query against its SQL in the checking engine."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert not entry.entry(spark).isEmpty()
