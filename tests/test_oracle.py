"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest

from check_oracle import connect, differences

from __spark_entry__ import entry
from crowdtide.plans.queries import QUERIES
from oracle_queries import ORACLE

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLE[name]) == []


def test_flagship_has_69_windows(spark):
    assert entry(spark).count() == 69
