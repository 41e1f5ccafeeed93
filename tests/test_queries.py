from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from countermill.plans.oracle import ORACLE
from countermill.plans.queries import QUERIES
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], SF_DIR) is None
