"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as contract
import check
from workload.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["external_id", "language", "keyword_ids"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert check.compare(spark, con, SF_DIR, name).startswith("ok")
