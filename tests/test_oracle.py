"""Every registered query beside its SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from tests.oracle_check import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    out = contract.entry(spark)
    assert out.count() == 150 and len(out.columns) == len(set(out.columns))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_equals_sql(spark, con, key):
    assert compare(spark, con, key, SF) is None
