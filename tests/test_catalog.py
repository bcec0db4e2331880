"""Every registered query against its SQL on DuckDB."""

import os

import pytest

import __spark_entry__ as contract
import check
from traitloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert check.compare(spark, db, SF, name) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert "species" in df.columns and df.count() > 0
