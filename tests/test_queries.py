"""Every query against its SQL check, and the contract of the entry module."""

import pytest

import __spark_entry__ as entry_module
from check import compare, duck
from queries import ORACLES, QUERIES

SLOW = {"score_dispatch", "random_forest", "gradient_boosting", "isolation_forest_fit"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, connection, name):
    found = QUERIES[name](spark, sf_dir).toArrow()
    assert found.num_rows > 0
    assert compare(found, connection.sql(ORACLES[name]).to_arrow_table()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["timestamp", "date", "hora_completa", "service", "requests", "cost"]
    assert result.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
