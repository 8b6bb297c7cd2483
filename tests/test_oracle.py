"""Each registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from matchloom.plans.catalog import QUERIES
from tools import check

SF = "/root/testdata/sf0.001"
# Fitted models have no SQL; test_models checks what must hold for them.
CHECKED = [n for n in QUERIES if not n.startswith("ml_") or n in entry.oracle_sql()]


@pytest.fixture(scope="module")
def database():
    return check.database(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, database, name):
    assert name in entry.oracle_sql()
    assert check.difference(spark, database, name, SF) is None


def test_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
