"""Each registered corpus query against its SQL, and what the plans must not contain."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from matchloom.llm.queries import QUERIES
from matchloom.llm.sql import SQL
from tools import check

SF = "/root/testdata/sf0.001"
NATIVE = ("op3_line_dedup", "op10_url_filter")


@pytest.fixture(scope="module")
def database():
    return check.database(SF)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, database, name):
    made = entry.queries()[name](spark, SF)
    assert sorted(made.columns) == sorted(database.sql(SQL[name]).columns)
    assert check.difference(spark, database, name, SF) is None


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", name).group(1)) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", NATIVE)
def test_native_operators_run_no_python(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, SF).explain("formatted")
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", out.getvalue())
