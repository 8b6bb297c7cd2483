"""Days replaced at one stroke, and days with differing schemas."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom import workspace
from matchloom.sinks import versions
from tests.conftest import rows

ONE, TWO, THREE = (dt.date(2024, 5, d) for d in (1, 2, 3))


def day(spark, ds, data, schema):
    return spark.createDataFrame(data, schema).withColumn("ds", F.lit(ds))


def test_a_reader_sees_old_or_new(spark, tmp_path):
    path = str(tmp_path / "table")
    versions.replace_days(day(spark, ONE, [(1,), (2,)], "x int").unionAll(day(spark, TWO, [(3,)], "x int")), path)
    before = versions.read_days(spark, path)
    new = day(spark, ONE, [(10,)], "x int")
    folders = versions.write_folders(new, path)
    between = versions.read_days(spark, path)
    old = [(1, ONE), (2, ONE), (3, TWO)]
    assert rows(before) == rows(between) == old
    versions.point(spark, path, folders, new.schema)
    assert rows(versions.read_days(spark, path)) == [(10, ONE), (3, TWO)]
    assert rows(before) == old  # a reader that has begun goes on with its files
    assert versions.clean(spark, path) == []
    gone = versions.clean(spark, path, hours=-1)
    assert len(gone) == 1 and rows(versions.read_days(spark, path)) == [(10, ONE), (3, TWO)]
    assert not workspace.exists(spark, gone[0])


def test_differing_schemas(spark, tmp_path):
    path = str(tmp_path / "table")
    versions.replace_days(day(spark, ONE, [(1, 7, 1.5, (1, "a"), [1])], "id int, a int, b float, s struct<p:int,q:string>, l array<int>"), path)
    versions.replace_days(day(spark, TWO, [(2, "x", 2, (2.5,), [2**40], True)], "id long, a string, B short, s struct<p:double>, l array<long>, c boolean"), path)
    versions.replace_days(day(spark, THREE, [(3,)], "ID int"), path)
    made = versions.read_days(spark, path)
    assert made.dtypes == [
        ("id", "bigint"), ("a", "variant"), ("b", "double"), ("s", "struct<p:double,q:string>"), ("l", "array<bigint>"), ("c", "boolean"), ("ds", "date"),
    ]
    got = rows(made.select("id", F.to_json("a"), "b", "s.p", "s.q", "l", "c", "ds"))
    assert got == [(1, "7", 1.5, 1.0, "a", [1], None, ONE), (2, '"x"', 2.0, 2.5, None, [2**40], True, TWO), (3, None, None, None, None, None, None, THREE)]
    assert rows(versions.read_days(spark, path, [THREE])) == [(3, THREE)]
    assert versions.read_days(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize(
    "a, b, both",
    [("int", "tinyint", "int"), ("float", "double", "double"), ("int", "float", "double"), ("bigint", "double", "variant"),
     ("string", "int", "variant"), ("date", "timestamp", "variant"), ("array<int>", "array<string>", "array<variant>"), ("map<string,int>", "struct<a:int>", "variant")],
)
def test_widening(spark, a, b, both):
    kinds = [spark.createDataFrame([], f"x {k}").schema["x"].dataType for k in (a, b)]
    assert versions.widened(*kinds).simpleString() == both
    assert versions.widened(*reversed(kinds)).simpleString() == both
    assert versions.widened(T.NullType(), kinds[0]) == kinds[0]
