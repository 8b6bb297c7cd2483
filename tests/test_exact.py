"""Exact splits, top rows of hot keys, and exact deduplication of a stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.operators import selection
from matchloom.streaming import exact, gold
from tests.conftest import rows


@pytest.mark.parametrize("salts", [1, 5])
@pytest.mark.parametrize("count", [1, 7, 1000])
def test_top_rows_of_a_hot_key(spark, salts, count):
    draw = random.Random(count)
    data = [(None if i % 50 == 0 else "hot" if i % 3 else f"p{i % 20}", i, draw.randint(0, 30)) for i in range(900)]
    given = spark.createDataFrame(data, "p string, m long, t long").repartition(3)
    got = selection.top_n(given, ["p"], [F.desc("t"), F.asc("m")], count, F.xxhash64("m"), salts)
    expected = []
    for p in {d[0] for d in data}:
        expected += sorted((d for d in data if d[0] == p), key=lambda d: (-d[2], d[1]))[:count]
    assert got.columns == given.columns and rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("bits, top", [(63, 2**63 - 1), (31, 2**31 - 1), (5, 31), (13, 3)])
def test_least_numbers_without_a_sort(spark, bits, top):
    draw = random.Random(bits)
    numbers = sorted(draw.randint(0, top) for _ in range(700))
    given = spark.createDataFrame([(n,) for n in numbers], "n long").repartition(4)
    for count in (1, 2, 350, 699, 700, 900):
        least, met = selection.least_by_hash(given, F.col("n"), count, bits)
        limit = numbers[min(count, 700) - 1]
        expected = [n for n in numbers if n <= limit]
        assert [r[0] for r in rows(given.where(least))] == sorted(expected, key=lambda n: repr((n,))) and met == len(expected)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 1001])
def test_test_part_is_exact(spark, n):
    given = spark.range(n).select(F.col("id").cast("string").alias("k"))
    train, test = selection.exact_split(given, ["k"])
    assert test.count() == -(-n // 5) and train.count() == n - -(-n // 5)
    again = selection.exact_split(given.repartition(3), ["k"])[1]
    assert rows(again) == rows(test)
    assert train.join(test, "k").count() == 0


def batches(spark, tmp_path, drops, schema, **options):
    """Each drop is a batch of a stream of its own start."""
    for drop in drops:
        spark.createDataFrame(drop, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        gold.drain(exact.exact_sink(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["k", "t"], trigger=gold.DRAIN, **options))
    return stream.schema


def at(day, hour=0):
    return dt.datetime(2024, 5, day, hour)


SCHEMA = "k string, t long, arrival timestamp, v int"


@pytest.mark.parametrize("fold_every", [1, 2, 100])
def test_copies_go_and_late_first_arrivals_stay(spark, tmp_path, fold_every):
    drops = [
        [("a", 1, at(2, 5), 1), ("a", 1, at(2, 4), 2), ("a", 1, at(2, 4), 3), (None, 1, at(2), 4), ("b", None, at(2), 5)],
        [("a", 1, at(3), 9), (None, 1, at(3), 9), ("b", None, at(1), 9), ("late", 1, at(1), 6), ("c", 1, at(3), 7)],
        [("late", 1, at(4), 9), ("c", 1, at(4), 9), ("d", 1, at(4), 8)],
    ]
    schema = batches(spark, tmp_path, drops, SCHEMA, fold_every=fold_every)
    out = str(tmp_path / "out")
    kept = rows(exact.kept(spark, out, schema), "k", "t", "v")
    assert kept == sorted([("a", 1, 2), (None, 1, 4), ("b", None, 5), ("late", 1, 6), ("c", 1, 7), ("d", 1, 8)], key=repr)
    counted = rows(exact.counts(spark, out), "batch", "came", "kept", "copies", "late")
    assert counted == [(0, 5, 3, 2, 0), (1, 5, 2, 3, 1), (2, 3, 1, 2, 0)]


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    drops = [[("a", 1, at(2), 1)], [("a", 1, at(3), 9), ("b", 1, at(3), 2)]]
    schema = batches(spark, tmp_path, drops, SCHEMA)
    out = str(tmp_path / "out")
    before = rows(exact.kept(spark, out, schema)), rows(exact.counts(spark, out).where("came > 0"))
    # A crash after the writes and before the checkpoint's commit.
    workspace.removed(spark, str(tmp_path / "ck/commits/1"))
    workspace.removed(spark, str(tmp_path / "ck/commits/.1.crc"))
    batches(spark, tmp_path, [[]], SCHEMA)
    assert (rows(exact.kept(spark, out, schema)), rows(exact.counts(spark, out).where("came > 0"))) == before
