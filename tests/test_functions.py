import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchloom.functions import numeric, text, time
from matchloom.operators import selection
from matchloom.sources import tables
from tests.conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize(
    "host, expected",
    [
        ("  abc.aws.snowflakecomputing.com ", "abc"),
        ("HTTPS://abc.snowflakecomputing.com", "abc"),
        ("http://abc", "abc"),
        ("abc.eu-west-1.aws", "abc.eu-west-1"),
        ("ftp://abc", "ftp://abc"),
    ],
)
def test_normalize_host(spark, host, expected):
    assert one(spark, text.normalize_host(F.lit(host))) == expected


def test_mask_secrets(spark):
    pairs = F.create_map(F.lit("passWord"), F.lit("x"), F.lit("user"), F.lit("y"))
    assert one(spark, text.mask_secrets(pairs)) == {"passWord": "***", "user": "y"}


def test_partition_value(spark):
    assert one(spark, text.partition_value(F.lit("s3a://b/x/ds=2024-05-01/part.parquet"))) == "2024-05-01"


def test_variant_of_text_that_is_no_json(spark):
    assert one(spark, text.variant_field(F.lit("{bad"), "$.k", "bigint")) is None
    assert one(spark, text.variant_field(F.lit('{"k": 7}'), "$.k", "bigint")) == 7


@pytest.mark.parametrize(
    "part, total, expected", [(1, 3, 3333), (2, 3, 6667), (1, 8, 1250), (1, 16, 625), (1, 32, 313), (0, 5, 0)]
)
def test_rounded_ratio(spark, part, total, expected):
    got = one(spark, numeric.rounded_ratio(F.lit(part).cast("long"), F.lit(total).cast("long"), 10_000))
    assert got == expected


def test_ratio_by_zero(spark):
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0), None)) is None


def test_utc_date_does_not_follow_the_session_zone(spark):
    late = F.lit(1758153599538)  # 2025-09-17 23:59:59.538 UTC
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        assert one(spark, time.utc_date(late)) == dt.date(2025, 9, 17)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(spark, time.utc_date(F.lit(-1))) == dt.date(1969, 12, 31)


def test_day_bounds_are_inclusive(spark):
    day = F.lit("2024-05-01").cast("date")
    first = 1714521600
    inside = [
        one(spark, time.within_day(F.lit(s), day))
        for s in (first - 1, first, first + 86399, first + 86400)
    ]
    assert inside == [False, True, True, False]


def test_last_days(spark):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-04-10')) as DS")
    assert tables.last_days(days, "DS", "2024-04-10").agg(F.min("DS")).first()[0] == dt.date(2024, 1, 11)
    assert tables.last_days(days, "DS").count() == 0
    assert rows(tables.one_day(days, "DS", "2024-02-29")) == [(dt.date(2024, 2, 29),)]


def test_recent_match_ids(spark):
    start = 1714521600
    data = [("a", start + i, f"M_{i}") for i in range(8)]
    data += [("b", start + 7, "M_7"), ("b", start - 1, "M_old"), ("b", start + 7, "M_7")]
    listed = spark.createDataFrame(data, "puuid string, startTs long, matchId string")
    assert rows(selection.recent_match_ids(listed, 2, "2024-05-01")) == [("M_6",), ("M_7",)]
    assert rows(selection.recent_match_ids(listed, 2)) == [("M_6",), ("M_7",), ("M_old",)]


def test_first_players(spark):
    players = spark.createDataFrame([("c",), ("a",), ("b",)], "puuid string")
    assert rows(selection.first_players(players, limit=2)) == [("a",), ("b",)]
    assert selection.first_players(players).count() == 3


def test_drop_incomplete(spark):
    nan = float("nan")
    data = spark.createDataFrame([(1, 1.0), (2, nan), (3, None), (None, 1.0)], "a int, b double")
    assert rows(selection.drop_incomplete(data)) == [(1, 1.0)]
    assert rows(data.na.drop("any")) == [(1, 1.0)]
    assert rows(selection.drop_incomplete(data, ["a"]), "a") == [(1,), (2,), (3,)]
    assert rows(selection.completeness(data)) == [(1, 3)]


def test_column_choices(spark):
    data = spark.range(1).selectExpr("1 as a_dif", "2 as a_dif_x", "3 as ds", "4 as win")
    upper = selection.upper_columns(data)
    assert selection.columns_like(upper) == ["A_DIF", "A_DIF_X"]
    assert selection.columns_except(upper) == ["A_DIF", "A_DIF_X"]
    assert selection.present(upper, ["WIN", "X"]) == ["WIN"]
    with pytest.raises(ValueError):
        selection.require_features([])


def test_position_label(spark):
    data = spark.createDataFrame(
        [("top", 1, 2, 3, 4, 5), ("Bottom", 1, 2, 3, 4, 5), ("other", 1, 2, 3, 4, 5)],
        "p string, TOP_LABEL int, JUNGLE_LABEL int, MID_LABEL int, ADC_LABEL int, SUP_LABEL int",
    )
    got = rows(data.select("p", selection.position_label(F.col("p")).alias("label")))
    assert got == [("Bottom", 4), ("other", None), ("top", 1)]


def test_split_is_stable_and_whole(spark):
    data = spark.range(10000)
    train, test = selection.stable_split(data, ["id"])
    again, _ = selection.stable_split(data.repartition(7), ["id"])
    assert train.count() + test.count() == 10000
    assert abs(test.count() - 2000) < 200
    assert rows(train) == rows(again)


def test_load_counts(spark):
    asked = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "id string")
    landed = spark.createDataFrame([("b",), ("b",), ("x",)], "id string")
    assert rows(selection.load_counts(asked, landed, "id")) == [(3, 1)]
