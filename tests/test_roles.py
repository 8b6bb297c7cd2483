import pytest
from pyspark.sql import functions as F

from matchloom.operators import ranking, roles
from tests.conftest import rows


def shares(spark, values, names, make=roles.role_contribution, dtype="double"):
    columns = ", ".join(f"{n} {dtype}" for n in names)
    data = spark.createDataFrame(values, f"DS string, MATCHID string, {columns}")
    made = make(data, {n: F.col(n) for n in names})
    return {r["ROLE"]: r[-1] for r in made.collect()}


NAMES = ["TOP_KILLS_DIF", "JUNGLE_DRAGON_DIF", "OTHER_DIF"]


def test_share_over_all_features(spark):
    assert shares(spark, [("d", "m", 1.0, -1.0, 2.0)], NAMES) == {
        "TOP": 25.0, "JNG": 25.0, "MID": 0.0, "BOT": 0.0, "SUP": 0.0,
    }
    assert shares(spark, [("d", "m", 0.0, 0.0, 0.0)], NAMES) == dict.fromkeys(
        ("TOP", "JNG", "MID", "BOT", "SUP"), 20.0
    )


def test_basis_points_agree(spark):
    got = shares(spark, [("d", "m", 1, -1, 1)], NAMES, roles.role_basis_points, "long")
    assert got["TOP"] == got["JNG"] == 3333 and got["SUP"] == 0
    got = shares(spark, [("d", "m", 0, 0, 0)], NAMES, roles.role_basis_points, "long")
    assert set(got.values()) == {2000}


def test_share_over_listed_features(spark):
    def listed(values):
        columns = ", ".join(f"{n} double" for n in NAMES)
        data = spark.createDataFrame(values, columns)
        made = roles.role_share_listed(data, {n: F.col(n) for n in NAMES})
        return {r["ROLE"]: r["MEAN_PCT"] for r in made.collect()}

    assert listed([(1.0, -1.0, 2.0)]) == {"TOP": 50.0, "JNG": 50.0}
    assert listed([(0.0, 0.0, 2.0)]) == {"TOP": 0.0, "JNG": 0.0}
    assert listed([(1.0, 0.0, 2.0), (0.0, 0.0, 0.0)]) == {"TOP": 50.0, "JNG": 0.0}


@pytest.mark.parametrize(
    "name, role",
    [
        ("X_STOP_DIF", "TOP"), ("BOTTOM_GOLD_RATE_DIF", "BOT"), ("adc_x", "BOT"),
        ("UTILITY_X", "SUP"), ("MIDDLE", "MID"), ("JNG_TOP", "TOP"), ("OTHER", None),
    ],
)
def test_role_of_a_name(spark, name, role):
    assert rows(spark.range(1).select(roles.role_of(F.lit(name)))) == [(role,)]


def test_daily_mean(spark):
    data = spark.createDataFrame(
        [("TOP", 10.0), ("TOP", 10.01), ("SUP", 50.0), ("BOT", 50.0)], "ROLE string, CONTRIB_PCT double"
    )
    made = [tuple(r) for r in roles.role_daily_mean(data).collect()]
    assert [r for r, _ in made] == ["BOT", "SUP", "TOP"]


def test_importance_and_ties(spark):
    data = spark.createDataFrame(
        [("x", 1.0, -1.0, 0.0), ("x", 3.0, -3.0, 1.0), ("y", 0.0, 0.0, 9.0)],
        "pos string, b double, a double, pos_2 double",
    )
    values = {n: F.col(n) for n in ("b", "a", "pos_2")}
    top = ranking.top_features(ranking.importance(data, values), 2)
    assert [r["feature"] for r in top.collect()] == ["pos_2", "a"]
    by = ranking.top_features_by(ranking.importance(data, values, ["pos"]), ["pos"], 2)
    assert rows(by, "pos", "rank", "feature") == [
        ("x", 1, "a"), ("x", 2, "b"), ("y", 1, "pos_2"), ("y", 2, "a"),
    ]
