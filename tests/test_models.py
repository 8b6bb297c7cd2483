from itertools import permutations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from matchloom.operators import explain, features, selection, win_model
from matchloom.plans import influence
from tests.conftest import rows

SMALL = {"maxIter": 5, "maxDepth": 3}
NAMES = ["TOP_KILLS_DIF", "JUNGLE_GOLD_RATE_DIF", "OTHER_DIF"]


@pytest.fixture(scope="module")
def matches(spark):
    """Won by kills, and a bit by gold rate; the third feature is noise."""
    i = F.col("id")
    made = spark.range(0, 2000, 1, 4).select(
        F.lit("2024-05-01").cast("date").alias("ds"),
        F.concat(F.lit("M_"), i).alias("matchid"),
        ((i * 37 % 101) - 50).cast("double").alias("top_kills_dif"),
        ((i * 53 % 89) / 89 - 0.5).alias("jungle_gold_rate_dif"),
        F.when(i % 50 == 0, None).otherwise((i * 71 % 97).cast("double")).alias("other_dif"),
    )
    score = F.col("top_kills_dif") + 40 * F.col("jungle_gold_rate_dif")
    return made.withColumn("blue_team_win", (score > 0).cast("int"))


@pytest.fixture(scope="module")
def model(matches):
    return win_model.train_win_model(matches, **SMALL)


def test_model_learns_and_is_read_back(matches, model, tmp_path):
    path = str(tmp_path / "model")
    win_model.save(model, path)
    loaded = win_model.load(path)
    assert win_model.feature_columns(loaded) == NAMES
    upper = selection.drop_incomplete(selection.upper_columns(matches))
    right = loaded.transform(upper).where("prediction = BLUE_TEAM_WIN").count()
    assert right / upper.count() > 0.9


def test_values_and_base_sum_to_the_margin(matches, model):
    upper = selection.drop_incomplete(selection.upper_columns(matches))
    valued, names = explain.explain(model, upper, ["MATCHID"])
    assert names == NAMES
    margin = model.transform(upper).select(
        "MATCHID", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("margin")
    )
    joined = valued.join(margin, "MATCHID")
    gap = joined.select(
        F.max(F.abs(F.aggregate("phi", F.lit(0.0), lambda a, b: a + b) + F.col("base") - F.col("margin")))
    ).first()[0]
    assert gap < 1e-9
    assert valued.count() == upper.count()


def test_incomplete_rows_are_scored_but_not_trained_on(matches, model):
    made = influence.contributions(model, matches)
    assert made.count() == 5 * matches.count()
    assert made.columns == ["DS", "MATCHID", "ROLE", "CONTRIB_PCT"]
    means = influence.role_influence(matches, **SMALL).collect()
    assert [r["ROLE"] for r in means] == ["TOP", "JNG"]
    assert sum(r["MEAN_PCT"] for r in means) == pytest.approx(100, abs=0.05)


def brute_force(leaves, row, width):
    """Shapley values by all orders of arrival, from the leaves' expectations."""

    def expected(known):
        total = 0.0
        for leaf in leaves:
            weight = leaf.value
            for split, left, share in leaf.path:
                if split.feature in known:
                    weight *= float(bool(split.goes_left(row[split.feature : split.feature + 1])[0]) == left)
                else:
                    weight *= share
            total += weight
        return total

    phi = np.zeros(width)
    orders = list(permutations(range(width)))
    for order in orders:
        known = set()
        for feature in order:
            before = expected(known)
            known.add(feature)
            phi[feature] += expected(known) - before
    return phi / len(orders)


def test_values_equal_brute_force(spark):
    a, b = explain.Split(0, threshold=3.0), explain.Split(1, left=(0.0, 2.0))
    c, deep = explain.Split(2, threshold=0.5), explain.Split(0, threshold=1.0)
    leaves = [
        explain.Leaf(4.0, ((a, True, 0.6), (b, True, 0.3), (deep, True, 0.4))),
        explain.Leaf(-3.0, ((a, True, 0.6), (b, True, 0.3), (deep, False, 0.6))),
        explain.Leaf(1.0, ((a, True, 0.6), (b, False, 0.7))),
        explain.Leaf(2.5, ((a, False, 0.4), (c, True, 0.25))),
        explain.Leaf(-0.5, ((a, False, 0.4), (c, False, 0.75))),
        explain.Leaf(0.7, ()),
    ]
    points = [(float(x), float(y), float(z)) for x in (0, 2, 5) for y in (0, 1, 2) for z in (0, 1)]
    data = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x double, y double, z double")
    made = explain.shap_values(data, ["x", "y", "z"], leaves, ["id"]).collect()
    assert len(made) == len(points)
    for row in made:
        point = np.array(points[row["id"]])
        assert row["phi"] == pytest.approx(brute_force(leaves, point, 3), abs=1e-12)
        assert row["base"] == pytest.approx(explain.base_value(leaves))


def test_missing_value_goes_right(spark):
    split = explain.Split(0, threshold=3.0)
    leaves = [explain.Leaf(1.0, ((split, True, 0.5),)), explain.Leaf(-1.0, ((split, False, 0.5),))]
    data = spark.createDataFrame([(1, None), (2, float("nan")), (3, 1.0)], "id int, x double")
    made = explain.shap_values(data, ["x"], leaves, ["id"])
    assert rows(made.select("id", F.get("phi", F.lit(0)))) == [(1, -1.0), (2, -1.0), (3, 1.0)]


def test_linear_values(spark):
    data = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 6.0)], "id int, a double, b double")
    phi = explain.linear_shap(data, {"a": 2.0, "b": -1.0})
    assert rows(data.select("id", phi["a"], phi["b"])) == [(1, -2.0, 2.0), (2, 2.0, -2.0)]
    long = explain.shap_long(data, ["id"], {n: F.col(n) for n in phi}, phi)
    assert (1, "a", 1.0, -2.0) in rows(long) and long.count() == 4


@pytest.fixture(scope="module")
def players(spark):
    """TOP is decided by KILLS, UTILITY by WARDS_PM, and MIDDLE has few rows."""
    i = F.col("id")
    position = F.when(i % 20 == 0, "middle").when(i % 2 == 0, "top").otherwise("utility")
    made = spark.range(0, 3000, 1, 4).select(
        F.lit("2024-05-01").cast("date").alias("DS"),
        F.concat(F.lit("M_"), i).alias("MATCHID"),
        F.lit(100).alias("TEAMID"),
        F.lit(1).alias("PARTICIPANTID"),
        position.alias("TEAMPOSITION"),
        (i * 37 % 101).cast("double").alias("KILLS"),
        (i * 53 % 89).cast("double").alias("WARDS_PM"),
        (i * 71 % 97).cast("double").alias("NOISE"),
    )
    won = F.when(F.col("TEAMPOSITION") == "utility", F.col("WARDS_PM") > 44).otherwise(F.col("KILLS") > 50)
    return made.withColumn("WIN", won.cast("int"))


def test_top_features_of_one_model(players):
    upper = players.withColumn("TEAMPOSITION", F.upper("TEAMPOSITION"))
    made = influence.top_features_all(upper, **{**SMALL, "maxIter": 10})
    first = {r["TEAMPOSITION"]: r["feature"] for r in made.where("rank = 1").collect()}
    assert first["TOP"] == "KILLS"
    assert first["UTILITY"] == "WARDS_PM"
    # The position itself is a feature of this model.
    assert "TEAMPOSITION" in {r["feature"] for r in made.collect()}


def test_top_features_of_a_model_per_position(players):
    upper = players.withColumn("TEAMPOSITION", F.upper("TEAMPOSITION"))
    labelled = features.with_position_labels(upper)
    made = influence.top_features_per_position(labelled, top=1, **SMALL)
    assert rows(made, "TEAMPOSITION", "feature") == [("TOP", "KILLS"), ("UTILITY", "WARDS_PM")]
    none = influence.top_features_per_position(labelled, samples=10**6)
    assert none.count() == 0


def test_no_features_no_model(spark):
    with pytest.raises(ValueError):
        win_model.train_win_model(spark.createDataFrame([(1,)], "BLUE_TEAM_WIN int"))


def test_long_paths_sum_to_the_margin(spark):
    """A path of 20 features: no table of 2^20 outcomes, and the values still add up."""
    width = 20
    tests = [explain.Split(i, threshold=0.5) for i in range(width)]
    shares = [0.3 + 0.02 * i for i in range(width)]
    way, leaves = (), []
    for i, test in enumerate(tests):
        leaves.append(explain.Leaf(float(i - 7), (*way, (test, False, 1 - shares[i]))))
        way = (*way, (test, True, shares[i]))
    leaves.append(explain.Leaf(50.0, way))
    data = [(n, *[float((n >> i) % 3 == 0) for i in range(width)]) for n in range(3000)]
    names = [f"x{i}" for i in range(width)]
    given = spark.createDataFrame(data, ["id", *names])
    got = {r["id"]: r for r in explain.shap_values(given, names, leaves, ["id"]).collect()}
    for n, *point in data:
        passed = [x <= 0.5 for x in point]
        first = passed.index(False) if False in passed else width
        assert sum(got[n]["phi"]) + got[n]["base"] == pytest.approx(leaves[first].value, abs=1e-9)


def test_path_values_equal_subsets():
    """The polynomial against the sum over all subsets, a share of 0 among them."""
    from itertools import combinations
    from math import factorial

    z = np.array([0.5, 0.0, 0.3, 0.8, 1.0])
    d = len(z)
    outcomes = explain.all_outcomes(d)
    got = explain.path_values(3.0, z, outcomes)
    for row, o in zip(got, outcomes):
        for i in range(d):
            others = [j for j in range(d) if j != i]
            expected = 0.0
            for size in range(d):
                for inside in combinations(others, size):
                    outside = [j for j in others if j not in inside]
                    weight = factorial(size) * factorial(d - size - 1) / factorial(d)
                    expected += weight * 3.0 * (o[i] - z[i]) * np.prod(o[list(inside)]) * np.prod(z[outside])
            assert row[i] == pytest.approx(expected, abs=1e-12)


def test_dot_plot_is_bounded_and_keeps_every_row(spark):
    given = spark.range(5000).select(
        (F.col("id") % 97).cast("double").alias("a"), F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("b"),
        ((F.col("id") % 97) * 2.0).alias("pa"), F.when(F.col("id") % 2 == 0, -F.col("id").cast("double")).alias("pb"),
    )
    made = explain.dot_plot(given, {"a": F.col("a"), "b": F.col("b")}, {"a": F.col("pa"), "b": F.col("pb")}, bins=10)
    got = {(r["feature"], r["bin"]): r for r in made.collect()}
    assert len([k for k in got if k[0] == "a"]) == len([k for k in got if k[0] == "b"]) == 10
    assert sum(r["rows"] for k, r in got.items() if k[0] == "a") == 5000
    assert sum(r["rows"] for k, r in got.items() if k[0] == "b") == 2500
    colours = [got["a", i]["colour"] for i in range(10)]
    assert colours == sorted(colours) and colours[0] < 0.1 and colours[-1] > 0.9
    assert [got["b", i]["colour"] for i in range(10)] == sorted([got["b", i]["colour"] for i in range(10)], reverse=True)
    assert all(r["low"] <= r["mean_phi"] <= r["high"] for r in got.values())
    assert explain.dot_plot(given.limit(0), {"a": F.col("a")}, {"a": F.col("pa")}).count() == 0


def test_reports_with_leafwise_trees(matches):
    means = influence.role_influence(matches, leafwise=True, trees=3, leaves=4).collect()
    assert [r["ROLE"] for r in means] == ["TOP", "JNG"]
    assert sum(r["MEAN_PCT"] for r in means) == pytest.approx(100, abs=0.05)
