"""SHAP values as a Spark job.

Path-dependent tree SHAP (Lundberg et al., 2018). A leaf of value c is reached
through the features on its path. For feature j, o_j says whether a row passes
all its tests on the path and z_j is the share of training rows that do.

The values of one outcome of o come from a polynomial: the weights of all subsets
by size, extended by one feature of the path after the other, and unwound by each
feature in turn, O(d^2) for d distinct features. Rows with one outcome have one
result. On short paths a task makes a table of all 2^d outcomes and looks rows
up; on long ones it computes the outcomes that occur in a batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom import workspace
from matchloom.operators import win_model


@dataclass(frozen=True)
class Split:
    """A split: left when ``value <= threshold``, or when it is one of ``left``."""

    feature: int
    threshold: float = 0.0
    left: tuple[float, ...] | None = None

    def goes_left(self, values: np.ndarray) -> np.ndarray:
        if self.left is None:
            return values <= self.threshold
        return np.isin(values, self.left)


@dataclass(frozen=True)
class Leaf:
    """Weighted value, and the tests on the way with side taken and share of rows."""

    value: float
    path: tuple[tuple[Split, bool, float], ...]


#: Distinct features up to which a path gets a table of all outcomes.
TABLE_FEATURES = 6


def path_parts(leaf: Leaf) -> tuple[list[int], np.ndarray]:
    """Distinct features of a path, and the share of rows that pass all tests of each."""
    shares: dict[int, float] = {}
    for test, _, share in leaf.path:
        shares[test.feature] = shares.get(test.feature, 1.0) * share
    features = sorted(shares)
    return features, np.array([shares[f] for f in features])


def path_values(value: float, z: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Phi of a leaf, per outcome (a row of ``o``) and feature."""
    d = len(z)
    o = o.astype(float)
    # weights[:, i]: all subsets of i features, with the part that a Shapley value gives them.
    weights = np.zeros((len(o), d + 1))
    weights[:, 0] = 1.0
    for k in range(d):
        for i in range(k, -1, -1):
            weights[:, i + 1] += o[:, k] * weights[:, i] * (i + 1) / (k + 2)
            weights[:, i] *= z[k] * (k + 1 - i) / (k + 2)
    phi = np.empty((len(o), d))
    for k in range(d):
        passed, failed, rest = np.zeros(len(o)), np.zeros(len(o)), weights[:, d].copy()
        for i in range(d - 1, -1, -1):
            without = rest * (d + 1) / (i + 1)
            passed += without
            rest = weights[:, i] - without * z[k] * (d - i) / (d + 1)
            if z[k]:
                failed += weights[:, i] / (z[k] * (d - i) / (d + 1))
        phi[:, k] = np.where(o[:, k] > 0, passed, failed) * (o[:, k] - z[k]) * value
    return phi


def all_outcomes(d: int) -> np.ndarray:
    return (np.arange(2**d)[:, None] >> np.arange(d)) & 1


def base_value(leaves: Sequence[Leaf]) -> float:
    """Expected margin over the training rows."""
    return float(sum(leaf.value * np.prod([s for _, _, s in leaf.path]) for leaf in leaves))


def leaves_of(spark: SparkSession, model: PipelineModel) -> list[Leaf]:
    """Leaves of a fitted model. What is collected is as large as the model, not the data."""
    trees = win_model.trees_of(model)
    path = f"{workspace.scratch(spark, 'trees')}/model"
    trees.write().save(path)
    nodes: dict[int, dict[int, T.Row]] = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    found: list[Leaf] = []

    def walk(tree: dict, node, weight: float, way: tuple) -> None:
        if node["leftChild"] < 0:
            found.append(Leaf(weight * node["prediction"], way))
            return
        split = node["split"]
        values = split["leftCategoriesOrThreshold"]
        if split["numCategories"] < 0:
            test = Split(split["featureIndex"], threshold=values[0])
        else:
            test = Split(split["featureIndex"], left=tuple(values))
        for child_id, left in ((node["leftChild"], True), (node["rightChild"], False)):
            child = tree[child_id]
            share = child["rawCount"] / node["rawCount"]
            walk(tree, child, weight, (*way, (test, left, share)))

    for tree_id, weight in enumerate(trees.treeWeights):
        walk(nodes[tree_id], nodes[tree_id][0], weight, ())
    return found


def shap_values(
    rows: DataFrame, features: Sequence[str], leaves: Sequence[Leaf], keep: Sequence[str]
) -> DataFrame:
    """``keep`` columns, ``phi`` (one value per feature) and ``base``.

    Reads only the kept columns and the features, in Arrow batches, without a
    shuffle. A missing feature value takes the right branch.
    """
    paths = [(leaf, *path_parts(leaf)) for leaf in leaves if leaf.path]
    tests = list(dict.fromkeys(test for leaf, _, _ in paths for test, _, _ in leaf.path))
    number = {test: i for i, test in enumerate(tests)}
    compiled = [
        (leaf.value, used, z, [[(number[t], left) for t, left, _ in leaf.path if t.feature == f] for f in used])
        for leaf, used, z in paths
    ]
    base = base_value(leaves)
    width = len(features)
    kept = len(keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [
            path_values(value, z, all_outcomes(len(used))) if len(used) <= TABLE_FEATURES else None
            for value, used, z, _ in compiled
        ]
        for batch in batches:
            size = batch.num_rows
            columns = [
                batch.column(kept + i).to_numpy(zero_copy_only=False).astype(float)
                for i in range(width)
            ]
            left = [test.goes_left(columns[test.feature]) for test in tests]
            right = [~side for side in left]
            phi = np.zeros((width, size))
            for (value, used, z, conditions), table in zip(compiled, tables):
                outcome = []
                for needed in conditions:
                    passed = None
                    for test, goes_left in needed:
                        side = left[test] if goes_left else right[test]
                        passed = side if passed is None else passed & side
                    outcome.append(passed)
                if table is None:
                    found, at = np.unique(np.stack(outcome, axis=1), axis=0, return_inverse=True)
                    values = path_values(value, z, found)
                    at = at.ravel()
                else:
                    at = np.zeros(size, np.uint8)
                    for bit, passed in enumerate(outcome):
                        at |= passed.astype(np.uint8) << np.uint8(bit)
                    at, values = at.astype(np.intp), table
                for bit, feature in enumerate(used):
                    phi[feature] += values[:, bit][at]
            offsets = pa.array(np.arange(size + 1, dtype=np.int32) * width)
            values = pa.ListArray.from_arrays(offsets, pa.array(phi.T.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(kept)], values, pa.array(np.full(size, base))],
                names=[*keep, "phi", "base"],
            )

    chosen = rows.select(*keep, *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    schema = T.StructType(
        [
            *chosen.schema.fields[:kept],
            T.StructField("phi", T.ArrayType(T.DoubleType())),
            T.StructField("base", T.DoubleType()),
        ]
    )
    return chosen.mapInArrow(score, schema)


def explain(
    model: PipelineModel, rows: DataFrame, keep: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """SHAP values of a fitted model on rows, and the feature of each place in ``phi``.

    The model is a pipeline, or one that gives its own ``leaves``, ``names`` and ``ready`` rows.
    """
    spark = rows.sparkSession
    if not isinstance(model, PipelineModel):
        columns = [f"_f{i}" for i in range(len(model.names()))]
        return shap_values(model.ready(rows), columns, model.leaves(), keep), model.names()
    names = win_model.feature_columns(model)
    ready = win_model.with_feature_columns(model, rows)
    valued = shap_values(ready, names, leaves_of(spark, model), keep)
    return valued, [n.removesuffix("_index") for n in names]


def phi_columns(names: Sequence[str]) -> dict[str, Column]:
    """Each feature's place in ``phi`` as a column."""
    return {name: F.get("phi", F.lit(i)) for i, name in enumerate(names)}


def linear_shap(rows: DataFrame, weights: dict[str, float]) -> dict[str, Column]:
    """Exact SHAP of a linear model, ``w * (x - mean x)``. The means are one row, read
    as a scalar subquery."""
    means = rows.agg(
        F.struct(*[F.avg(name).alias(name) for name in weights]).alias("means")
    ).scalar()
    return {name: F.lit(w) * (F.col(name) - means[name]) for name, w in weights.items()}


def shap_long(
    rows: DataFrame, keep: Sequence[str], values: dict[str, Column], phi: dict[str, Column]
) -> DataFrame:
    """``(feature, value, phi)`` per row: the data behind a SHAP dot plot."""
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                values[name].cast("double").alias("value"),
                phi[name].alias("phi"),
            )
            for name in values
        ]
    )
    return rows.select(*keep, F.explode(cells).alias("_cell")).select(*keep, "_cell.*")


#: Size of the sketches behind a dot plot: ranks are off by about 1.33 / DOT_SKETCH ** 0.9 of the rows.
DOT_SKETCH = 400


def quantiles(rows: DataFrame, columns: dict[str, Column], bins: int) -> DataFrame:
    """One row: for each name the inner ``bins``-quantiles of its column, out of sketches that merge over tasks."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    made = rows.agg(*[F.kll_sketch_agg_double(c.cast("double"), DOT_SKETCH).alias(n) for n, c in columns.items()])
    return made.select(
        *[F.when(F.kll_sketch_get_n_double(n) > 0, F.kll_sketch_get_quantile_double(n, shares)).alias(n) for n in columns]
    )


def place(value: Column, edges: Column) -> Column:
    """How many edges are less than a value."""
    return F.size(F.filter(edges, lambda e: e < value))


def dot_plot(rows: DataFrame, values: dict[str, Column], phi: dict[str, Column], bins: int = 50) -> DataFrame:
    """The dots of a SHAP plot in at most ``bins`` rows per feature: ``feature, bin, rows, low, high, mean_phi, colour``.

    A bin is a range between quantiles of the feature's contributions, ``low`` to ``high`` of them; ``colour`` is the
    mean rank, 0 to 1, that its rows' values have among all values of the feature. Rows without a contribution are
    in no bin; a missing value has no colour. Both scales are KLL sketches, so nothing is sorted.
    """
    marked = {f"v{i}": values[n] for i, n in enumerate(phi)} | {f"p{i}": phi[n] for i, n in enumerate(phi)}
    rows = rows.select(*[c.cast("double").alias(n) for n, c in marked.items()])
    edges = quantiles(rows, {n: F.col(n) for n in marked}, bins).first()  # 2 * bins numbers per feature
    cells = []
    for i, name in enumerate(phi):
        value, part = F.col(f"v{i}"), F.col(f"p{i}")
        if edges[f"p{i}"] is None:
            continue
        of_values = F.array(*[F.lit(e) for e in edges[f"v{i}"] or []]).cast("array<double>")
        of_parts = F.array(*[F.lit(e) for e in edges[f"p{i}"]])
        cells.append(
            F.struct(
                F.lit(name).alias("feature"), place(part, of_parts).alias("bin"), part.alias("phi"),
                F.when(value.isNotNull(), place(value, of_values) / F.lit(bins - 1.0)).alias("colour"),
            )
        )
    if not cells:
        return rows.sparkSession.createDataFrame(
            [], "feature string, bin int, rows long, low double, high double, mean_phi double, colour double"
        )
    long = rows.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where("phi is not null")
    return long.groupBy("feature", "bin").agg(
        F.count("*").alias("rows"), F.min("phi").alias("low"), F.max("phi").alias("high"),
        F.avg("phi").alias("mean_phi"), F.avg("colour").alias("colour"),
    )
