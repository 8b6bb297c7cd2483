"""Mixing to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents are counted into cells, one per combination of source, language and topic. Raking scales the
cells' token weights to each marginal in turn until all fit. A document of a cell is then kept with the
probability that makes the expected tokens of the cell its raked weight times the budget; cells that
would need more than they have are kept whole and the budget goes on to the others.

Only cells are ever joined to documents. Cells of up to ``LOCAL_CELLS`` are raked in the driver (some
MB); more are raked by Spark jobs, a table per round.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm.common import free_name, unit

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a value: its tokens to this power, so that rare values get more than they have.
TEMPERATURE = {"source": 0.5, "lang": 0.7, "topic": 0.5}
#: Part of all tokens to keep.
BUDGET = 0.5
#: Rounds end when no marginal is off by more than this part, or after so many. A round of Spark jobs
#: costs seconds and not microseconds, so these get fewer.
TOLERANCE, ROUNDS, JOB_ROUNDS = 1e-10, 10_000, 500
#: Most cells that the driver rakes.
LOCAL_CELLS = 200_000


def topic_of(text: Column) -> Column:
    """The form of a text as its topic: ``none``, ``note``, ``list``, ``long`` or ``prose``."""
    words, lines = tokens_of(text), F.size(F.split(text, "\n"))
    return (
        F.when(text.isNull() | (words == 0), "none")
        .when(words < 60, "note")
        .when(words < 12 * lines, "list")
        .when(words >= 1000, "long")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    """Words of a text: runs of other characters than space and \\t to \\r. Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def label(value: Column) -> Column:
    """Null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def targets(tokens: Mapping[str, float], power: float) -> dict[str, float]:
    """Shares of each value by tempered tokens."""
    raised = {value: n**power for value, n in tokens.items() if n > 0}
    total = math.fsum(raised.values())
    return {value: n / total for value, n in raised.items()}


def rake_here(cells: list[tuple], wanted: list[dict[str, float]]) -> tuple[np.ndarray, float]:
    """Raked weights, summing to 1, of (tokens, value, value, ...) rows, and by which part a marginal was
    off at most when the last round came to it."""
    weights = np.array([c[0] for c in cells], float)
    sides = []
    for i, want in enumerate(wanted):
        values = list(want)
        place = {v: k for k, v in enumerate(values)}
        sides.append((np.array([place[c[i + 1]] for c in cells]), np.array([want[v] for v in values])))
    weights /= weights.sum()
    off = 0.0
    for _ in range(ROUNDS):
        off = 0.0
        for at, want in sides:
            now = np.bincount(at, weights, len(want))
            off = max(off, float(np.max(np.abs(now / want - 1))))
            weights = weights * (want / now)[at]
        if off <= TOLERANCE:
            break
    return weights, off


def probabilities_here(tokens: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """min(1, s * weight / tokens) with the s that keeps ``budget`` tokens in expectation."""
    order = np.argsort(tokens / weights, kind="stable")
    have, want = tokens[order], weights[order]
    left = budget - (np.cumsum(have) - have)
    scale = left / np.cumsum(want[::-1])[::-1]
    fits = np.flatnonzero(scale * want <= have)  # the first cell that isn't kept whole
    s = scale[fits[0]] if len(fits) else np.inf
    return np.minimum(1.0, s * weights / tokens)


def rake_jobs(cells: DataFrame, wanted: dict[str, DataFrame], budget: float) -> tuple[DataFrame, float]:
    """The same for cells of any number: adds ``probability`` to the cells; and how much a marginal is off."""
    total = cells.agg(F.sum("tokens")).first()[0]
    now = workspace.stored(cells.withColumn("weight", F.col("tokens") / F.lit(float(total))), "cells")
    off = 0.0
    for _ in range(JOB_ROUNDS):
        off, step = 0.0, now
        for name, want in wanted.items():
            sums = step.groupBy(name).agg(F.sum("weight").alias("has")).join(want, name)
            factors = workspace.stored(sums.select(name, (F.col("share") / F.col("has")).alias("factor")), "factors")
            off = max(off, factors.agg(F.max(F.abs(1 / F.col("factor") - 1))).first()[0] or 0.0)
            step = step.join(factors, name).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")
        now = workspace.stored(step, "raked")
        if off <= TOLERANCE:
            break

    def kept(s: float) -> float:
        return now.agg(F.sum(F.least(F.col("tokens").cast("double"), F.col("weight") * s))).first()[0]

    low, high = 0.0, budget
    while kept(high) < budget * (1 - 1e-12) and high < budget * 2**60:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if kept(middle) < budget else (low, middle)
    chance = F.least(F.lit(1.0), F.col("weight") * high / F.col("tokens"))
    return now.withColumn("probability", chance), off


def mixed(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    tokens: Column | None = None,
    dimensions: Mapping[str, Column] | None = None,
    shares: Mapping[str, Mapping[str, float]] | None = None,
    budget: float = BUDGET,
) -> DataFrame:
    """All columns of ``docs`` and ``n_tokens``, ``topic``, ``probability``, ``marginal_error``, ``sampled``.

    ``marginal_error`` is one number for all rows: the largest part by which the last round found a
    marginal off its target; 0 without tokens.

    ``shares`` gives target shares of a dimension by value; dimensions without use ``TEMPERATURE`` on
    the counted tokens. Values with tokens but without a share in a given target have share 0. Null is a
    value. A document without tokens costs nothing and is kept with probability 1. The draw depends on
    the key alone, so repeated rows stay or go together; a null key draws like an empty one. Names that
    ``docs`` already has get an underscore.
    """
    text = F.col("text").cast("string")
    dimensions = dict(dimensions or {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(text)})
    names = [free_name(docs, f"cell_{d}") for d in dimensions]
    n = free_name(docs, "n_tokens")
    rows = docs.withColumns(
        {n: tokens if tokens is not None else tokens_of(text), **{c: label(v) for c, v in zip(names, dimensions.values())}}
    )
    cells = workspace.stored(
        rows.where(F.col(n) > 0).groupBy(*names).agg(F.sum(n).alias("tokens")), "cells"
    )
    wanted: dict[str, DataFrame] = {}
    for name, dim in zip(names, dimensions):
        sums = cells.groupBy(name).agg(F.sum("tokens").alias("has"))
        if shares and dim in shares:
            given = [(("null" if v is None else f"={v}"), float(s)) for v, s in shares[dim].items()]
            raised = sums.join(F.broadcast(docs.sparkSession.createDataFrame(given, f"`{name}` string, raised double")), name)
        else:
            raised = sums.withColumn("raised", F.pow(F.col("has").cast("double"), F.lit(TEMPERATURE.get(dim, 1.0))))
        raised = raised.where("raised > 0").select(name, "raised")
        whole = raised.agg(F.sum("raised")).first()[0] or 1.0
        wanted[name] = raised.select(name, (F.col("raised") / F.lit(whole)).alias("share"))
    listed = reduce(lambda c, name: c.join(wanted[name].select(name), name, "left_semi"), names, cells)
    most = cells.agg(F.sum("tokens")).first()[0] or 0
    counted = listed.limit(LOCAL_CELLS + 1).count()
    if counted <= LOCAL_CELLS:
        found = sorted((tuple(r) for r in listed.select("tokens", *names).collect()), key=lambda r: r[1:])
        want = [dict(sorted(tuple(r) for r in wanted[name].join(listed, name, "left_semi").collect())) for name in names]
        chance, off = np.empty(0), 0.0
        if found:
            want = [{v: s / math.fsum(w.values()) for v, s in w.items()} for w in want]
            weights, off = rake_here(found, want)
            chance = probabilities_here(np.array([c[0] for c in found], float), weights, budget * most)
        schema = ", ".join(f"`{name}` string" for name in names) + ", probability double"
        local = [(*c[1:], float(p)) for c, p in zip(found, chance)]
        odds = F.broadcast(docs.sparkSession.createDataFrame(local, schema))  # at most LOCAL_CELLS rows
    else:
        raked, off = rake_jobs(listed, wanted, budget * most)
        odds = raked.select(*names, "probability")
    p = free_name(docs, "probability")
    odds = odds.withColumnRenamed("probability", p)
    out = rows.join(odds, names, "left").withColumn(
        p, F.when(F.col(n) == 0, 1.0).otherwise(F.coalesce(F.col(p), F.lit(0.0)))
    )
    drawn = unit(F.coalesce(F.col(key).cast("string"), F.lit("")))
    values = [v for d, v in dimensions.items() if d == "topic"]
    return out.select(
        *[F.col(c) for c in docs.columns], n,
        *[v.alias(free_name(docs, "topic")) for v in values],
        p, F.lit(off).alias(free_name(docs, "marginal_error")), (drawn < F.col(p)).alias(free_name(docs, "sampled")),
    )
