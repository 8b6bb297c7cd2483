"""Connected components of a table of links, without collecting any of them.

Alternating stars: each node's larger neighbours, then its smaller ones, are linked to the least
node it sees, until nothing changes. A table is written after each round, so a lost executor costs a
re-read, and a path of n nodes takes about log n rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom import workspace


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node that is not the least of its component.

    ``links`` has two bigint columns; order, repeats and links of a node to itself do not matter,
    links with a null are ignored.
    """
    a, b = (F.col(c) for c in links.columns)
    edges = workspace.stored(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    while not is_star(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = workspace.stored(large.distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = workspace.stored(
            small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars"
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def is_star(edges: DataFrame) -> bool:
    """Whether every node has one link to a lesser one that has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or up = 1 and down = 1").isEmpty()
