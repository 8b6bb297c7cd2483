"""Cross-site boilerplate lines, by how many sites hold a line.

Each task makes a HyperLogLog sketch of the sites for every line hash it meets; the aggregation merges
them. The estimate decides lines well above and well below the limit. Lines whose estimate is within
``MARGIN`` of it, more than six deviations of the sketch, get an exact count of distinct sites, so the
result is that of exact counts everywhere. Boilerplate lines then leave all documents.

Everything is DataFrame functions. A line with a third of all rows is one sketch per task after the
map-side merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm.common import free_name

#: A line on at least so many sites is boilerplate.
MIN_SITES = 10
#: Logarithm of the sketch size; its deviation is 1.04 / sqrt(2**10), 3.3 %.
LOG_SIZE = 10
#: Part of the limit within which lines are counted exactly.
MARGIN = 0.25
#: Most boilerplate lines that are broadcast to the documents; 16 bytes each and about 80 in a hash table.
BROADCAST_LINES = 500_000


def hashed_lines(docs: DataFrame, row: str, text: str, site: str) -> DataFrame:
    """``row, at, line, h1, h2, site``: every line of every text that isn't null, with a 128-bit hash."""
    rows = docs.select(
        F.col(row).alias("row"),
        # Null sites are a site of their own.
        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("null")).alias("site"),
        F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("at", "line"),
    )
    return rows.select(
        "row", "at", "line", "site",
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"),
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``h1, h2`` of the lines with a character other than white space on at least ``min_sites`` sites."""
    lines = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("h1", "h2", "site")
    spread = (
        lines.groupBy("h1", "h2")
        .agg(F.hll_sketch_agg("site", LOG_SIZE).alias("sketch"))
        .select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - MARGIN))
    )
    spread = workspace.stored(spread, "spread")
    sure = spread.where(F.col("sites") >= min_sites * (1 + MARGIN)).select("h1", "h2")
    near = spread.where(F.col("sites") < min_sites * (1 + MARGIN)).select("h1", "h2")
    exact = (
        lines.join(near, ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select("h1", "h2")
    )
    return workspace.stored(sure.unionByName(exact), "boilerplate")


def without_boilerplate(
    docs: DataFrame, *, text: str = "text", site: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """The columns of ``docs`` with boilerplate lines out of the text, and ``n_lines``, ``n_removed``.

    ``docs`` must give the same rows in the same partitions each time it is read, as a table does.
    A null text stays null and has no lines; a text of which every line goes becomes empty; blank
    lines stay. Names that ``docs`` already has get an underscore.
    """
    row = free_name(docs, "row_number_")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    lines = hashed_lines(rows, row, text, site)
    gone = boilerplate(lines, min_sites).withColumn("gone", F.lit(True))
    if gone.count() <= BROADCAST_LINES:
        gone = F.broadcast(gone)
    kept = F.collect_list(F.when(F.col("gone").isNull(), F.struct("at", "line")))  # of one text
    rebuilt = (
        lines.select("row", "at", "line", "h1", "h2")
        .join(gone, ["h1", "h2"], "left")
        .groupBy("row")
        .agg(
            F.count("*").alias("lines"),
            F.count("gone").alias("removed"),
            F.array_join(F.transform(F.array_sort(kept), lambda x: x["line"]), "\n").alias("clean"),
        )
        .select(*[F.col(c).alias(f"rebuilt_{c}") for c in ("row", "lines", "removed", "clean")])
    )
    others = rows.drop(text)
    joined = others.join(rebuilt, F.col(row) == F.col("rebuilt_row"), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        *[F.col("rebuilt_clean").alias(c) if c == text else others[c] for c in docs.columns],
        F.coalesce("rebuilt_lines", zero).alias(free_name(docs, "n_lines")),
        F.coalesce("rebuilt_removed", zero).alias(free_name(docs, "n_removed")),
    )
