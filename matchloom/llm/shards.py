"""Contiguous shards of near-equal bytes, from prefix sums over the whole corpus.

Rows are put in one global order by a range exchange of narrow rows (key, size and checksum, never
the text). Each range gives its totals; the prefix sums over these few totals are the offsets of
the ranges, and a running sum inside each range gives the offset of every row. A row goes to the
shard in which the middle of its bytes lies when the corpus is cut at equal targets, so each shard
differs from the target by at most one row's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm.common import byte_size

#: Bytes a row takes besides its text.
ROW_OVERHEAD = 16


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size and checksum of each row. A null text has no bytes and checksum 0."""
    return docs.select(
        F.col(key).alias("doc_id"),
        (byte_size(F.col(text)) + ROW_OVERHEAD).alias("size"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"),
    )


def byte_offsets(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the bytes before a row in key order, ``rank``, the rows before it, and ``total``.

    Null keys come first. Rows of one key are ordered by checksum and size; rows alike in all three
    are interchangeable, and their place in the input spreads them over ranges, so that a key with a
    large part of all rows does not fill one range.
    """
    keys = ["doc_id", "text_crc32", "size", "place"]
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*keys).withColumn("range", F.spark_partition_id())
    # Offsets are read twice; the ranges must be the same both times.
    ranged = workspace.stored(ranged, "ranges")
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (  # one row per range: as many as the exchange has partitions
        ranged.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "range",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy(F.lit(0))).alias("total"),
        )
    )
    within = Window.partitionBy("range").orderBy(*keys)
    return (
        ranged.select(
            *rows.columns,
            "range",
            (F.sum("size").over(within) - F.col("size")).alias("start"),
            (F.row_number().over(within) - 1).cast("long").alias("rank"),
        )
        .join(F.broadcast(totals), "range")
        .select(
            *rows.columns,
            (F.col("start") + F.col("bytes_before")).alias("start"),
            (F.col("rank") + F.col("rows_before")).alias("rank"),
            "total",
        )
    )


def assign(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size, checksum, shard, and its gapless place in the shard.

    Empty input gives no rows. Extra columns of ``docs`` are not read. Shards stay empty only if
    one row is larger than the target or there are fewer rows than shards.
    """
    rows = byte_offsets(sized(docs, key, text)).withColumn(
        "shard",
        F.expr(f"cast({int(shards)} * (2 * start + size) div (2 * total) as int)"),
    )
    rows = workspace.stored(rows.drop("start", "total"), "shards")
    first = rows.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )


def write(docs: DataFrame, path: str, shards: int = 40) -> DataFrame:
    """Write whole documents to a folder per shard, in slot order, and return the assignment.

    ``doc_id`` must be unique and not null here. A shard is one file: its size is the target.
    """
    placed = assign(docs, shards)
    out = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    (
        out.repartition(shards, "shard")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )
    return placed
