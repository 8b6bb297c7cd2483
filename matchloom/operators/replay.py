"""When each frame of a finished match is sent in a replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key with the same ``order div BUCKET`` are ordered in one task. Where
# ``order`` is unique per key that is at most BUCKET rows, however hot the key is;
# the second level then orders one row per bucket.
BUCKET = 1 << 20


def gap(stamp: Column, before: Column) -> Column:
    """Milliseconds since the previous frame, never negative; the first counts from 0."""
    return F.greatest(F.lit(0), stamp - F.coalesce(before, F.lit(0)))


def replay_schedule(timelines: DataFrame, speed: int = 60) -> DataFrame:
    """Gap and send offset per frame of timeline documents, in document order.

    The frames of a match are together in its document, so nothing is shuffled.
    The gap of a frame is waited for after it was sent: its own offset is the
    sum of the gaps before it.
    """
    stamps = F.transform("info.frames", lambda f: F.coalesce(f["timestamp"], F.lit(0)))
    # One pass over the frames carries the last stamp and the sum of the gaps so far.
    zero, frame = F.lit(0).cast("long"), "stamps: bigint, gaps: bigint, offsets: bigint"
    none = F.array().cast(f"array<struct<{frame}>>")

    def sent(state: Column, stamp: Column) -> Column:
        own = gap(stamp, state["last"])
        added = F.struct(stamp.alias("stamps"), own.alias("gaps"), state["sum"].alias("offsets"))
        return F.struct(
            stamp.alias("last"),
            (state["sum"] + own).alias("sum"),
            F.concat(state["frames"], F.array(added)).alias("frames"),
        )

    begin = F.struct(zero.alias("last"), zero.alias("sum"), none.alias("frames"))
    frames = F.aggregate(stamps, begin, sent, lambda state: state["frames"])
    return (
        timelines.select(F.col("metadata.matchId").alias("matchId"), frames.alias("frames"))
        .select("matchId", F.posexplode("frames").alias("frame_no", "f"))
        .select(
            "matchId",
            "frame_no",
            F.col("f.stamps").alias("frameTimestamp"),
            F.col("f.gaps").alias("gap_ms"),
            (F.col("f.gaps") / 1000 / speed).alias("delay_s"),
            (F.col("f.offsets") / 1000 / speed).alias("send_at_s"),
        )
    )


def replay_delay(
    rows: DataFrame,
    key: str,
    order: str,
    stamp: str,
    speed: int = 60,
    bucket: int = BUCKET,
) -> DataFrame:
    """``gap_ms``, ``delay_s`` and ``offset_ms`` for flat rows of a key in order of a
    unique integer column. ``offset_ms`` sums the gaps before the row's own.

    Two levels instead of one window per key: inside a bucket of the order, then
    over the buckets' edges. See ``BUCKET``. Rows without key are a group like any other.
    Rows without order are in no sequence: they come back with null in the three columns.
    """
    # Structs with a null inside are equal to each other, so the join below keeps the null key.
    placed = rows.where(F.col(order).isNotNull()).withColumn("_key", F.struct(key))
    part = F.call_function("div", F.col(order), F.lit(bucket))
    inside = Window.partitionBy("_key", "_bucket").orderBy(order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    inner = (
        placed.withColumn("_bucket", part)
        .withColumn("_prev", F.lag(stamp).over(inside))
        .withColumn("_opens", F.row_number().over(inside) == 1)
        .withColumn("_gap", F.when(F.col("_opens"), 0).otherwise(gap(F.col(stamp), F.col("_prev"))))
        .withColumn("_offset", F.coalesce(F.sum("_gap").over(before), F.lit(0)))
    )

    across = Window.partitionBy("_key").orderBy("_bucket")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        inner.groupBy("_key", "_bucket")
        .agg(
            F.min_by(stamp, order).alias("_first"),
            F.max_by(stamp, order).alias("_last"),
            F.sum("_gap").alias("_sum"),
        )
        .withColumn("_entry", gap(F.col("_first"), F.lag("_last").over(across)))
        .withColumn("_carried", F.coalesce(F.sum(F.col("_entry") + F.col("_sum")).over(earlier), F.lit(0)))
        .select("_key", "_bucket", "_entry", "_carried")
    )

    opens = F.col("_opens")
    own_gap = F.when(opens, F.col("_entry")).otherwise(F.col("_gap"))
    offset = F.when(opens, F.col("_carried")).otherwise(
        F.col("_carried") + F.col("_entry") + F.col("_offset")
    )
    found = inner.join(edges, ["_key", "_bucket"]).select(
        *rows.columns,
        own_gap.alias("gap_ms"),
        (own_gap / 1000 / speed).alias("delay_s"),
        offset.alias("offset_ms"),
    )
    added = [F.lit(None).cast(found.schema[n].dataType).alias(n) for n in found.columns[len(rows.columns) :]]
    return found.unionByName(rows.where(F.col(order).isNull()).select(*rows.columns, *added))
