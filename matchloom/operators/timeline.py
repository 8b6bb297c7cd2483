"""Team gold over time, and its messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import domain
from matchloom.functions import numeric, text, time


def frames(timelines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per frame, with its place in the document and the columns ``keep``."""
    return timelines.select(
        *keep,
        F.col("metadata.matchId").alias("matchId"),
        F.posexplode("info.frames").alias("frame_no", "frame"),
    )


def team_gold(by_participant: Column, keys: Sequence[str], missing: str) -> Column:
    """Gold of a team from the participants' map."""
    return numeric.row_sum([by_participant[key]["totalGold"] for key in keys], missing)


def gold_timeline(
    timelines: DataFrame, missing: str = "zero", keep: Sequence[str] = ()
) -> DataFrame:
    """Gold of both teams and the difference, per match and frame.

    ``missing="null"`` leaves a team's sum null when a participant is absent,
    ``missing="zero"`` counts them 0 and names a match without id. ``match_id``
    repeats the id for files partitioned by ``matchId``. ``keep`` names columns beside the
    document that stay.
    """
    zero = missing == "zero"
    match_id = F.col("matchId")
    stamp = F.col("frame.timestamp")
    gold = F.col("frame.participantFrames")
    blue = team_gold(gold, domain.BLUE_KEYS, missing)
    red = team_gold(gold, domain.RED_KEYS, missing)
    if zero:
        match_id = F.coalesce(match_id, F.lit(domain.UNKNOWN_MATCH))
        stamp = F.coalesce(stamp, F.lit(0))
    return frames(timelines, keep).select(
        match_id.alias("matchId"),
        time.from_millis(stamp).alias("event_time"),
        time.minute_truncated(stamp).alias("frame_minute"),
        blue.alias("blue_gold_total"),
        red.alias("red_gold_total"),
        (blue - red).alias("gold_diff"),
        match_id.alias("match_id"),
        *keep,
    )


def gold_events(timelines: DataFrame) -> DataFrame:
    """The fields of the frame messages, in document order by ``frame_no``."""
    gold = F.col("frame.participantFrames")
    stamp = F.coalesce(F.col("frame.timestamp"), F.lit(0))
    blue = team_gold(gold, domain.BLUE_KEYS, "zero")
    red = team_gold(gold, domain.RED_KEYS, "zero")
    return frames(timelines).select(
        F.coalesce("matchId", F.lit(domain.UNKNOWN_MATCH)).alias("matchId"),
        stamp.alias("frameTimestamp"),
        time.minute_floored(stamp).alias("frameMinute"),
        blue.alias("blueTotalGold"),
        red.alias("redTotalGold"),
        (blue - red).alias("goldDiff"),
        stamp.alias("eventTs"),
        "frame_no",
    )


def messages(events: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Topic records: match id bytes as key, JSON bytes as value."""
    return events.select(
        text.to_bytes(F.col("matchId")).alias("key"),
        text.to_bytes(text.to_text(F.struct(*fields))).alias("value"),
    )
