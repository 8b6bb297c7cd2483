"""Match documents to player rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

OUTER = ("matchId", "gameDuration", "ds")


def flatten_players(matches: DataFrame, ds: str | Column) -> DataFrame:
    """One row per participant: match id, duration, all participant fields, ``ds``.

    A document without participants gives no row. A participant field named as
    one of the outer columns, in any case, gets the prefix ``player_``.
    """
    day = ds if isinstance(ds, Column) else F.lit(ds)
    players = matches.select(
        F.col("metadata.matchId").alias("matchId"),
        F.col("info.gameDuration").alias("gameDuration"),
        day.cast("date").alias("ds"),
        F.explode("info.participants").alias("player"),
    )
    taken = {name.lower() for name in OUTER}
    fields = [
        F.col("player").getField(name).alias(f"player_{name}" if name.lower() in taken else name)
        for name in participant_fields(matches)
    ]
    return players.select("matchId", "gameDuration", *fields, "ds")


def participant_fields(matches: DataFrame) -> list[str]:
    participants = matches.schema["info"].dataType["participants"].dataType
    assert isinstance(participants, ArrayType)
    assert isinstance(participants.elementType, StructType)
    return participants.elementType.names


def distinct_documents(documents: DataFrame) -> DataFrame:
    """One whole document per match id, the longest.

    Documents without an id can't be copies of each other by id and all stay. Copies are
    compared by length and hash; only the chosen one's text is shuffled again.
    """
    known = documents.where("matchId is not null")
    mark = F.struct(F.length("value"), F.xxhash64("value")).alias("_mark")
    best = known.groupBy(F.col("matchId").alias("_id")).agg(F.max(mark).alias("_best"))
    chosen = known.select("*", mark).join(
        best, (F.col("matchId") == F.col("_id")) & (F.col("_mark") == F.col("_best")), "left_semi"
    )
    # What is left repeats a text; one of these stays.
    one = chosen.dropDuplicates(["matchId"]).select(*documents.columns)
    return one.unionByName(documents.where("matchId is null"))
