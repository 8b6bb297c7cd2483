"""Declared schemas. Declaring them saves the inference pass over the raw JSON
and keeps keyed objects as maps, so that a key absent from all documents is a
null value and not an unresolved column.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG, STRING, DOUBLE = T.LongType(), T.StringType(), T.DoubleType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


# Participant fields the feature operators read. Callers with more fields pass
# their own struct to ``match_schema``.
PARTICIPANT = record(
    participantId=T.IntegerType(),
    teamId=T.IntegerType(),
    teamPosition=STRING,
    win=T.BooleanType(),
    kills=LONG,
    assists=LONG,
    goldEarned=LONG,
    totalDamageDealtToChampions=LONG,
    visionScore=LONG,
    wardsPlaced=LONG,
    timeCCingOthers=LONG,
    dragonKills=LONG,
    baronKills=LONG,
    challenges=record(
        soloKills=LONG,
        turretPlatesTaken=LONG,
        riftHeraldTakedowns=LONG,
        effectiveHealAndShielding=DOUBLE,
    ),
)


def match_schema(participant: T.StructType = PARTICIPANT) -> T.StructType:
    """A raw match document."""
    return record(
        metadata=record(matchId=STRING),
        info=record(
            gameDuration=LONG,
            gameStartTimestamp=LONG,
            participants=T.ArrayType(participant),
        ),
    )


MATCH = match_schema()

TIMELINE = record(
    metadata=record(matchId=STRING),
    info=record(
        frames=T.ArrayType(
            record(
                timestamp=LONG,
                participantFrames=T.MapType(STRING, record(totalGold=LONG)),
            )
        )
    ),
)

GOLD_MESSAGE = record(
    matchId=STRING,
    frameTimestamp=LONG,
    frameMinute=LONG,
    blueTotalGold=LONG,
    redTotalGold=LONG,
    goldDiff=LONG,
    eventTs=LONG,
)

# All of a message table: good messages and, by their text, rejected ones.
STORED_MESSAGE = T.StructType(
    [
        *GOLD_MESSAGE.fields,
        T.StructField("event_time", T.TimestampType()),
        T.StructField("arrival", T.TimestampType()),
        T.StructField("raw", STRING),
        T.StructField("rejected", T.BooleanType()),
        T.StructField("ds", T.DateType()),
    ]
)

LEAGUE = record(entries=T.ArrayType(record(puuid=STRING)))

PLAYER_MATCH = record(puuid=STRING, startTs=LONG, matchId=STRING)

ROLE_CONTRIBUTION = T.StructType(
    [
        T.StructField("DS", T.DateType()),
        T.StructField("MATCHID", STRING),
        T.StructField("ROLE", STRING),
        T.StructField("CONTRIB_PCT", DOUBLE),
    ]
)
