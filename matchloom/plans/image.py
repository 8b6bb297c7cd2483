"""The domain as seen in the star-schema tables.

A match is an order and its participants are ten slots, five per team, that the
order's lines fall into; a timeline is what a user's events add up to week by
week. Slots and weeks are aggregated before documents are put together, so that
a document is small however many lines or events stand behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom import domain
from matchloom.functions.numeric import cents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_millis(ts: Column) -> Column:
    """Milliseconds of a zone-less timestamp; the session zone is UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def zoneless(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")



def match_id(key: Column) -> Column:
    return F.concat(F.lit("M_"), key.cast("string"))


def slots(lineitem: DataFrame) -> DataFrame:
    """Statistics per order and slot: at most ten rows per order."""
    price = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
    percent = "CAST(rint(l_discount * 100) AS BIGINT)"
    tax = "CAST(rint(l_tax * 100) AS BIGINT)"
    quantity = "CAST(l_quantity AS BIGINT)"
    sums = {
        "kills": quantity,
        "assists": "1L",
        "goldEarned": price,
        "totalDamageDealtToChampions": f"{price} * {percent}",
        "visionScore": tax,
        "wardsPlaced": "l_suppkey % 10",
        "timeCCingOthers": "l_partkey % 60",
        "dragonKills": "IF(l_returnflag = 'R', 1L, 0L)",
        "baronKills": "IF(l_returnflag = 'A', 1L, 0L)",
        "soloKills": "CAST(l_linenumber AS BIGINT)",
        "turretPlatesTaken": "IF(l_returnflag = 'N', 1L, 0L)",
        "riftHeraldTakedowns": "IF(l_discount >= 0.05D, 1L, 0L)",
    }
    slot = "CAST(pmod(l_linenumber - 1, 5) + 1 + IF(l_linestatus = 'F', 0, 5) AS INT)"
    return lineitem.groupBy("l_orderkey", F.expr(slot).alias("participantId")).agg(
        *[F.expr(f"sum({value}) AS {name}") for name, value in sums.items()],
        F.expr(f"CAST(sum({quantity} * {tax}) AS DOUBLE) AS effectiveHealAndShielding"),
    )


STATS = (
    "kills", "assists", "goldEarned", "totalDamageDealtToChampions", "visionScore",
    "wardsPlaced", "timeCCingOthers", "dragonKills", "baronKills",
)
CHALLENGES = ("soloKills", "turretPlatesTaken", "riftHeraldTakedowns", "effectiveHealAndShielding")


def participant(won: Column) -> list[Column]:
    """A slot's columns in the shape of the declared participant."""
    number = F.col("participantId")
    blue = number <= 5
    positions = F.array(*[F.lit(p) for p in domain.POSITIONS])
    return [
        number,
        F.when(blue, domain.BLUE_TEAM).otherwise(domain.RED_TEAM).alias("teamId"),
        F.get(positions, (number - 1) % 5).alias("teamPosition"),
        F.when(blue, won).otherwise(~won).alias("win"),
        *[F.col(s) for s in STATS],
        F.struct(*CHALLENGES).alias("challenges"),
    ]


def blue_won() -> Column:
    """Blue wins where the match's price is an even number of cents."""
    return cents(F.col("o_totalprice")) % 2 == 0


def duration() -> Column:
    """Seconds, 20 to 40 minutes."""
    return F.lit(1200) + cents(F.col("o_totalprice")) % 1200


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player rows as ``flatten_players`` gives them."""
    orders = table(spark, sf_dir, "orders")
    matches = orders.select(
        "o_orderkey",
        match_id(F.col("o_orderkey")).alias("matchId"),
        duration().alias("gameDuration"),
        F.to_date("o_orderdate").alias("ds"),
        blue_won().alias("_won"),
    )
    joined = slots(table(spark, sf_dir, "lineitem")).join(
        matches, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select("matchId", "gameDuration", *participant(F.col("_won")), "ds")


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match documents; an order without lines has no participants."""
    orders = table(spark, sf_dir, "orders")
    lines = slots(table(spark, sf_dir, "lineitem"))
    # At most ten slots per order are left to collect.
    listed = lines.groupBy("l_orderkey").agg(
        F.collect_list(F.struct("participantId", *STATS, F.struct(*CHALLENGES).alias("challenges")))
        .alias("slots")
    )
    won = blue_won()
    positions = F.array(*[F.lit(p) for p in domain.POSITIONS])

    def shaped(slot: Column) -> Column:
        number = slot["participantId"]
        blue = number <= 5
        return F.struct(
            number.alias("participantId"),
            F.when(blue, domain.BLUE_TEAM).otherwise(domain.RED_TEAM).alias("teamId"),
            F.get(positions, (number - 1) % 5).alias("teamPosition"),
            F.when(blue, won).otherwise(~won).alias("win"),
            *[slot[s].alias(s) for s in STATS],
            slot["challenges"].alias("challenges"),
        )

    return orders.join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.struct(match_id(F.col("o_orderkey")).alias("matchId")).alias("metadata"),
        F.struct(
            duration().alias("gameDuration"),
            epoch_millis(F.col("o_orderdate")).alias("gameStartTimestamp"),
            F.transform("slots", shaped).alias("participants"),
        ).alias("info"),
    )


WEEK_MS = 7 * 86_400_000
WEEKS_PER_DOCUMENT = 13


def event_key(props: Column) -> Column:
    """The number ``k`` in an event's properties."""
    return F.get_json_object(props, "$.k").cast("long")


def timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeline documents: a quarter of a user, one frame per week, participant
    ``1 + k mod 10``. At most 13 frames of ten participants are collected."""
    events = table(spark, sf_dir, "events").select(
        "user_id",
        epoch_millis(F.col("ts")).alias("ms"),
        (1 + F.pmod(event_key(F.col("props")), F.lit(10))).alias("pid"),
        cents(F.col("value")).alias("cents"),
    )
    keys = [*domain.BLUE_KEYS, *domain.RED_KEYS]
    weeks = events.groupBy(
        "user_id", F.floor(F.col("ms") / WEEK_MS).alias("week")
    ).agg(
        F.max("ms").alias("timestamp"),
        *[F.expr(f"sum(IF(pid = {k}, cents, NULL)) AS p{k}") for k in keys],
    )
    entries = ", ".join(
        f"struct('{k}' AS key, named_struct('totalGold', p{k}) AS value)" for k in keys
    )
    there = F.expr(
        f"map_from_entries(filter(array({entries}), e -> e.value.totalGold IS NOT NULL))"
    )
    framed = weeks.select(
        "user_id", "week", F.struct("timestamp", there.alias("participantFrames")).alias("frame")
    )
    collected = framed.groupBy(
        "user_id", F.floor(F.col("week") / WEEKS_PER_DOCUMENT).alias("quarter")
    ).agg(F.collect_list("frame").alias("frames"))
    in_order = F.array_sort(
        "frames", lambda a, b: F.signum(a["timestamp"] - b["timestamp"]).cast("int")
    )
    return collected.select(
        F.struct(match_id(F.col("user_id")).alias("matchId")).alias("metadata"),
        F.struct(in_order.alias("frames")).alias("info"),
    )


def frame_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message fields, one message per event: clicks and views are blue, purchases
    and errors red."""
    kind = F.col("event_type")
    amount = cents(F.col("value"))
    blue = F.when(kind.isin("click", "view"), amount).otherwise(0)
    red = F.when(kind.isin("purchase", "error"), amount).otherwise(0)
    ms = epoch_millis(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        match_id(F.col("user_id")).alias("matchId"),
        ms.alias("frameTimestamp"),
        F.floor(ms / 60000).alias("frameMinute"),
        blue.alias("blueTotalGold"),
        red.alias("redTotalGold"),
        (blue - red).alias("goldDiff"),
        ms.alias("eventTs"),
        (kind == "signup").alias("_broken"),
        (F.col("event_id") % 2 == 1).alias("_half"),
    )


def match_time_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a game sends them: times since the match's first frame, none broken."""
    events = frame_events(spark, sf_dir)
    starts = events.groupBy("matchId").agg(F.min("eventTs").alias("_start"))
    since = F.col("eventTs") - F.col("_start")
    return events.join(starts, "matchId").select(
        "matchId",
        since.alias("frameTimestamp"),
        F.floor(since / 60000).alias("frameMinute"),
        "blueTotalGold", "redTotalGold", "goldDiff",
        since.alias("eventTs"),
        F.lit(False).alias("_broken"),
        F.lit(False).alias("_half"),
    )


# Contribution matrix: number of the feature an event adds to, by ``k``.
CONTRIBUTION_FEATURES = (
    *[name for names in domain.LISTED_FEATURES.values() for name in names],
    "X_STOP_DIF",
    "OTHER_DIF",
)


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number contributions per user and day, one column per feature: clicks
    and views add, purchases and signups take off, errors weigh nothing."""
    kind = F.col("event_type")
    sign = F.when(kind.isin("click", "view"), 1).when(kind.isin("purchase", "signup"), -1).otherwise(0)
    rows = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("DS"),
        match_id(F.col("user_id")).alias("MATCHID"),
        F.pmod(event_key(F.col("props")), F.lit(len(CONTRIBUTION_FEATURES))).alias("number"),
        (sign * cents(F.col("value"))).alias("amount"),
    )
    return rows.groupBy("DS", "MATCHID").agg(
        *[
            F.expr(f"sum(IF(number = {i}, amount, 0)) AS {name}")
            for i, name in enumerate(CONTRIBUTION_FEATURES)
        ]
    )
