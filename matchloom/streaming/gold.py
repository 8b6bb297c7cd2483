"""Frame messages to gold rows, continuously."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from matchloom import domain, schemas, workspace
from matchloom.functions import text, time

TRIGGER = {"processingTime": "5 seconds"}
DRAIN = {"availableNow": True}

# State that outgrows executor memory goes to RocksDB.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def kafka_options(servers: str, topic: str = domain.FRAME_TOPIC) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = domain.FRAME_TOPIC, max_offsets: int | None = None
) -> DataFrame:
    """Messages of a topic from the earliest offset (needs the Kafka connector)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def file_messages(spark: SparkSession, path: str, max_bytes: str | None = None) -> DataFrame:
    """Messages from text files, one JSON object per line; starts with all files there.

    A message arrived when its file was written, as a topic has a ``timestamp`` too.
    """
    reader = spark.readStream
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(path).select(
        "value", F.col("_metadata.file_modification_time").alias("timestamp")
    )


def new_documents(
    spark: SparkSession, path: str, schema=schemas.MATCH, max_bytes: str | None = None
) -> DataFrame:
    """Newly landed JSON Lines documents; the checkpoint remembers the files."""
    reader = spark.readStream.schema(schema)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


def parsed(messages: DataFrame) -> DataFrame:
    """Message fields, event time, time of arrival, and the text of what isn't a good message.

    ``raw`` is null for good messages. A message is rejected if any part of it can't be
    parsed or if it lacks the match id or the event time.
    """
    raw = F.col("value").cast("string")
    read = messages.select(
        text.to_checked_record(raw, schemas.GOLD_MESSAGE).alias("data"),
        raw.alias("raw"),
        F.col("timestamp").alias("arrival"),
    )
    good = (
        F.col("data.matchId").isNotNull()
        & F.col("data.eventTs").isNotNull()
        & F.col(f"data.{text.BROKEN}").isNull()
    )
    return read.select(
        *[F.col(f"data.{name}") for name in schemas.GOLD_MESSAGE.names],
        time.from_millis(F.col("data.eventTs")).alias("event_time"),
        "arrival",
        F.when(~F.coalesce(good, F.lit(False)), F.coalesce("raw", F.lit(""))).alias("raw"),
    )


def gold_rows(messages: DataFrame) -> DataFrame:
    """The good messages: their fields, event time and time of arrival."""
    return parsed(messages).where(F.col("raw").isNull()).drop("raw")


def rejected(messages: DataFrame) -> DataFrame:
    """Text of the other messages."""
    return parsed(messages).where(F.col("raw").isNotNull()).select(F.col("raw").alias("value"))


def with_day(rows: DataFrame, kind: str = "ingest") -> DataFrame:
    """A ``ds`` to partition by: date of arrival, or of the event where messages
    carry wall-clock time. A folder per match would be too many small files."""
    day = F.current_date() if kind == "ingest" else time.utc_date(F.col("eventTs"))
    return rows.withColumn("ds", day)


def parquet_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str] = ("ds",),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append rows to Parquet; a restart goes on where the checkpoint ends."""
    writer: DataStreamWriter = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
    )
    if by:
        writer = writer.partitionBy(*by)
    return writer.start()


def stateful(spark: SparkSession, partitions: int | None):
    """Settings a stateful query is started with: state in RocksDB, and its partitions.

    The number of partitions is kept in the checkpoint from the first start on; pick it
    for the largest state to come. Without one the session's is taken.
    """
    settings = {"spark__sql__streaming__stateStore__providerClass": ROCKSDB}
    if partitions:
        settings["spark__sql__shuffle__partitions"] = str(partitions)
    return workspace.conf(spark, **settings)


def without_redelivery(
    rows: DataFrame,
    delay: str = "10 minutes",
    keys: Sequence[str] = ("matchId", "frameTimestamp"),
) -> DataFrame:
    """Each message once, as long as its copies arrive within ``delay`` of each other.

    The watermark is on the time of arrival. Event times are relative to the start of
    a match and start over with each, so they can't tell what is late.
    """
    return rows.withWatermark("arrival", delay).dropDuplicatesWithinWatermark(list(keys))


def dedup_sink(
    rows: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ("ds",),
    trigger: dict | None = None, partitions: int | None = None,
) -> StreamingQuery:
    """Append deduplicated rows."""
    with stateful(rows.sparkSession, partitions):
        return parquet_sink(rows, path, checkpoint, by, trigger)


#: What a window shows: of its messages the last in this order.
LATEST = ("event_time", "frameTimestamp", "goldDiff")


def gold_by_window(
    rows: DataFrame, delay: str = "10 minutes", width: str = "1 minute", hold: str = "1 hour"
) -> DataFrame:
    """The latest gold difference per match and tumbling window of the match's time.

    ``latest_changes`` takes the last of a window's rows by ``LATEST``. State is held by
    time of arrival: a window that gets messages in two ``hold`` spans has a row of each.
    A row leaves the state ``delay`` after its span, whatever the times in the match.
    """
    # A stream may have one window expression, and state is held by the one of arrival.
    micros = pd.Timedelta(width).value // 1000
    shown = F.timestamp_micros((F.floor(F.unix_micros("event_time") / micros) * micros).cast("long"))
    return (
        rows.withWatermark("arrival", delay)
        .groupBy(F.window("arrival", hold).alias("held"), "matchId", shown.alias("window_start"))
        .agg(F.max(F.struct(*LATEST)).alias("last"))
        .select(
            "matchId",
            "window_start",
            "last.*",
            F.to_date("held.start").alias("ds"),
        )
    )


def dropped(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, in the progress reports still held."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for report in query.recentProgress
        for state in report["stateOperators"]
    )


def changes_sink(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
    partitions: int | None = None, fold_every: int = 100, hold_seconds: float = 0,
) -> StreamingQuery:
    """Write the changed result rows of each batch, and fold them every so many batches.

    Where others read the folder meanwhile, ``hold_seconds`` is longer than any of them takes.

    A later row of a window is never less than an earlier one in ``LATEST``, so the
    greatest is the current one: batches may be written twice, in any order and under
    several checkpoints without changing what is read.
    """

    def write(batch: DataFrame, number: int) -> None:
        part = batch.withColumn("part", F.lit(f"batch-{uuid.uuid4().hex}"))
        part.write.mode("append").partitionBy("ds", "part").parquet(path)
        if number % fold_every == fold_every - 1:
            for row in batch.select("ds").distinct().collect():  # days of arrival: one or two
                fold_changes(batch.sparkSession, path, row["ds"], hold_seconds=hold_seconds)

    with stateful(rows.sparkSession, partitions):
        return (
            rows.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(**(trigger or TRIGGER))
            .start()
        )


WINDOW_KEYS = ("matchId", "window_start")


def greatest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        rows.groupBy(*keys)
        .agg(F.max(F.struct(*LATEST)).alias("_last"))
        .select(*keys, "_last.*")
    )


def fold_changes(
    spark: SparkSession, path: str, ds, keys: Sequence[str] = WINDOW_KEYS, hold_seconds: float = 0
) -> None:
    """One part instead of a day's many. A crash on the way leaves rows twice, which is harmless.

    Parts that were written less than ``hold_seconds`` ago stay until a later fold, since a reader may have
    listed them; what they hold is read twice then.
    """
    day = f"{path}/ds={ds}"
    parts = workspace.listed(spark, day, "part=")
    if len(parts) > 1:
        old = [p for p in parts if workspace.age(spark, p) >= hold_seconds]
        folded = greatest(spark.read.parquet(*parts), keys)
        folded.write.parquet(f"{day}/part=folded-{uuid.uuid4().hex}")
        for part in old:
            workspace.removed(spark, part)


def latest_changes(
    spark: SparkSession, path: str, keys: Sequence[str] = WINDOW_KEYS, since=None
) -> DataFrame:
    """The current row per key out of a ``changes_sink`` folder; ``since``: of what arrived from
    this day on, reading no earlier folder."""
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.where(F.col("ds") >= F.lit(since).cast("date"))
    return greatest(rows, keys)


def drain(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and raise what it raised."""
    query.awaitTermination()


def stream_gold(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    day: str = "ingest",
    by: Sequence[str] = ("ds",),
    trigger: dict | None = None,
) -> StreamingQuery:
    """The whole job: every message once through one parse into one table.

    Good and rejected messages are its partitions ``rejected=false`` and ``rejected=true``.
    """
    rows = parsed(messages).withColumn("rejected", F.col("raw").isNotNull())
    return parquet_sink(with_day(rows, day), path, checkpoint, ["rejected", *by], trigger)


def stored_gold(spark: SparkSession, path: str) -> DataFrame:
    """The good messages of a ``stream_gold`` table."""
    return stored_messages(spark, path).where("not rejected").drop("rejected", "raw")


def stored_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Text of the rejected messages of a ``stream_gold`` table."""
    return stored_messages(spark, path).where("rejected").select(F.col("raw").alias("value"))


def stored_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STORED_MESSAGE).parquet(path)
