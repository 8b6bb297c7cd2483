"""Batch sinks."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom import domain, workspace
from matchloom.functions.time import utc_date

#: Compression of JSON that is written: Spark's readers tell it by the file name.
CODEC = "gzip"


def balanced(rows: DataFrame, *by: str) -> DataFrame:
    """Bring equal partition values together before a partitioned write.

    Unlike ``repartition`` the rebalance lets AQE split a value that holds much
    of the data over several tasks and merge small ones.
    """
    return rows.hint("rebalance", *[F.col(c) for c in by])


def many_files(spark: SparkSession):
    """Settings for a write into many folders: a file costs time whatever its size, so small parts are
    not merged into fewer tasks than there are cores, and files are renamed once."""
    return workspace.conf(
        spark,
        spark__sql__adaptive__coalescePartitions__minPartitionSize="16k",
        spark__hadoop__mapreduce__fileoutputcommitter__algorithm__version="2",
    )


def replace_partitions(rows: DataFrame, path: str, by: Sequence[str] = ("ds",)) -> None:
    """Replace the partitions that occur in ``rows`` and keep all others.

    The mode is set on the writer: left to a session setting, a forgotten
    setting would remove every other partition.
    """
    with many_files(rows.sparkSession):
        (
            balanced(rows, *by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(path)
        )


def append_partitions(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Add rows; a second run adds them again."""
    balanced(rows, *by).write.mode("append").partitionBy(*by).parquet(path)


def run_name() -> str:
    """A name for the documents one run lands; later runs have greater names."""
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"


def land_lines(documents: DataFrame, path: str) -> None:
    """Append ``value`` lines below ``ds=`` and ``run=`` folders; nothing that is there is touched.

    ``read_landed`` takes the last run's document of a match, so a run that ended half-way
    can be repeated.
    """
    rows = documents.select("value", "ds", F.lit(run_name()).alias("run"))
    with many_files(rows.sparkSession):
        balanced(rows, "ds").write.mode("append").partitionBy("ds", "run").text(path, compression=CODEC)


def with_event_date(documents: DataFrame) -> DataFrame:
    """Whole documents with the UTC date of their start; those without a start are left out."""
    return documents.where(F.col("start").isNotNull()).withColumn("ds", utc_date(F.col("start")))


def without_start(documents: DataFrame) -> DataFrame:
    """One row: how many documents ``with_event_date`` leaves out, and how many aren't JSON."""
    return documents.agg(
        F.count_if(F.col("start").isNull() & F.col("value").isNotNull()).alias("without_start"),
        F.count_if(F.col("value").isNull()).alias("not_json"),
    )


def land_matches(documents: DataFrame, path: str) -> None:
    """Land whole match documents by the date the match started."""
    land_lines(with_event_date(documents), path)


def land_timelines(documents: DataFrame, path: str, ds: str) -> None:
    """Land whole timeline documents, which hold no wall-clock time, by the given date."""
    land_lines(documents.where("value is not null").withColumn("ds", F.lit(ds).cast("date")), path)


def ensure_role_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the role table once, with its fixed columns."""
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} "
        "(MATCHID STRING, ROLE STRING, CONTRIB_PCT DOUBLE, DS DATE) "
        f"USING parquet PARTITIONED BY (DS) {where}"
    )


def replace_table_day(rows: DataFrame, name: str) -> None:
    """Replace in a catalog table the days that occur in ``rows``.

    An insert takes the mode from the session only, so it is set around it.
    """
    spark = rows.sparkSession
    ordered = rows.select(*spark.table(name).columns)
    with workspace.conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        balanced(ordered, "DS").write.insertInto(name, overwrite=True)


def publish(messages: DataFrame, servers: str, topic: str = domain.FRAME_TOPIC) -> None:
    """Send ``key, value`` rows to a topic (needs the Kafka connector on the class path)."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.compression.type", "lz4")
        .option("kafka.linger.ms", "10")
        .option("kafka.retries", "3")
        .option("kafka.request.timeout.ms", "30000")
        .option("kafka.max.in.flight.requests.per.connection", "1")
        .option("topic", topic)
        .save()
    )


def publish_files(messages: DataFrame, path: str) -> None:
    """Message values as text files, one JSON object per line."""
    messages.select(F.col("value").cast("string").alias("value")).write.mode("append").text(path)
