"""Each message once, however late its copies come, and no first arrival lost.

State with a watermark forgets: a copy that comes after it is a new message, and a late first arrival is
dropped. Here the keys that were seen are a table, in buckets by their hash. A batch reads only the buckets it has
keys of, and only their hashes and keys; Spark's runtime Bloom filter on the batch's side thins them out before
the join. Rows, keys and counts of a batch are written below its number, so a batch that is run again after
a crash overwrites what it had written.

Every ``fold_every`` batches the keys are written anew as one table, so that their files stay few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchloom import workspace
from matchloom.streaming.gold import TRIGGER

KEYS = ("matchId", "frameTimestamp")
BUCKETS = 64
NAME = "batch=%012d"


def numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders ``<prefix>=n``."""
    folders = workspace.listed(spark, path, f"{prefix}=")
    return [int(f.rsplit("=", 1)[1]) for f in folders if workspace.exists(spark, f"{f}/_SUCCESS")]


def seen_before(spark: SparkSession, path: str, batch: int, schema) -> DataFrame | None:
    """Keys of all batches before this one: the last folded table and the batches after it."""
    bases = [n for n in numbers(spark, path, "base") if n < batch]
    base = max(bases, default=-1)
    after = [n for n in numbers(spark, path, "batch") if base < n < batch]
    folders = [f"{path}/base=%012d" % base] if bases else []
    folders += [f"{path}/{NAME % n}" for n in after]
    parts = [spark.read.schema(schema).parquet(f) for f in folders]
    if not parts:
        return None
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def exact_sink(
    rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = KEYS, arrival: str = "arrival",
    late: str = "10 minutes", buckets: int = BUCKETS, fold_every: int = 100, trigger: dict | None = None,
) -> StreamingQuery:
    """Append the first row of every key to ``path``/rows.

    Of rows of one key in a batch the first to arrive counts, of these the least by all columns. Null keys are
    keys. ``path``/counts has a row per batch: rows that came, were kept, and were copies, and how many kept ones
    had arrived more than ``late`` before the newest row of earlier batches; those are kept all the same.
    """
    others = [c for c in rows.columns if c not in keys and c != arrival]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        hashed = batch.withColumn("_hash", F.xxhash64(*keys)).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))
        came = workspace.stored(hashed, "came")
        first = came.groupBy("_bucket", "_hash", *keys).agg(F.min(F.struct(arrival, *others)).alias("_first"))
        seen = seen_before(spark, f"{path}/seen", number, came.select(*keys, "_hash", "_bucket").schema)
        if seen is not None:
            there = [r[0] for r in came.select("_bucket").distinct().collect()]  # at most ``buckets``
            known = seen.where(F.col("_bucket").isin(there)).select(*[F.col(c).alias(f"_seen_{c}") for c in ("_hash", *keys)])
            same = F.col("_hash") == F.col("_seen__hash")
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_seen_{k}"))
            first = first.join(known, same, "left_anti")
        new = workspace.stored(first.select("_bucket", "_hash", *keys, "_first.*"), "new")
        new.select(*rows.columns).write.mode("overwrite").parquet(f"{path}/rows/{NAME % number}")
        found = new.select(*keys, "_hash", "_bucket")
        found.repartition("_bucket").sortWithinPartitions("_bucket", "_hash").write.mode("overwrite").partitionBy("_bucket").parquet(
            f"{path}/seen/{NAME % number}"
        )
        newest = counts_before(spark, path, number)
        behind = F.lit(False) if newest is None else F.col(arrival) < F.lit(newest) - F.expr(f"interval {late}")
        arrived = came.agg(F.count("*").alias("came"), F.max(arrival).alias("newest")).first()
        kept, late_ones = new.agg(F.count("*"), F.count_if(behind)).first()
        top = max((t for t in (newest, arrived["newest"]) if t is not None), default=None)
        counted = [(number, arrived["came"], kept, arrived["came"] - kept, late_ones, top)]
        spark.createDataFrame(counted, COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/{NAME % number}")
        if number % fold_every == fold_every - 1:
            fold(spark, f"{path}/seen", number + 1, found.schema)

    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or TRIGGER))
        .start()
    )


COUNTS = "batch long, came long, kept long, copies long, late long, newest timestamp"


def counts_before(spark: SparkSession, path: str, number: int):
    """The newest arrival of all batches before."""
    before = [n for n in numbers(spark, f"{path}/counts", "batch") if n < number]
    if not before:
        return None
    return spark.read.schema(COUNTS).parquet(f"{path}/counts/{NAME % max(before)}").first()["newest"]


def fold(spark: SparkSession, path: str, batch: int, schema) -> None:
    """The keys of all batches before ``batch`` as one table; what it stands for is removed at the next fold."""
    done = [n for n in numbers(spark, path, "base") if n < batch]
    seen = seen_before(spark, path, batch, schema)
    if seen is not None:
        seen.repartition("_bucket").sortWithinPartitions("_bucket", "_hash").write.mode("overwrite").partitionBy("_bucket").parquet(
            f"{path}/base=%012d" % (batch - 1)
        )
    last = max(done, default=None)
    if last is not None:
        for n in done:
            if n < last:
                workspace.removed(spark, f"{path}/base=%012d" % n)
        for n in numbers(spark, path, "batch"):
            if n <= last:
                workspace.removed(spark, f"{path}/{NAME % n}")


def kept(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows that were kept."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/rows")


def counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COUNTS).option("recursiveFileLookup", True).parquet(f"{path}/counts")
