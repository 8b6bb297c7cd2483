"""Where a job may write what it reads back: the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import time
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it and gets a temporary folder; on a
    cluster such a folder would exist on one machine only.
    """
    base = spark.conf.get(SHARED_DIR, None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
    return local_dir().name


@cache
def local_dir() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="matchloom-", ignore_cleanup_errors=True)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of a path."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(configuration), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def listed(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Entries of a folder whose name starts with ``prefix``."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found = [entry.getPath() for entry in fs.listStatus(hadoop_path)]
    return sorted(p.toString() for p in found if p.getName().startswith(prefix))


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a folder was last written to."""
    fs, hadoop_path = file_system(spark, path)
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder."""
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/matchloom-{label}-{uuid.uuid4().hex}"
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write rows to a table in the shared folder and read them back.

    For rows that many jobs read: they are computed once, their lineage is cut,
    and losing an executor costs a re-read.
    """
    path = scratch(rows.sparkSession, label)
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def conf(spark: SparkSession, **settings: str):
    """Session settings for the time of a block; ``__`` in a name stands for a dot."""
    names = {name.replace("__", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def session(app: str, **settings: str) -> SparkSession:
    """A session with the settings the operators count on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # HotSpot interprets methods above 8000 bytes. Wide aggregations give such ones,
        # and run faster without whole-stage code than with code that isn't compiled.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Recording the call site of each column made costs more than making it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
