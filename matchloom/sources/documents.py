"""Landed JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import ArrayType, StructType

from matchloom import schemas, workspace
from matchloom.functions.text import partition_value

DS = T.StructField("ds", T.DateType())
RUN = T.StructField("run", T.StringType())
LISTERS = "64"


def read_json(
    spark: SparkSession, path: str | list[str], schema: StructType, *, multi_line: bool = True
) -> DataFrame:
    """JSON with a declared schema, so without an inference pass.

    ``multi_line=True`` reads one document per file and makes a file the
    smallest task; JSON Lines (``False``) can be split.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_matches(
    spark: SparkSession,
    path: str | list[str],
    participant: StructType = schemas.PARTICIPANT,
    *,
    multi_line: bool = True,
) -> DataFrame:
    return read_json(spark, path, schemas.match_schema(participant), multi_line=multi_line)


def read_whole(spark: SparkSession, path: str | list[str], *, multi_line: bool = True) -> DataFrame:
    """Whole documents as they came: ``matchId``, ``start`` and ``value``, one line of JSON.

    ``value`` has every field of the document; only white space and the order of fields may
    differ. Text that isn't JSON has null in all columns but ``raw``.
    """
    # Out of an explode the parsed document is a column: filters and fields don't parse it again.
    parsed = F.explode(F.array(F.try_parse_json("value"))).alias("document")
    text = spark.read.text(path, wholetext=multi_line).select("value", parsed)
    document = F.col("document")
    return text.select(
        F.try_variant_get(document, "$.metadata.matchId", "string").alias("matchId"),
        F.try_variant_get(document, "$.info.gameStartTimestamp", "long").alias("start"),
        F.to_json(document).alias("value"),
        F.when(document.isNull(), F.col("value")).alias("raw"),
    )


def all_participant_fields(
    spark: SparkSession, path: str | list[str], *, multi_line: bool = False,
    declared: StructType = schemas.PARTICIPANT,
) -> StructType:
    """The declared participant fields and every other one that any document has.

    Reads all documents once; declared types stay.
    """
    reader = spark.read.option("multiLine", multi_line).option("recursiveFileLookup", True)
    found = reader.json(path).schema
    for name, kind in (("info", StructType), ("participants", ArrayType)):
        if name not in found.names:
            return declared
        found = found[name].dataType
        if not isinstance(found, kind):
            return declared
    others = found.elementType
    return merged_fields(declared, others) if isinstance(others, StructType) else declared


def merged_fields(declared: StructType, found: StructType) -> StructType:
    """Declared fields first, in structs too, then the others."""
    known = {f.name.lower() for f in declared.fields}
    fields = []
    for field in declared.fields:
        if isinstance(field.dataType, StructType) and field.name in found.names:
            inner = found[field.name].dataType
            if isinstance(inner, StructType):
                field = T.StructField(field.name, merged_fields(field.dataType, inner))
        fields.append(field)
    return StructType([*fields, *[f for f in found.fields if f.name.lower() not in known]])


def read_timelines(
    spark: SparkSession, path: str | list[str], *, multi_line: bool = True
) -> DataFrame:
    return read_json(spark, path, schemas.TIMELINE, multi_line=multi_line)


def day_glob(root: str, ds: str) -> str:
    """Files of one day below ``root``."""
    return f"{root.rstrip('/')}/ds={ds}/*.json"


def read_landed(
    spark: SparkSession, root: str, schema: StructType, days: Sequence | None = None
) -> DataFrame:
    """JSON Lines landed below ``ds=`` and ``run=`` folders, with ``ds`` as a date.

    Of a match that several runs landed the last run's document counts; documents without a
    match id all stay. ``days`` prunes the folders. Folders are listed by a fixed number of
    tasks, not by one task per day. Days that one run landed have nothing to choose from and are
    read once.
    """
    with workspace.conf(
        spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=LISTERS
    ):
        rows = spark.read.schema(T.StructType([*schema.fields, DS, RUN])).json(root)
    if days is not None:
        rows = rows.where(F.col("ds").isin(list(days)))
    match = F.col("metadata.matchId")
    dated = rows.where(F.col("ds").isNotNull() | match.isNull())
    chosen = days_of_several_runs(rows)
    if not chosen:
        return dated.drop("run")
    several = F.coalesce(F.col("ds").cast("string").isin(chosen), F.lit(False))
    alone, rows = dated.where(~several).drop("run"), rows.where(several)
    # Narrow rows decide; documents are only filtered.
    last = (
        rows.select(match.alias("_id"), "ds", "run").where("_id is not null")
        .groupBy("_id", "ds").agg(F.max("run").alias("_run")).withColumnRenamed("ds", "_ds")
    )
    same = (match == F.col("_id")) & (F.col("ds") == F.col("_ds")) & (F.col("run") == F.col("_run"))
    named = rows.join(last, same, "left_semi")
    return named.unionByName(rows.where(match.isNull())).drop("run").unionByName(alone)


def days_of_several_runs(landed: DataFrame) -> list[str]:
    """Days with files below more than one ``run=`` folder, by the files' paths."""
    runs: dict[str, set[str]] = {}
    for path in landed.inputFiles():
        folders = dict(part.split("=", 1) for part in path.split("/")[:-1] if "=" in part)
        runs.setdefault(folders.get("ds", ""), set()).add(folders.get("run", ""))
    return sorted(day for day, names in runs.items() if len(names) > 1)


def read_league(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Players of a league list, one row per entry."""
    return league_players(read_json(spark, path, schemas.LEAGUE, multi_line=multi_line))


def league_players(documents: DataFrame) -> DataFrame:
    return documents.select(F.explode("entries").alias("entry")).select("entry.puuid")


def ranked_players(documents: DataFrame, *lists: str) -> DataFrame:
    """Players with their ``place`` in their list, from 0, and the columns that order the lists."""
    return documents.select(*lists, F.posexplode("entries").alias("place", "entry")).select(*lists, "place", "entry.puuid")


def read_player_matches(spark: SparkSession, path: str) -> DataFrame:
    """Landed match ids per player, JSON Lines of ``puuid, startTs, matchId``."""
    return read_json(spark, path, schemas.PLAYER_MATCH, multi_line=False)


def read_staged(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Staged Parquet as plain files, ``ds`` taken from each file's path.

    Partition discovery is off on purpose: it would type the value by looking at it.
    A file that can't be read fails the load. Folders are listed by a fixed number of tasks.
    """
    with workspace.conf(
        spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=LISTERS
    ):
        files = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)
    path = F.col("_metadata.file_path")
    return files.select("*", F.to_date(partition_value(path), "yyyy-MM-dd").alias("ds"))


def as_variant(rows: DataFrame, keep: tuple[str, ...] = ("ds",)) -> DataFrame:
    """Rows as one semi-structured column ``v`` beside the kept ones."""
    fields = [c for c in rows.columns if c not in keep]
    return rows.select(F.to_variant_object(F.struct(*fields)).alias("v"), *keep)
