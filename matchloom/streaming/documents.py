"""Whole documents as a stream: files of any layout, every field kept.

A newly landed file is read as one text: a document over many lines, or an array of documents. Documents and
players stay semi-structured, so fields that nobody declared are there, and a field of another type than
declared is not lost with its whole document. Types are asked for when the table is read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions import time


def parsed(text: Column) -> Column:
    """A file's text as a variant; null if it isn't JSON, or blank."""
    return F.when(text.rlike(r"\S"), F.try_parse_json(text))


def documents_in(parsed: Column) -> Column:
    """The documents of a parsed file as an array of variants; null without one."""
    return F.coalesce(F.try_variant_get(parsed, "$", "array<variant>"), F.when(parsed.isNotNull(), F.array(parsed)))


def whole_documents(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Documents of newly landed files: ``matchId``, ``start`` (ms), ``document``, ``file``, and ``raw``, the
    text of a file that isn't JSON, which has one row without a document.

    A file is read by one task and is in its memory; an array of documents makes a row of each.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    texts = reader.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    # Out of an explode the parsed file is a column, and is parsed once.
    once = texts.select("value", "file", F.explode(F.array(parsed(F.col("value")))).alias("parsed"))
    listed = once.select("value", "file", documents_in(F.col("parsed")).alias("documents"))
    # An empty array has no documents; a text that isn't JSON has one row.
    each = F.when(F.col("documents").isNull(), F.array(F.lit(None).cast("variant"))).otherwise(F.col("documents"))
    raw = F.when(F.col("documents").isNull(), F.coalesce("value", F.lit("")))
    # Neither the text nor the array goes along with each of its documents.
    rows = listed.select(each.alias("each"), "file", raw.alias("raw")).select(F.explode("each").alias("document"), "file", "raw")
    return rows.select(
        F.try_variant_get("document", "$.metadata.matchId", "string").alias("matchId"),
        F.try_variant_get("document", "$.info.gameStartTimestamp", "long").alias("start"),
        "document", "file", "raw",
    )


def whole_players(documents: DataFrame) -> DataFrame:
    """A row per participant: ``matchId``, ``gameDuration``, ``ds``, ``player`` (a variant with every field)."""
    listed = F.try_variant_get("document", "$.info.participants", "array<variant>")
    # Taken once of a document, which then doesn't go along with each of its players.
    taken = documents.select(
        "matchId",
        F.try_variant_get("document", "$.info.gameDuration", "long").alias("gameDuration"),
        time.utc_date(F.col("start")).alias("ds"),
        listed.alias("players"),
    )
    return taken.select("matchId", "gameDuration", "ds", F.explode("players").alias("player"))


def typed(players: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Players with columns of the given fields and types; a value that isn't of the type is null there and
    still in ``player``."""
    return players.select(
        *[c for c in players.columns if c != "player"],
        *[F.try_variant_get("player", f"$.{name}", kind).alias(name) for name, kind in fields.items()],
        "player",
    )
