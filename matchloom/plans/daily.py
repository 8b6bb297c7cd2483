"""The daily job: everything that happens for one ``ds``, in one application.

Stages meet in tables below one root, so each can be run again alone; a rerun
replaces its day and leaves the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom import schemas, workspace
from matchloom.operators import features, flatten, roles, selection, timeline, win_model
from matchloom.plans import influence
from matchloom.sinks import tables as sinks
from matchloom.sources import documents, tables


@dataclass(frozen=True)
class Paths:
    """Folders of the job below ``root``."""

    root: str

    def _below(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def league(self) -> str:
        return self._below("inbox/league")

    @property
    def player_matches(self) -> str:
        return self._below("inbox/player_matches")

    @property
    def match_inbox(self) -> str:
        return self._below("inbox/match")

    @property
    def timeline_inbox(self) -> str:
        return self._below("inbox/match_timeline")

    @property
    def skipped(self) -> str:
        """How many documents each run left out, and why."""
        return self._below("reports/skipped")

    @property
    def matches(self) -> str:
        return self._below("raw/match")

    @property
    def timelines(self) -> str:
        return self._below("raw/match_timeline")

    @property
    def players(self) -> str:
        return self._below("staging/match_player_stats")

    @property
    def gold(self) -> str:
        return self._below("staging/gold_diffs")

    @property
    def raw(self) -> str:
        return self._below("raw_table")

    @property
    def features(self) -> str:
        return self._below("mart/match_features")

    @property
    def model(self) -> str:
        return self._below("model")

    @property
    def roles(self) -> str:
        return self._below("mart/role_contribution")


def collect(
    spark: SparkSession, ds: str, paths: Paths, count: int | None = None, limit_users: int | None = None
) -> list[dt.date]:
    """Land the documents of the day's matches of all players, or of the first ``limit_users``.

    Documents land whole. Matches land by the date they started, timelines by their match's.
    These days, nearly always the one asked for, are returned for the later stages. Where the
    inboxes have ``ds=`` folders only the day's is read.
    """
    players = selection.first_players(documents.read_league(spark, paths.league), limit=limit_users)
    listed = documents.read_player_matches(spark, paths.player_matches)
    ids = selection.recent_match_ids(listed.join(players, "puuid", "left_semi"), count, ds)
    ids = workspace.stored(ids, "ids")

    def chosen(inbox: str) -> DataFrame:
        day = f"{inbox}/ds={ds}"
        path = day if workspace.exists(spark, day) else inbox
        found = documents.read_whole(spark, path).join(ids, "matchId", "left_semi")
        return flatten.distinct_documents(found.select("matchId", "start", "value"))

    found = workspace.stored(chosen(paths.match_inbox), "matches")
    sinks.without_start(found).write.mode("overwrite").json(f"{paths.skipped}/ds={ds}")
    dated = sinks.with_event_date(found)
    days = sorted(row["ds"] for row in dated.select("ds").distinct().collect())
    if not days:
        return days
    sinks.land_lines(dated, paths.matches)
    dates = dated.select("matchId", "ds")
    timelines = (
        chosen(paths.timeline_inbox).join(dates, "matchId", "left")
        .withColumn("ds", F.coalesce("ds", F.lit(ds).cast("date")))
    )
    sinks.land_lines(timelines, paths.timelines)
    return days


def stage_players(matches: DataFrame, ds: str | dt.date | Column, target: str) -> None:
    """Match documents to player rows, replacing the day or days."""
    day = ds if isinstance(ds, Column) else F.lit(str(ds))
    sinks.replace_partitions(flatten.flatten_players(matches, day), target)


def stage_gold(
    timelines: DataFrame, ds: str | dt.date | Column, target: str, missing: str = "null"
) -> None:
    """Timeline documents to gold rows, replacing the day or days."""
    day = ds if isinstance(ds, Column) else F.lit(str(ds))
    dated = timelines.withColumn("ds", day.cast("date"))
    sinks.replace_partitions(timeline.gold_timeline(dated, missing, ["ds"]), target)


def load_raw(spark: SparkSession, ds: str | dt.date, staged: str, target: str) -> None:
    """Load one staged day as semi-structured rows with the date out of the path."""
    schema = spark.read.parquet(f"{staged}/ds={ds}").schema
    rows = documents.read_staged(spark, f"{staged}/ds={ds}", schema)
    sinks.replace_partitions(documents.as_variant(rows), target)


def build_features(spark: SparkSession, days: Sequence[dt.date], players: str, target: str) -> None:
    """Difference features of these days' matches."""
    rows = tables.these_days(tables.read_table(spark, players), "ds", days)
    sinks.replace_partitions(features.match_features(rows), target, ["DS"])


def train(spark: SparkSession, source: str, model: str, **params) -> None:
    """Fit the win model on all matches there are and save it."""
    win_model.save(win_model.train_win_model(tables.read_table(spark, source), **params), model)


def explain_days(
    spark: SparkSession, days: Sequence[dt.date], source: str, model: str, target: str
) -> None:
    """Role contributions of these days with a saved model, replacing the days.

    ``target`` is a catalog table, made if missing, or a Parquet folder. A day without matches
    writes nothing.
    """
    matches = tables.these_days(tables.read_table(spark, source), "DS", days)
    rows = influence.contributions(win_model.load(model), matches)
    if "/" in target:
        sinks.replace_partitions(rows, target, ["DS"])
    else:
        sinks.ensure_role_table(spark, target)
        sinks.replace_table_day(rows, target)


def explain_day(spark: SparkSession, ds: str | dt.date, source: str, model: str, target: str) -> DataFrame:
    """The same for one day; returns its means, none for a day without matches."""
    explain_days(spark, [dt.date.fromisoformat(str(ds))], source, model, target)
    return day_report(spark, ds, target)


def day_report(spark: SparkSession, ds: str | dt.date, target: str) -> DataFrame:
    if "/" not in target:
        written = spark.table(target).select(*schemas.ROLE_CONTRIBUTION.names)
    else:
        written = spark.read.schema(schemas.ROLE_CONTRIBUTION).parquet(target)
    return roles.role_daily_mean(tables.one_day(written, "DS", ds))


def days_report(spark: SparkSession, days: Sequence[dt.date], target: str) -> DataFrame:
    """Mean contribution per role over several days."""
    written = spark.read.schema(schemas.ROLE_CONTRIBUTION).parquet(target)
    return roles.role_daily_mean(tables.these_days(written, "DS", days))


def run(
    spark: SparkSession,
    root: str,
    ds: str,
    count: int | None = None,
    limit_users: int | None = None,
    **params,
) -> DataFrame:
    """All stages of a day; returns the mean contribution per role over all days that the run landed.

    All days that the run landed go through each stage in one job.
    """
    paths = Paths(root)
    days = collect(spark, ds, paths, count, limit_users)
    if not days:
        return spark.createDataFrame([], "ROLE string, MEAN_PCT double")
    folders = [f"{paths.matches}/ds={day}" for day in days]
    participant = documents.all_participant_fields(spark, folders)
    matches = documents.read_landed(spark, paths.matches, schemas.match_schema(participant), days)
    stage_players(matches, F.col("ds"), paths.players)
    if workspace.exists(spark, paths.timelines):
        timelines = documents.read_landed(spark, paths.timelines, schemas.TIMELINE, days)
        stage_gold(timelines, F.col("ds"), paths.gold)
    for day in days:  # the date of a load is in the path of what it reads
        load_raw(spark, day, paths.players, paths.raw)
    build_features(spark, days, paths.players, paths.features)
    train(spark, paths.features, paths.model, **params)
    explain_days(spark, days, paths.features, paths.model, paths.roles)
    return days_report(spark, days, paths.roles)
