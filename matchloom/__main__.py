"""Jobs for ``spark-submit`` and ``python -m matchloom``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from matchloom import domain, schemas, workspace
from matchloom.operators import replay, timeline
from matchloom.plans import daily, influence
from matchloom.sinks import tables as sinks
from matchloom.sources import documents, tables
from matchloom.streaming import exact, gold


def players(spark: SparkSession, args) -> None:
    if args.fields:
        participant = StructType.fromDDL(args.fields)
    else:
        participant = documents.all_participant_fields(spark, args.input, multi_line=not args.lines)
    found = documents.read_matches(spark, args.input, participant, multi_line=not args.lines)
    daily.stage_players(found, args.ds, args.output)


def gold_batch(spark: SparkSession, args) -> None:
    found = documents.read_timelines(spark, args.input, multi_line=not args.lines)
    if args.ds:
        daily.stage_gold(found, args.ds, args.output, args.missing)
    else:
        rows = timeline.gold_timeline(found, args.missing)
        sinks.replace_partitions(rows, args.output, ["matchId"])


def stream_input(spark: SparkSession, args):
    if args.bootstrap_server:
        return gold.kafka_messages(spark, args.bootstrap_server, args.topic)
    return gold.file_messages(spark, args.input)


def stream_trigger(args) -> dict:
    return gold.DRAIN if args.drain else gold.TRIGGER


def gold_stream(spark: SparkSession, args) -> None:
    gold.stream_gold(
        stream_input(spark, args), args.output, args.checkpoint,
        by=args.partition_by.split(","), trigger=stream_trigger(args),
    ).awaitTermination()


def dedup_stream(spark: SparkSession, args) -> None:
    once = gold.without_redelivery(gold.gold_rows(stream_input(spark, args)), args.delay)
    query = gold.dedup_sink(
        gold.with_day(once), args.output, args.checkpoint,
        trigger=stream_trigger(args), partitions=args.partitions,
    )
    query.awaitTermination()
    print(f"rows behind the watermark: {gold.dropped(query)}")


def exact_stream(spark: SparkSession, args) -> None:
    rows = gold.gold_rows(stream_input(spark, args))
    exact.exact_sink(
        rows, args.output, args.checkpoint, late=args.delay, trigger=stream_trigger(args)
    ).awaitTermination()
    exact.counts(spark, args.output).orderBy("batch").show()


def window_stream(spark: SparkSession, args) -> None:
    rows = gold.gold_rows(stream_input(spark, args))
    query = gold.changes_sink(
        gold.gold_by_window(rows, args.delay, args.width), args.output, args.checkpoint,
        stream_trigger(args), args.partitions, hold_seconds=args.hold,
    )
    query.awaitTermination()
    print(f"rows behind the watermark: {gold.dropped(query)}")


def replay_messages(spark: SparkSession, args) -> None:
    found = documents.read_timelines(spark, args.file)
    # Order matters within a match only.
    events = timeline.gold_events(found).repartition("matchId").sortWithinPartitions("matchId", "frame_no")
    sent = timeline.messages(events, schemas.GOLD_MESSAGE.names)
    if args.bootstrap_server:
        sinks.publish(sent, args.bootstrap_server, args.topic)
    else:
        sinks.publish_files(sent, args.output)
    if args.schedule:
        replay.replay_schedule(found, args.speed).write.mode("overwrite").parquet(args.schedule)


def train(spark: SparkSession, args) -> None:
    daily.train(spark, args.features, args.model)


def role_contribution(spark: SparkSession, args) -> None:
    daily.explain_day(spark, args.ds, args.features, args.model, args.output).show()


def role_influence(spark: SparkSession, args) -> None:
    influence.role_influence(tables.read_table(spark, args.features), leafwise=args.leafwise).show()


def top_features(spark: SparkSession, args) -> None:
    rows = tables.last_days(tables.read_table(spark, args.players), "DS", args.as_of, 90)
    make = influence.top_features_per_position if args.per_position else influence.top_features_all
    make(rows, args.top, leafwise=args.leafwise).show(truncate=False)


def day(spark: SparkSession, args) -> None:
    daily.run(spark, args.root, args.ds, args.count, args.limit_users).show()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="matchloom")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, *required: str) -> argparse.ArgumentParser:
        made = jobs.add_parser(name)
        made.set_defaults(run=run, job=name)
        for option in required:
            made.add_argument(f"--{option}", required=True)
        return made

    made = job("players", players, "input", "output", "ds")
    made.add_argument("--lines", action="store_true", help="input is JSON Lines")
    fields = made.add_mutually_exclusive_group()
    fields.add_argument("--all-fields", action="store_true", help="find all fields by reading all documents first; the default")
    fields.add_argument("--fields", help="schema (DDL) of the participant fields to take instead, without that pass")

    made = job("gold", gold_batch, "input", "output")
    made.add_argument("--ds", help="partition by this day, else by match")
    made.add_argument("--missing", choices=["null", "zero"], default="null")
    made.add_argument("--lines", action="store_true")

    def stream(name: str, run) -> argparse.ArgumentParser:
        made = job(name, run, "output", "checkpoint")
        made.add_argument("--bootstrap-server")
        made.add_argument("--topic", default=domain.FRAME_TOPIC)
        made.add_argument("--input", help="folder of message files, without a server")
        made.add_argument("--drain", action="store_true", help="stop when all input is read")
        return made

    stream("gold-stream", gold_stream).add_argument("--partition-by", default="ds")
    for made in (stream("dedup-stream", dedup_stream), stream("window-stream", window_stream)):
        made.add_argument("--delay", default="10 minutes", help="how far apart copies arrive")
        made.add_argument("--partitions", type=int, help="of the state, kept from the first start on")
    made.add_argument("--width", default="1 minute")
    made.add_argument("--hold", type=float, default=3600, help="seconds that folded parts stay for readers")
    made = stream("exact-stream", exact_stream)
    made.add_argument("--delay", default="10 minutes", help="what counts as late; late rows are kept")

    made = job("replay", replay_messages, "file")
    made.add_argument("--bootstrap-server")
    made.add_argument("--topic", default=domain.FRAME_TOPIC)
    made.add_argument("--output", help="folder for message files, without a server")
    made.add_argument("--speed", type=int, default=60)
    made.add_argument("--schedule", help="where to write the send times")

    job("train", train, "features", "model")
    job("role-contribution", role_contribution, "ds", "features", "model", "output")
    made = job("role-influence", role_influence, "features")
    made.add_argument("--leafwise", action="store_true", help="trees that grow leaf by leaf")

    made = job("top-features", top_features, "players")
    made.add_argument("--leafwise", action="store_true", help="trees that grow leaf by leaf")
    made.add_argument("--as-of")
    made.add_argument("--top", type=int, default=3)
    made.add_argument("--per-position", action="store_true")

    made = job("daily", day, "root", "ds")
    made.add_argument("--count", type=int, help="latest matches of each player; all without")
    made.add_argument("--limit-users", type=int, help="first players of the list; all without")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = workspace.session(f"matchloom {args.job}")
    args.run(spark, args)


if __name__ == "__main__":
    main()
