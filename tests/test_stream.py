import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from matchloom import schemas
from matchloom.operators import timeline
from matchloom.sinks import tables as sinks
from matchloom.sources import documents
from matchloom.streaming import gold
from tests.conftest import rows
from tests.documents import frame, timeline as document, without, write

LINES = [
    '{"matchId":"M_1","eventTs":1500}',
    "{bad",
    '{"matchId":"M_1","eventTs":"x"}',
    '{"eventTs":5}',
]


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


def run(spark, tmp_path, **more):
    query = gold.stream_gold(
        gold.file_messages(spark, str(tmp_path / "in")), str(tmp_path / "gold"),
        str(tmp_path / "checkpoint"), trigger=gold.DRAIN, **more,
    )
    gold.drain(query)


def stored(spark, tmp_path):
    return gold.stored_gold(spark, str(tmp_path / "gold"))


def test_good_and_rejected_messages(spark, tmp_path):
    put(tmp_path / "in", "a.txt", LINES)
    run(spark, tmp_path, day="event")
    assert rows(stored(spark, tmp_path), "matchId", "eventTs", "event_time", "goldDiff") == [
        ("M_1", 1500, dt.datetime(1970, 1, 1, 0, 0, 1, 500000), None),
    ]
    # Half-parsed ones are rejected too, and none lands without a day or a match.
    assert rows(gold.stored_rejected(spark, str(tmp_path / "gold"))) == sorted((x,) for x in LINES[1:])


def test_restart_adds_new_messages_only(spark, tmp_path):
    put(tmp_path / "in", "a.txt", LINES[:1])
    run(spark, tmp_path)
    run(spark, tmp_path)
    assert stored(spark, tmp_path).count() == 1
    put(tmp_path / "in", "b.txt", LINES[:1])
    run(spark, tmp_path)
    assert stored(spark, tmp_path).count() == 2  # append keeps duplicates


def test_partition_by_match(spark, tmp_path):
    put(tmp_path / "in", "a.txt", LINES[:1])
    run(spark, tmp_path, by=["matchId"])
    assert (tmp_path / "gold" / "rejected=false" / "matchId=M_1").is_dir()


def test_stream_equals_batch(spark, tmp_path):
    path = write(
        tmp_path / "t", a=document("M_1", frame(0), frame(60017, without(3))), b=document("M_2", frame(5))
    )
    found = documents.read_timelines(spark, path)
    events = timeline.gold_events(found)
    sinks.publish_files(timeline.messages(events, schemas.GOLD_MESSAGE.names), str(tmp_path / "in"))
    run(spark, tmp_path)
    streamed = stored(spark, tmp_path).select(
        "matchId", "event_time", F.col("frameMinute").cast("int"), "blueTotalGold", "redTotalGold", "goldDiff"
    )
    batch = timeline.gold_timeline(found, "zero").drop("match_id")
    assert rows(streamed) == rows(batch)


MESSAGE = '{"matchId":"%s","frameTimestamp":%d,"eventTs":%d,"goldDiff":%d}'


def game(match, frames=31):
    """The frames of a match, one a minute from 0, as the producer sends them."""
    return [MESSAGE % (match, i * 60000, i * 60000, i) for i in range(frames)]


def dedup(spark, tmp_path):
    once = gold.without_redelivery(gold.gold_rows(gold.file_messages(spark, str(tmp_path / "in"))))
    query = gold.dedup_sink(
        once, str(tmp_path / "o"), str(tmp_path / "c"), (), gold.DRAIN, partitions=3
    )
    gold.drain(query)
    assert gold.dropped(query) == 0
    return spark.read.parquet(str(tmp_path / "o"))


def test_redelivery_is_dropped(spark, tmp_path):
    lines = game("M_1", 2)
    # One message makes up most of the input, in several files.
    for part in range(4):
        put(tmp_path / "in", f"{part}.txt", lines[:1] * 50 + lines)
    for _ in range(2):
        back = dedup(spark, tmp_path)
        put(tmp_path / "in", "late.txt", lines)
    assert rows(back, "frameTimestamp") == [(0,), (60000,)]


def test_a_match_after_another_keeps_all_frames(spark, tmp_path):
    for match in ("M_1", "M_2"):
        put(tmp_path / "in", f"{match}.txt", game(match))
        back = dedup(spark, tmp_path)
        windows(spark, tmp_path)
    assert rows(back.groupBy("matchId").count()) == [("M_1", 31), ("M_2", 31)]
    shown = gold.latest_changes(spark, str(tmp_path / "wo"))
    assert rows(shown.groupBy("matchId").count()) == [("M_1", 31), ("M_2", 31)]


def windows(spark, tmp_path, checkpoint="wc", **more):
    found = gold.gold_by_window(gold.gold_rows(gold.file_messages(spark, str(tmp_path / "in"))))
    query = gold.changes_sink(
        found, str(tmp_path / "wo"), str(tmp_path / checkpoint), gold.DRAIN, **more
    )
    gold.drain(query)
    assert gold.dropped(query) == 0
    latest = gold.latest_changes(spark, str(tmp_path / "wo"))
    return rows(latest.select("matchId", F.unix_millis("window_start"), "goldDiff"))


def test_windows_show_their_latest_value(spark, tmp_path):
    def go(name, *values):
        put(tmp_path / "in", name, [MESSAGE % ("M_1", ts, ts, diff) for ts, diff in values])
        return [x[1:] for x in windows(spark, tmp_path)]

    assert go("a", (59000, 1), (1000, 2), (61000, 3)) == [(0, 1), (60000, 3)]
    assert go("b", (119000, 4), (3_600_000, 5)) == [(0, 1), (3600000, 5), (60000, 4)]
    # A message from far behind in the match counts as any other.
    assert go("c", (59500, 9), (3_601_000, 6)) == [(0, 9), (3600000, 6), (60000, 4)]


def test_changes_survive_folding_and_a_new_checkpoint(spark, tmp_path):
    put(tmp_path / "in", "a", game("M_1", 3))
    first = windows(spark, tmp_path)
    put(tmp_path / "in", "b", [MESSAGE % ("M_1", 119000, 119000, 7)])
    second = windows(spark, tmp_path, fold_every=1)
    assert [x[2] for x in first] == [0, 2, 1] and [x[2] for x in second] == [0, 2, 7]
    parts = [p.name for p in (tmp_path / "wo").glob("ds=*/part=*")]
    assert len(parts) == 1 and parts[0].startswith("part=folded-")
    # Everything is read again under another checkpoint, then written twice.
    assert windows(spark, tmp_path, "another") == second
    day = spark.read.parquet(str(tmp_path / "wo")).first()["ds"]
    gold.fold_changes(spark, str(tmp_path / "wo"), day)
    assert gold.latest_changes(spark, str(tmp_path / "wo"), since=day).count() == 3
    assert gold.latest_changes(spark, str(tmp_path / "wo"), since=day + dt.timedelta(1)).count() == 0


def test_kafka_options():
    options = gold.kafka_options("host:1")
    assert options["startingOffsets"] == "earliest"
    assert options["subscribe"] == "timeline.frames"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException):
        gold.kafka_messages(spark, "host:1")


def test_whole_documents_of_any_layout(spark, tmp_path):
    from matchloom.streaming import documents

    files = {
        "one.json": '{\n "metadata": {"matchId": "M1"},\n "info": {"gameStartTimestamp": 1714521600000, "gameDuration": "7",\n  "participants": [{"participantId": 1, "kills": "many", "extra": {"x": [1]}}, 5]}\n}',
        "many.json": '[{"metadata": {"matchId": "M2"}, "info": {"participants": []}},\n {"metadata": {"matchId": 3}}, 4]',
        "none.json": "[]", "broken.json": '{"metadata": {', "empty.json": "",
    }
    (tmp_path / "in").mkdir()
    for name, text in files.items():
        (tmp_path / "in" / name).write_text(text)
    found = documents.whole_documents(spark, str(tmp_path / "in"), max_files=2)
    gold.drain(gold.parquet_sink(found, str(tmp_path / "out"), str(tmp_path / "ck"), (), gold.DRAIN))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back.where("raw is null"), "matchId", "start") == sorted([("M1", 1714521600000), ("M2", None), ("3", None), (None, None)], key=repr)
    assert {r["raw"] for r in back.where("raw is not null").collect()} <= {'{"metadata": {', ""}
    players = documents.typed(documents.whole_players(back), {"participantId": "long", "kills": "long"})
    got = players.select("matchId", "gameDuration", "participantId", "kills", F.to_json("player").alias("player"))
    assert rows(got) == sorted([("M1", 7, 1, None, '{"extra":{"x":[1]},"kills":"many","participantId":1}'), ("M1", 7, None, None, "5")], key=repr)
