import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchloom import schemas
from matchloom.functions import text
from matchloom.operators import timeline
from matchloom.sources import documents
from tests.conftest import rows
from tests.documents import frame, timeline as document, without, write

GOLD = ("frame_minute", "blue_gold_total", "red_gold_total", "gold_diff")


@pytest.fixture
def gold(spark, tmp_path):
    def run(missing, **docs):
        path = write(tmp_path / "timelines", **docs)
        return timeline.gold_timeline(documents.read_timelines(spark, path), missing)

    return run


def test_full_frame(gold):
    for missing in ("zero", "null"):
        made = gold(missing, a=document("M_1", frame(60017)))
        row = made.collect()[0]
        assert (row.matchId, row.match_id, row.frame_minute) == ("M_1", "M_1", 1)
        assert (row.blue_gold_total, row.red_gold_total, row.gold_diff) == (1500, 4000, -2500)
        assert row.event_time == dt.datetime(1970, 1, 1, 0, 1, 0, 17000)


def test_missing_participant(gold):
    docs = {"a": document("M_1", frame(0, without(3)))}
    assert rows(gold("zero", **docs), *GOLD) == [(0, 1200, 4000, -2800)]
    assert rows(gold("null", **docs), *GOLD) == [(0, None, 4000, None)]


def test_no_document_has_participant_ten(gold):
    docs = {"a": document("M_1", frame(0, without(10)))}
    assert rows(gold("zero", **docs), *GOLD) == [(0, 1500, 3000, -1500)]
    assert rows(gold("null", **docs), *GOLD) == [(0, 1500, None, None)]


def test_no_frames(gold):
    assert gold("zero", a=document("M_1")).count() == 0


def test_null_map_and_null_gold(gold):
    empty = {"timestamp": 0, "participantFrames": None}
    assert rows(gold("zero", a=document("M_1", empty)), *GOLD) == [(0, 0, 0, 0)]
    assert rows(gold("null", a=document("M_1", empty)), *GOLD) == [(0, None, None, None)]
    one_null = document("M_1", frame(0, {**without(), 2: None}))
    assert rows(gold("zero", a=one_null), *GOLD) == [(0, 1300, 4000, -2700)]
    assert rows(gold("null", a=one_null), *GOLD) == [(0, None, 4000, None)]


def test_no_match_id(gold):
    bare = {"info": {"frames": [frame(0)]}}
    assert rows(gold("zero", a=bare), "matchId") == [("UNKNOWN_MATCH",)]
    assert rows(gold("null", a=bare), "matchId") == [(None,)]


def test_negative_time_truncates_in_rows_and_floors_in_messages(spark, tmp_path):
    path = write(tmp_path / "t", a=document("M_1", frame(-90000)))
    found = documents.read_timelines(spark, path)
    assert rows(timeline.gold_timeline(found), "frame_minute") == [(-1,)]
    assert rows(timeline.gold_events(found), "frameMinute") == [(-2,)]


def test_unknown_rule_is_refused(gold):
    with pytest.raises(ValueError):
        gold("none", a=document("M_1", frame(0)))


def test_messages_read_back(spark, tmp_path):
    path = write(tmp_path / "t", a=document("M_1", frame(60017), frame(120000, without(3))))
    events = timeline.gold_events(documents.read_timelines(spark, path))
    sent = timeline.messages(events, schemas.GOLD_MESSAGE.names)
    assert dict(sent.dtypes) == {"key": "binary", "value": "binary"}
    back = sent.select(
        F.col("key").cast("string").alias("key"),
        text.to_record(F.col("value").cast("string"), schemas.GOLD_MESSAGE).alias("m"),
    ).select("key", "m.*")
    assert rows(back) == [
        ("M_1", "M_1", 120000, 2, 1200, 4000, -2800, 120000),
        ("M_1", "M_1", 60017, 1, 1500, 4000, -2500, 60017),
    ]
