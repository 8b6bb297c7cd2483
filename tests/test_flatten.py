import datetime as dt

from pyspark.sql import types as T

from matchloom import schemas
from matchloom.operators import flatten
from matchloom.sources import documents
from tests.conftest import rows
from tests.documents import match, write


def test_one_row_per_participant(spark, tmp_path):
    path = write(tmp_path / "m", a=match("M_1", 0), b=match("M_2", 0, numbers=range(1, 4)))
    players = flatten.flatten_players(documents.read_matches(spark, path), "2024-05-01")
    assert players.count() == 13
    assert players.columns == ["matchId", "gameDuration", *schemas.PARTICIPANT.names, "ds"]
    first = players.where("matchId = 'M_2' and participantId = 1").collect()[0]
    assert first.ds == dt.date(2024, 5, 1) and first.challenges.soloKills == 1


def test_no_participants_no_row(spark, tmp_path):
    path = write(
        tmp_path / "m",
        a=match("M_1", 0, numbers=()),
        b={"metadata": {"matchId": "M_2"}, "info": {"gameDuration": 1, "participants": None}},
    )
    assert flatten.flatten_players(documents.read_matches(spark, path), "2024-05-01").count() == 0


def test_clashing_participant_fields_are_renamed(spark, tmp_path):
    fields = T.StructType(
        [T.StructField("DS", T.StringType()), T.StructField("matchid", T.StringType())]
    )
    document = {
        "metadata": {"matchId": "M_1"},
        "info": {"gameDuration": 1, "participants": [{"DS": "x", "matchid": "y"}]},
    }
    path = write(tmp_path / "m", a=document)
    players = flatten.flatten_players(documents.read_matches(spark, path, fields), "2024-05-01")
    assert players.columns == ["matchId", "gameDuration", "player_DS", "player_matchid", "ds"]
    players.write.partitionBy("ds").parquet(str(tmp_path / "out"))
    assert rows(players, "player_DS", "player_matchid") == [("x", "y")]


def test_all_fields(spark, tmp_path):
    path = write(tmp_path / "m", a=match("M_1", 0, change=lambda i: {"extra": i}), b=match("M_2", 0))
    fields = documents.all_participant_fields(spark, path, multi_line=True)
    assert fields.names == [*schemas.PARTICIPANT.names, "extra"]
    players = flatten.flatten_players(documents.read_matches(spark, path, fields), "2024-05-01")
    assert rows(players.where("matchId = 'M_1'"), "extra") == sorted([(i,) for i in range(1, 11)], key=repr)


def test_copies_of_a_match_count_once(spark, tmp_path):
    path = write(
        tmp_path / "m", a=match("M_1", 0), b=match("M_1", 0), c=match("M_2", 0), d=match(None, 0), e=match(None, 0),
        f=match("M_2", 0, numbers=[1]),
    )
    found = documents.read_whole(spark, path)
    once = flatten.distinct_documents(found)
    assert once.columns == found.columns
    assert rows(once, "matchId") == [("M_1",), ("M_2",), (None,), (None,)]
    kept = once.where("matchId = 'M_2'").select("value").first()[0]
    assert kept.count("participantId") == 10


def test_league_list(spark, tmp_path):
    path = write(tmp_path / "l", a={"entries": [{"puuid": "p2"}, {"puuid": "p1"}]}, b={"entries": []})
    assert rows(documents.read_league(spark, path)) == [("p1",), ("p2",)]


def test_day_glob(spark, tmp_path):
    for day in ("2024-05-01", "2024-05-02"):
        write(tmp_path / f"ds={day}", a=match(f"M_{day}", 0))
    found = documents.read_matches(spark, documents.day_glob(str(tmp_path), "2024-05-02"))
    assert rows(found, "metadata.matchId") == [("M_2024-05-02",)]
