import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from matchloom import schemas, workspace
from matchloom.operators import flatten
from matchloom.sinks import tables as sinks
from matchloom.sources import documents, tables
from tests.conftest import rows
from tests.documents import match, timeline, write

DAY_MS = 86_400_000


def day_rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id int, ds string").withColumn("ds", F.to_date("ds"))


def test_rerun_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_partitions(day_rows(spark, (1, "2024-05-01"), (2, "2024-05-02")), path)
    for _ in range(2):
        sinks.replace_partitions(day_rows(spark, (3, "2024-05-02"), (4, "2024-05-02")), path)
    assert rows(spark.read.parquet(path), "id") == [(1,), (3,), (4,)]


def test_append_adds_again(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.append_partitions(day_rows(spark, (1, "2024-05-01")), path, ["ds"])
    assert spark.read.parquet(path).count() == 2


def test_match_partition_keeps_its_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    data = spark.createDataFrame([("1", "1", 5)], "matchId string, match_id string, gold long")
    sinks.replace_partitions(data, path, ["matchId"])
    inferred = spark.read.parquet(path)
    assert dict(inferred.dtypes)["matchId"] == "int"  # why readers declare their schema
    declared = spark.read.schema(data.schema).parquet(path)
    assert rows(declared, *data.columns) == rows(data)


def test_land_by_start_date(spark, tmp_path):
    late = 1758153599538
    path = write(
        tmp_path / "m", a=match("M_1", late), b=match("M_2", late + 1000),
        c={"metadata": {"matchId": "M_3"}, "info": {}}, d={},
    )
    out = str(tmp_path / "out")
    found = documents.read_whole(spark, path)
    sinks.land_matches(found, out)
    assert tuple(sinks.without_start(found).first()) == (2, 0)
    landed = documents.read_landed(spark, out, schemas.MATCH)
    assert rows(landed, "metadata.matchId", "ds") == [
        ("M_1", dt.date(2025, 9, 17)), ("M_2", dt.date(2025, 9, 18)),
    ]
    assert flatten.flatten_players(landed.drop("ds"), "2025-09-17").count() == 20


def test_timelines_land_by_run_date(spark, tmp_path):
    path = write(tmp_path / "t", a=timeline("M_1"))
    out = str(tmp_path / "out")
    sinks.land_timelines(documents.read_whole(spark, path), out, "2024-05-01")
    landed = documents.read_landed(spark, out, schemas.TIMELINE)
    assert rows(landed, "metadata.matchId", "ds") == [("M_1", dt.date(2024, 5, 1))]


def test_later_documents_count_and_nothing_is_rewritten(spark, tmp_path):
    out = str(tmp_path / "out")

    def land(name, **docs):
        before = {p: p.read_bytes() for p in (tmp_path / "out").rglob("*.txt")}
        sinks.land_matches(documents.read_whole(spark, write(tmp_path / name, **docs)), out)
        assert all(p.read_bytes() == held for p, held in before.items())

    land("a", a=match("M_1", DAY_MS), b=match("M_2", DAY_MS), x=match(None, DAY_MS), y=match(None, DAY_MS))
    land("b", a=match("M_2", DAY_MS, numbers=[1]), b=match("M_3", DAY_MS * 2))
    landed = documents.read_landed(spark, out, schemas.MATCH)
    assert rows(landed.select("metadata.matchId", F.size("info.participants"))) == [
        ("M_1", 10), ("M_2", 1), ("M_3", 10), (None, 10), (None, 10),
    ]
    one = documents.read_landed(spark, out, schemas.MATCH, [dt.date(1970, 1, 3)])
    assert rows(one, "metadata.matchId") == [("M_3",)]


def test_documents_land_whole(spark, tmp_path):
    sent = match("M_1", DAY_MS, change=lambda i: {"championName": f"c{i}", "challenges": {"soloKills": i, "other": [i]}})
    sent["metadata"]["dataVersion"] = "2"
    sent["info"] |= {"gameMode": "CLASSIC", "ratio": 0.1, "big": 2**60}
    out = str(tmp_path / "out")
    path = write(tmp_path / "in", a=sent)
    (tmp_path / "in" / "bad.json").write_text("{no")
    found = documents.read_whole(spark, path)
    assert sinks.without_start(found).first()["not_json"] == 1
    sinks.land_matches(found, out)
    (line,) = spark.read.text(out).select("value").collect()
    assert json.loads(line[0]) == sent
    fields = documents.all_participant_fields(spark, out)
    landed = documents.read_landed(spark, out, schemas.match_schema(fields))
    players = flatten.flatten_players(landed, F.col("ds"))
    assert rows(players.select("participantId", "championName", "challenges.other", "challenges.turretPlatesTaken")) == sorted(
        ((i, f"c{i}", [i], None) for i in range(1, 11)), key=repr
    )


def test_staged_load_takes_the_date_from_the_path(spark, tmp_path):
    path = str(tmp_path / "staged")
    sinks.replace_partitions(day_rows(spark, (1, "2024-05-01"), (2, "2024-05-02")), path)
    loaded = documents.read_staged(spark, path, schemas.record(id=IntegerType()))
    assert rows(loaded) == [(1, dt.date(2024, 5, 1)), (2, dt.date(2024, 5, 2))]
    variant = documents.as_variant(loaded)
    assert dict(variant.dtypes) == {"v": "variant", "ds": "date"}
    assert rows(variant.select(F.variant_get("v", "$.id", "int"))) == [(1,), (2,)]


def test_role_table(spark, tmp_path):
    location = str(tmp_path / "roles")
    for _ in range(2):
        sinks.ensure_role_table(spark, "role_win", location)
    day = spark.createDataFrame(
        [(dt.date(2024, 5, 1), "M_1", "TOP", 20.0)], schemas.ROLE_CONTRIBUTION
    )
    other = day.withColumn("DS", F.lit("2024-05-02").cast("date"))
    for data in (day, other, day.withColumn("CONTRIB_PCT", F.lit(30.0))):
        sinks.replace_table_day(data, "role_win")
    got = tables.read_table(spark, "role_win").orderBy("DS").select("CONTRIB_PCT").collect()
    assert [r[0] for r in got] == [30.0, 20.0]
    spark.sql("DROP TABLE role_win")


def test_shared_folder_is_the_configured_one(spark):
    assert workspace.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = workspace.stored(spark.range(3), "y")
    assert rows(kept) == [(0,), (1,), (2,)]


def test_settings_come_back(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with workspace.conf(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get(name) == "3"
    assert spark.conf.get(name) == before
