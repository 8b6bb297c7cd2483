import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from matchloom import __main__ as cli
from matchloom import schemas, workspace
from matchloom.plans import daily
from matchloom.streaming import gold
from tests.conftest import rows
from tests.documents import frame, match, timeline, write

DAY = dt.date(2024, 5, 1)
START = 1714521600
SMALL = {"maxIter": 3, "maxDepth": 2, "minInstancesPerNode": 1}


def inbox(root, count=24):
    """Two players with ``count`` matches of the day each, half of them shared, one that
    ends up on the next day, and one match of a player nobody asked for."""
    write(root / "inbox" / "league", a={"entries": [{"puuid": f"p{i}"} for i in range(3)]})
    listed = [("p0", i) for i in range(count)] + [("p1", i + count // 2) for i in range(count)]
    lines = [
        {"puuid": p, "startTs": START + 60 * i, "matchId": f"M_{i}"} for p, i in listed
    ]
    lines.append({"puuid": "p0", "startTs": START + 86000, "matchId": "M_late"})
    lines.append({"puuid": "p9", "startTs": START, "matchId": "M_other"})
    lines.append({"puuid": "p0", "startTs": START - 1, "matchId": "M_before"})
    folder = root / "inbox" / "player_matches"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join(json.dumps(line) for line in lines))

    found = {i for _, i in listed}
    docs = {
        f"M_{i}": match(
            f"M_{i}", (START + 60 * i) * 1000, blue_wins=i % 2 == 0,
            change=lambda n, i=i: {"kills": (20 if (n <= 5) == (i % 2 == 0) else 3) + (n * i) % 3},
        )
        for i in found
    }
    docs["M_late"] = match("M_late", (START + 86400 + 5) * 1000)
    docs["M_other"] = match("M_other", START * 1000)
    docs["copy"] = docs["M_0"]
    write(root / "inbox" / "match", **docs)
    write(
        root / "inbox" / "match_timeline",
        **{f"M_{i}": timeline(f"M_{i}", frame(0), frame(60017)) for i in found},
        M_other=timeline("M_other", frame(0)),
    )
    return found


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("daily")
    found = inbox(root)
    # A day that was there before stays as it is.
    old = spark.createDataFrame([("M_old", dt.date(2024, 4, 1))], "matchId string, ds date")
    old.write.partitionBy("ds").parquet(str(root / "staging" / "gold_diffs"))
    report = daily.run(spark, str(root), str(DAY), **SMALL)
    return root, found, report.collect()


def test_players_of_the_asked_matches(spark, ran):
    root, found, _ = ran
    players = spark.read.parquet(str(root / "staging" / "match_player_stats"))
    per_day = {r["ds"]: r for r in players.groupBy("ds").agg(
        F.count("*").alias("n"), F.countDistinct("matchId").alias("m")).collect()}
    assert (per_day[DAY]["n"], per_day[DAY]["m"]) == (10 * len(found), len(found))
    late = DAY + dt.timedelta(days=1)
    assert (per_day[late]["n"], per_day[late]["m"]) == (10, 1)
    assert not players.where("matchId in ('M_other', 'M_before')").count()


def test_gold_of_the_day(spark, ran):
    root, found, _ = ran
    gold = spark.read.option("mergeSchema", True).parquet(str(root / "staging" / "gold_diffs"))
    assert gold.where(F.col("ds") == F.lit(DAY)).count() == 2 * len(found)
    assert rows(gold.where(F.col("ds") < F.lit(DAY)), "matchId") == [("M_old",)]


def test_raw_rows(spark, ran):
    root, found, _ = ran
    raw = spark.read.schema("v variant, ds date").parquet(str(root / "raw_table"))
    ids = raw.where(F.col("ds") == F.lit(DAY)).select(F.variant_get("v", "$.matchId", "string").alias("id"))
    assert ids.distinct().count() == len(found)


def test_contributions_and_report(spark, ran):
    root, found, report = ran
    made = spark.read.schema(schemas.ROLE_CONTRIBUTION).parquet(str(root / "mart" / "role_contribution"))
    assert made.where(F.col("DS") == F.lit(DAY)).count() == 5 * len(found)
    assert {r["ROLE"] for r in report} == {"TOP", "JNG", "MID", "BOT", "SUP"}
    assert sum(r["MEAN_PCT"] for r in report) == pytest.approx(100, abs=0.1)


def test_rerun_changes_nothing(spark, ran):
    root, _, report = ran
    names = ("staging/match_player_stats", "raw_table", "mart/role_contribution")

    def sizes():
        return [spark.read.parquet(str(root / n)).count() for n in names]

    before = sizes()
    again = daily.run(spark, str(root), str(DAY), **SMALL).collect()
    assert sizes() == before
    assert again == report


def test_what_a_run_left_out_is_counted(spark, ran):
    root, _, _ = ran
    counted = spark.read.json(str(root / "reports/skipped")).where(F.col("ds") == F.lit(DAY))
    assert counted.select("without_start", "not_json").count() == 1


def test_day_without_matches(spark, ran):
    root, _, _ = ran
    report = daily.run(spark, str(root), "2023-01-01", **SMALL)
    assert report.columns == ["ROLE", "MEAN_PCT"] and report.count() == 0


def run_job(spark, *argv):
    args = cli.parser().parse_args([str(a) for a in argv])
    args.run(spark, args)


def test_jobs(spark, tmp_path, capsys):
    docs = write(tmp_path / "m", a=match("M_1", 0), b=match("M_2", 0))
    lines = write(tmp_path / "t", a=timeline("M_1", frame(0), frame(60017)))

    run_job(spark, "players", "--input", docs, "--output", tmp_path / "players", "--ds", "2024-05-01")
    run_job(
        spark, "players", "--input", docs, "--output", tmp_path / "sampled", "--ds", "2024-05-01",
        "--all-fields",
    )
    for out in ("players", "sampled"):
        assert spark.read.parquet(str(tmp_path / out)).count() == 20

    run_job(spark, "gold", "--input", lines, "--output", tmp_path / "gold")
    assert (tmp_path / "gold" / "matchId=M_1").is_dir()
    run_job(spark, "gold", "--input", lines, "--output", tmp_path / "gold_ds", "--ds", "2024-05-01")
    assert (tmp_path / "gold_ds" / "ds=2024-05-01").is_dir()

    run_job(spark, "replay", "--file", lines, "--output", tmp_path / "sent", "--schedule", tmp_path / "plan")
    assert spark.read.parquet(str(tmp_path / "plan")).count() == 2
    run_job(
        spark, "gold-stream", "--input", tmp_path / "sent", "--output", tmp_path / "live",
        "--checkpoint", tmp_path / "c", "--drain", "--partition-by", "matchId",
    )
    live = gold.stored_gold(spark, str(tmp_path / "live"))
    assert rows(live, "matchId", "goldDiff") == [("M_1", -2500), ("M_1", -2500)]
    run_job(
        spark, "dedup-stream", "--input", tmp_path / "sent", "--output", tmp_path / "once",
        "--checkpoint", tmp_path / "c1", "--drain", "--partitions", "2",
    )
    assert spark.read.parquet(str(tmp_path / "once")).count() == 2
    run_job(
        spark, "window-stream", "--input", tmp_path / "sent", "--output", tmp_path / "shown",
        "--checkpoint", tmp_path / "c2", "--drain", "--partitions", "2",
    )
    assert gold.latest_changes(spark, str(tmp_path / "shown")).count() == 2
    run_job(
        spark, "exact-stream", "--input", tmp_path / "sent", "--output", tmp_path / "exact",
        "--checkpoint", tmp_path / "c3", "--drain",
    )
    out = capsys.readouterr().out
    assert out.count("rows behind the watermark: 0") == 2 and "copies" in out


def test_players_job_keeps_all_fields(spark, tmp_path):
    docs = write(tmp_path / "m", a=match("M_1", 0, change=lambda i: {"extra": i}), b=match("M_2", 0))
    job = ("players", "--input", docs, "--ds", "2024-05-01", "--output")
    run_job(spark, *job, tmp_path / "all")
    made = spark.read.parquet(str(tmp_path / "all")).where("matchId = 'M_1'")
    assert rows(made, "extra") == sorted([(i,) for i in range(1, 11)], key=repr)
    run_job(spark, *job, tmp_path / "fixed", "--fields", "participantId int, extra long")
    fixed = spark.read.parquet(str(tmp_path / "fixed"))
    assert fixed.columns == ["matchId", "gameDuration", "participantId", "extra", "ds"] and fixed.count() == 20


def test_influence_jobs(spark, ran, tmp_path, capsys):
    root, found, _ = ran
    table = root / "mart" / "match_features"
    run_job(
        spark, "role-contribution", "--ds", DAY, "--features", table, "--model", root / "model",
        "--output", tmp_path / "roles",
    )
    run_job(spark, "role-influence", "--features", table)
    assert "MEAN_PCT" in capsys.readouterr().out
    assert workspace.exists(spark, str(tmp_path / "roles"))
