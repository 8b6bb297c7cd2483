"""What landing, flattening and ingesting write, shuffle and read."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from matchloom import schemas, workspace
from matchloom.operators import boosting, skew
from matchloom.plans import catalog
from matchloom.sinks import tables
from matchloom.sources import documents
from matchloom.streaming import documents as streamed
from tests.conftest import rows


@pytest.fixture()
def sf(spark, tmp_path):
    """3 orders of 10 lines."""
    lines = spark.range(30).selectExpr(
        "id div 10 + 4095 AS l_orderkey", "id % 7 AS l_partkey", "id % 5 AS l_suppkey", "int(id % 5 + 1) AS l_linenumber",
        "double(id % 9 + 1) AS l_quantity", "double(id) AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax",
        "'R' AS l_returnflag", "IF(id % 2 = 0, 'F', 'O') AS l_linestatus", "timestamp_ntz'1997-01-01' AS l_shipdate",
    )
    orders = spark.range(3).selectExpr(
        "id + 4095 AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "double(id) + 100 AS o_totalprice",
        "IF(id = 0, timestamp_ntz'1997-01-01', timestamp_ntz'1999-01-01') AS o_orderdate", "'x' AS o_orderpriority",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


@pytest.fixture()
def written(spark, tmp_path, monkeypatch):
    """Text and JSON files that a query left in its scratch folders."""
    made = tmp_path / "made"
    monkeypatch.setattr(workspace, "scratch", lambda spark, label: f"{made}/{label}")

    def files():
        return [p for p in made.rglob("part-*") if ".txt" in p.name or ".json" in p.name]

    return files


@pytest.mark.parametrize("name, count", [
    ("land_by_event_date", 3), ("flatten_all_fields", 30), ("flatten_multi_line", 30), ("stream_ingest_new", 30), ("stream_ingest_whole", 30),
])
def test_json_is_written_compressed(spark, sf, written, name, count):
    made = catalog.QUERIES[name](spark, sf)
    assert made.count() == count
    assert written() and all(p.name.endswith(".gz") for p in written())


def landed(spark, tmp_path, *runs):
    for run in runs:
        texts = [(f'{{"metadata":{{"matchId":{m}}},"info":{{"gameDuration":{n}}}}}', ds) for m, n, ds in run]
        rows_ = spark.createDataFrame(texts, "value string, day string").select("value", F.col("day").cast("date").alias("ds"))
        tables.land_lines(rows_, str(tmp_path / "raw"))
    return documents.read_landed(spark, str(tmp_path / "raw"), schemas.MATCH)


def test_days_of_one_run_are_read_without_a_join(spark, tmp_path):
    found = landed(spark, tmp_path, [('"M_1"', 1, "2024-05-01"), ('"M_1"', 2, "2024-05-01"), ("null", 3, "2024-05-01")])
    assert "Join" not in found._jdf.queryExecution().toString()
    assert sorted(r[0] for r in found.select("info.gameDuration").collect()) == [1, 2, 3]


def test_of_several_runs_the_last_counts(spark, tmp_path):
    found = landed(
        spark, tmp_path,
        [('"M_1"', 1, "2024-05-01"), ('"M_2"', 2, "2024-05-01"), ("null", 3, "2024-05-01"), ('"M_1"', 4, "2024-05-02"), ('"M_9"', 5, None)],
        [('"M_1"', 6, "2024-05-01"), ("null", 7, "2024-05-01"), ('"M_3"', 8, "2024-05-03"), ('"M_9"', 9, None)],
    )
    assert rows(found.select("info.gameDuration")) == [(2,), (3,), (4,), (6,), (7,), (8,)]
    assert found.columns == ["metadata", "info", "ds"]


def test_landing_again_rewrites_nothing(spark, tmp_path):
    landed(spark, tmp_path, [('"M_1"', 1, "2024-05-01")])
    before = {p: p.read_bytes() for p in (tmp_path / "raw").rglob("part-*")}
    landed(spark, tmp_path, [('"M_1"', 2, "2024-05-01")])
    assert before and all(p.read_bytes() == held for p, held in before.items())


def test_totals_without_a_hot_group_shuffle_rows_once(spark):
    data = spark.createDataFrame([(1, 2), (1, 3), (None, 4), (None, 5)], "k int, v int")
    made = skew.with_group_totals(data, ["k"], {"total": F.sum("v")}, 2)
    assert rows(made) == [(1, 2, 5), (1, 3, 5), (None, 4, 9), (None, 5, 9)]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "Join" not in plan and "Aggregate" not in plan
    assert "Join" in skew.with_group_totals(data, ["k"], {"total": F.sum("v")}, 1)._jdf.queryExecution().optimizedPlan().toString()


def test_a_document_is_parsed_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"info":{"gameStartTimestamp":5}}\n{no\n')
    read = documents.read_whole(spark, str(tmp_path / "in"), multi_line=False)
    assert rows(read, "start", "raw") == sorted([(5, None), (None, "{no")], key=repr)
    dated = tables.with_event_date(read)
    assert dated._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_a_streamed_file_is_parsed_once_and_not_copied_to_each_document(spark, tmp_path):
    (tmp_path / "in").mkdir()
    found = streamed.whole_documents(SimpleNamespace(readStream=spark.read), str(tmp_path / "in"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    last = next(line for line in plan.splitlines() if "Generate explode(each" in line)
    assert "value#" not in last.split("Generate")[1]


def test_a_document_does_not_go_along_with_its_players(spark):
    found = spark.sql("""SELECT 'M_1' AS matchId, 5L AS start, parse_json(v) AS document FROM VALUES
        ('{"info":{"gameDuration":7,"participants":[{"a":1},{"a":2}]}}'), ('{"info":{"participants":[]}}') AS t(v)""")
    made = streamed.whole_players(found)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "variant_get(document" not in plan.split("Generate")[0]
    assert rows(made.select("matchId", "gameDuration", F.to_json("player"))) == [("M_1", 7, '{"a":1}'), ("M_1", 7, '{"a":2}')]


def test_features_of_few_values_need_no_sketch(spark, monkeypatch):
    data = spark.range(100).selectExpr("id % 3 AS a", "double(id) AS b", "IF(id = 0, double('NaN'), id % 5) AS c")
    expected = {f.name: f.cuts for f in boosting.numeric_features(data, ["a", "b", "c"], 10)}
    assert expected["a"] == (0.0, 1.0) and expected["c"] == (0.0, 1.0, 2.0, 3.0) and 5 < len(expected["b"]) < 10
    sketched = []
    plain = F.percentile_approx
    monkeypatch.setattr(boosting.F, "percentile_approx", lambda c, *a: sketched.append(c) or plain(c, *a))
    boosting.numeric_features(data, ["a", "b", "c"], 10)
    assert sketched == ["`b`"]
    assert boosting.numeric_features(data, ["a", "c"], 10)[0].cuts == (0.0, 1.0) and sketched == ["`b`"]
