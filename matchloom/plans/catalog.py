"""The registered queries: each operator on the shared tables, whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchloom import domain, schemas, workspace
from matchloom.functions import numeric, text, time
from matchloom.operators import (
    boosting,
    explain,
    features,
    flatten,
    keywords,
    ranking,
    replay,
    roles,
    selection,
    skew,
    timeline,
    win_model,
)
from matchloom.plans import image, influence
from matchloom.plans.image import cents, epoch_millis, match_id, table, zoneless
from matchloom.sinks import tables as sinks
from matchloom.sinks import versions
from matchloom.sources import documents, tables
from matchloom.streaming import documents as streamed
from matchloom.streaming import exact, gold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


# --- documents and timelines ---------------------------------------------------------


def flat_challenges(players: DataFrame) -> DataFrame:
    return players.select(
        *[c for c in players.columns if c != "challenges"], "challenges.*"
    )


@query
def flatten_players(spark, sf_dir):
    matches = image.match_documents(spark, sf_dir)
    start = time.utc_date(F.col("info.gameStartTimestamp"))
    return flat_challenges(flatten.flatten_players(matches, start))


@query
def flatten_all_fields(spark, sf_dir):
    """Documents with an undeclared participant field, written and read as the players job reads them."""
    root = workspace.scratch(spark, "written")
    matches = image.match_documents(spark, sf_dir)
    noted = F.transform(
        "info.participants", lambda p: p.withField("note", F.concat(F.lit("n"), p["participantId"].cast("string")))
    )
    sent = matches.withColumn("info", F.col("info").withField("participants", noted))
    sent.select(F.to_json(F.struct(*sent.columns)).alias("value")).write.text(f"{root}/in", compression=sinks.CODEC)
    participant = documents.all_participant_fields(spark, f"{root}/in")
    found = documents.read_matches(spark, f"{root}/in", participant, multi_line=False)
    start = time.utc_date(F.col("info.gameStartTimestamp"))
    return flat_challenges(flatten.flatten_players(found, start))


@query
def gold_timeline(spark, sf_dir):
    rows = timeline.gold_timeline(image.timelines(spark, sf_dir), missing="zero")
    return rows.withColumn("event_time", zoneless(F.col("event_time")))


@query
def gold_timeline_strict(spark, sf_dir):
    rows = timeline.gold_timeline(image.timelines(spark, sf_dir), missing="null")
    return rows.withColumn("event_time", zoneless(F.col("event_time")))


@query
def gold_table(spark, sf_dir):
    """The gold table after its job ran twice."""
    path = workspace.scratch(spark, "gold")
    rows = timeline.gold_timeline(image.timelines(spark, sf_dir)).withColumn(
        "ds", F.to_date("event_time")
    )
    for _ in range(2):
        sinks.replace_partitions(rows, path)
    back = spark.read.schema(rows.schema).parquet(path)
    return back.withColumn("event_time", zoneless(F.col("event_time")))


def write_arrays(values: DataFrame, path: str) -> None:
    """Documents (``part``, ``value``) as files of several lines: an array of the documents of each part."""
    listed = values.groupBy("part").agg(F.collect_list("value").alias("values"))  # parts are small
    text = F.concat(F.lit("[\n  "), F.array_join("values", ",\n  "), F.lit("\n]"))
    listed.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path, compression=sinks.CODEC)


#: Keys of matches whose documents are one file of several lines: some MB. A file costs time whatever its size.
FILE_KEYS = 4096


def part_of(match: Column, keys: int = FILE_KEYS) -> Column:
    """So many keys of matches in a row."""
    return F.floor(F.substring_index(match, "_", -1).cast("long") / keys)


@query
def flatten_multi_line(spark, sf_dir):
    """Match documents from files of several lines, as they come from the collector."""
    root = workspace.scratch(spark, "multi-line")
    matches = image.match_documents(spark, sf_dir)
    write_arrays(matches.select(part_of(F.col("metadata.matchId")).alias("part"), F.to_json(F.struct(*matches.columns)).alias("value")), f"{root}/in")
    found = documents.read_matches(spark, f"{root}/in")
    return flat_challenges(flatten.flatten_players(found, time.utc_date(F.col("info.gameStartTimestamp"))))


def written_timelines(spark, sf_dir):
    """Timelines written as files of several lines and read as the timeline job reads them."""
    root = workspace.scratch(spark, "timeline-files")
    made = image.timelines(spark, sf_dir)
    write_arrays(made.select(part_of(F.col("metadata.matchId")).alias("part"), F.to_json(F.struct(*made.columns)).alias("value")), f"{root}/in")
    return documents.read_timelines(spark, f"{root}/in")


@query
def gold_timeline_files(spark, sf_dir):
    rows = timeline.gold_timeline(written_timelines(spark, sf_dir), missing="null")
    return rows.withColumn("event_time", zoneless(F.col("event_time")))


@query
def replay_files(spark, sf_dir):
    """Frame messages of timeline files."""
    events = timeline.gold_events(written_timelines(spark, sf_dir))
    sent = timeline.messages(events, schemas.GOLD_MESSAGE.names)
    value = text.to_record(F.col("value").cast("string"), schemas.GOLD_MESSAGE)
    return sent.select(F.col("key").cast("string").alias("key"), value.alias("m")).select("key", "m.*")


@query
def frame_time(spark, sf_dir):
    """Times relative to the middle of January 2024, so that some are negative."""
    ms = epoch_millis(F.col("ts")) - 1705276800000
    return table(spark, sf_dir, "events").select(
        "event_id",
        zoneless(time.from_millis(ms)).alias("event_time"),
        time.minute_truncated(ms).alias("minute_truncated"),
        time.minute_floored(ms).alias("minute_floored"),
        time.utc_date(ms).alias("utc_date"),
    )


@query
def replay_delay(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_id", epoch_millis(F.col("ts")).alias("ms")
    )
    return replay.replay_delay(rows, "user_id", "event_id", "ms", bucket=1024).drop("delay_s")


@query
def replay_schedule(spark, sf_dir):
    rows = replay.replay_schedule(image.timelines(spark, sf_dir))
    return rows.select("matchId", "frame_no", "frameTimestamp", "gap_ms", "delay_s", "send_at_s")


@query
def replay_messages(spark, sf_dir):
    """Frame messages, written as bytes and read back."""
    events = timeline.gold_events(image.timelines(spark, sf_dir))
    sent = timeline.messages(events, schemas.GOLD_MESSAGE.names)
    value = text.to_record(F.col("value").cast("string"), schemas.GOLD_MESSAGE)
    return sent.select(F.col("key").cast("string").alias("key"), value.alias("m")).select(
        "key", "m.*"
    )


@query
def parse_json_events(spark, sf_dir):
    schema = schemas.record(k=schemas.LONG)
    return table(spark, sf_dir, "events").select(
        "event_id", text.to_record(F.col("props"), schema)["k"].alias("k")
    )


@query
def variant_get(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", text.variant_field(F.col("props"), "$.k", "bigint").alias("k")
    )


# --- selection -----------------------------------------------------------------------


@query
def entity_list(spark, sf_dir):
    """The first ten players of league lists, a list per customer."""
    entry = F.struct(F.format_string("P_%09d", "c_custkey").alias("puuid"))
    lists = table(spark, sf_dir, "customer").select(F.array(entry).alias("entries"))
    return selection.first_players(documents.league_players(lists), "puuid", 10)


@query
def entity_list_in_order(spark, sf_dir):
    """The first ten players by their place: each hundred customers are a list by balance, best first."""
    entry = F.struct((-cents(F.col("c_acctbal"))).alias("rank"), F.format_string("P_%09d", "c_custkey").alias("puuid"))
    customers = table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 100).alias("list"), entry.alias("entry"))
    lists = customers.groupBy("list").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    ranked = documents.ranked_players(lists, "list")
    return selection.first_players(ranked, ["place", "list"], 10)


@query
def recent_match_ids_landed(spark, sf_dir):
    """The latest five matches per player out of landed lines of JSON."""
    path = f"{workspace.scratch(spark, 'player-matches')}/in"
    rows = table(spark, sf_dir, "orders").select(
        F.format_string("P_%09d", "o_custkey").alias("puuid"),
        F.call_function("div", epoch_millis(F.col("o_orderdate")), F.lit(1000)).alias("startTs"),
        match_id(F.col("o_orderkey")).alias("matchId"),
    )
    rows.write.json(path)
    return selection.recent_match_ids(documents.read_player_matches(spark, path), 5)


@query
def recent_match_ids(spark, sf_dir):
    """Suppliers as players: an order is shared by all suppliers of its lines."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_shipdate")
    return selection.recent_match_ids(
        rows, 5, player="l_suppkey", match="l_orderkey", start="l_shipdate"
    )


@query
def recent_match_ids_of_day(spark, sf_dir):
    """The same with one day's bounds in epoch seconds, all matches of a player."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", F.call_function("div", epoch_millis(F.col("l_shipdate")), F.lit(1000)).alias("start")
    )
    return selection.recent_match_ids(
        rows, None, "1997-05-28", player="l_suppkey", match="l_orderkey", start="start"
    )


@query
def scan_one_day(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return tables.one_day(orders, "o_orderdate", "1997-05-28")


@query
def last_90_days(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    as_of = orders.select(F.max("o_orderdate").cast("date")).scalar()
    return tables.last_days(orders.select("o_orderkey", "o_orderdate"), "o_orderdate", as_of)


@query
def load_counts(spark, sf_dir):
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    landed = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return selection.load_counts(asked, landed, "id")


@query
def drop_incomplete(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return selection.drop_incomplete(joined).drop("o_custkey")


@query
def feature_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    excluded = ("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus")
    return lines.select(*selection.columns_except(lines, excluded))


@query
def distinct_positions(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select(F.upper("o_orderpriority").alias("position"))
        .distinct()
    )


@query
def min_sample_groups(spark, sf_dir):
    return skew.group_sizes(table(spark, sf_dir, "events"), ["user_id"], 65)


@query
def min_sample_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id")
    return skew.large_groups(rows, ["user_id"], 65)


@query
def position_label(spark, sf_dir):
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        key,
        F.lower(
            F.get(F.array(*[F.lit(p) for p in domain.POSITIONS]), F.substring("o_orderpriority", 1, 1).cast("int") - 1)
        ).alias("position"),
        *[
            (key % (i + 2)).cast("int").alias(label)
            for i, label in enumerate(domain.POSITION_LABELS.values())
        ],
    )
    return orders.select(
        "o_orderkey", "position", selection.position_label(F.col("position")).alias("label")
    )


@query
def train_test_split(spark, sf_dir):
    """Fold by a multiplicative hash that SQL has too."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    key = F.col("o_orderkey") + 29
    bucket = F.pmod(F.pmod(key, F.lit(2147483647)) * 48271, F.lit(2147483647)) % 100
    train, test = selection.stable_split(orders, ["o_orderkey"], bucket=bucket)
    return train.withColumn("fold", F.lit("train")).unionByName(
        test.withColumn("fold", F.lit("test"))
    )


@query
def exact_train_test_split(spark, sf_dir):
    """A fifth of the orders, rounded up, by the least of the same hash."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    key = F.col("o_orderkey") + 29
    number = F.pmod(F.pmod(key, F.lit(2147483647)) * 48271, F.lit(2147483647))
    train, test = selection.exact_split(orders, ["o_orderkey"], number=number, bits=31)
    return train.withColumn("fold", F.lit("train")).unionByName(test.withColumn("fold", F.lit("test")))


@query
def recent_of_hot_player(spark, sf_dir):
    """The latest 5,000 matches of every player, where one player has a third of all matches."""
    orders = table(spark, sf_dir, "orders")
    player = F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey"))
    rows = orders.select(player.alias("player"), "o_orderkey", "o_orderdate")
    return selection.top_n(
        rows, ["player"], [F.desc("o_orderdate"), F.asc("o_orderkey")], 5000, F.xxhash64("o_orderkey")
    ).select("player", "o_orderkey")


# --- landing and loading -------------------------------------------------------------


@query
def land_by_event_date(spark, sf_dir):
    """Whole documents through files: sent with an undeclared field, landed by day, read back."""
    root = workspace.scratch(spark, "land")
    matches = image.match_documents(spark, sf_dir)
    noted = matches.withColumn("note", F.concat(F.lit("n"), F.col("metadata.matchId")))
    noted.select(F.to_json(F.struct(*noted.columns)).alias("value")).write.text(f"{root}/in", compression=sinks.CODEC)
    sinks.land_matches(documents.read_whole(spark, f"{root}/in", multi_line=False), f"{root}/raw")
    schema = StructType([*schemas.MATCH.fields, StructField("note", StringType())])
    landed = documents.read_landed(spark, f"{root}/raw", schema)
    return landed.select(
        F.col("metadata.matchId").alias("matchId"),
        "ds",
        F.coalesce(F.size("info.participants"), F.lit(0)).alias("participants"),
        "note",
    )


@query
def land_timelines(spark, sf_dir):
    """Whole timelines landed by the date of the run, twice; the last run's count."""
    root = workspace.scratch(spark, "land-timelines")
    made = image.timelines(spark, sf_dir)
    made.select(F.to_json(F.struct(*made.columns)).alias("value")).write.text(f"{root}/in", compression=sinks.CODEC)
    for _ in range(2):
        sinks.land_timelines(documents.read_whole(spark, f"{root}/in", multi_line=False), f"{root}/raw", "2024-05-01")
    landed = documents.read_landed(spark, f"{root}/raw", schemas.TIMELINE)
    return landed.select(F.col("metadata.matchId").alias("matchId"), "ds", F.size("info.frames").cast("long").alias("frames")).groupBy(
        "matchId", "ds"
    ).agg(F.sum("frames").alias("frames"))


@query
def path_ds_load(spark, sf_dir):
    path = workspace.scratch(spark, "staged")
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("ds"))
    sinks.replace_partitions(events, path)
    return documents.read_staged(spark, path, schemas.record(event_id=schemas.LONG))


@query
def replace_partition(spark, sf_dir):
    """The table after its last day was replaced by rows of twice the value."""
    path = workspace.scratch(spark, "replaced")
    rows = table(spark, sf_dir, "events").select(
        "event_id", cents(F.col("value")).alias("amount"), F.to_date("ts").alias("ds")
    )
    sinks.replace_partitions(rows, path)
    last = rows.select(F.max("ds")).scalar()
    changed = rows.where(F.col("ds") == last).withColumn("amount", F.col("amount") * 2)
    sinks.replace_partitions(changed, path)
    return spark.read.schema(rows.schema).parquet(path)


@query
def replace_at_one_stroke(spark, sf_dir):
    """What readers see of a table whose last day is replaced: one that read while the new rows were written,
    and one after it."""
    path = workspace.scratch(spark, "versions")
    rows = table(spark, sf_dir, "events").select(
        "event_id", cents(F.col("value")).alias("amount"), F.to_date("ts").alias("ds")
    )
    versions.replace_days(rows, path)
    last = rows.select(F.max("ds")).scalar()
    changed = rows.where(F.col("ds") == last).withColumn("amount", F.col("amount") * 2)
    folders = versions.write_folders(changed, path)
    between = versions.read_days(spark, path).withColumn("reader", F.lit("between"))
    versions.point(spark, path, folders, changed.schema)
    return between.unionByName(versions.read_days(spark, path).withColumn("reader", F.lit("after")))


@query
def changing_schemas(spark, sf_dir):
    """Days whose events have other fields and types: the kind from day to day, amounts as whole numbers, text and
    fractions, ids that widen."""
    path = workspace.scratch(spark, "schemas")
    events = workspace.stored(
        table(spark, sf_dir, "events").select(
            "event_id", "event_type", cents(F.col("value")).alias("cents"), F.to_date("ts").alias("ds")
        ),
        "events",
    )
    which = F.dayofmonth("ds") % 3
    shapes = [
        [F.col("event_id").cast("int").alias("id"), F.col("cents").alias("amount")],
        [F.col("event_id").alias("id"), F.concat(F.lit("c"), F.col("cents").cast("string")).alias("amount"), F.col("event_type").alias("kind")],
        [F.col("event_id").cast("int").alias("id"), (F.col("cents") / 2).alias("amount")],
    ]
    for i, shape in enumerate(shapes):
        versions.replace_days(events.where(which == i).select(*shape, "ds"), path)
    made = versions.read_days(spark, path)
    return made.select(
        "id", "kind", "ds",
        F.try_variant_get("amount", "$", "string").alias("amount_text"),
        F.try_variant_get("amount", "$", "double").alias("amount_number"),
    )


@query
def path_ds_load_orders(spark, sf_dir):
    """The same load over all order dates: a folder for each of some 2,400 days."""
    path = workspace.scratch(spark, "staged-orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ds"))
    sinks.replace_partitions(orders, path)
    return documents.read_staged(spark, path, schemas.record(o_orderkey=schemas.LONG))


@query
def replace_partition_orders(spark, sf_dir):
    """The same replacement over all order dates."""
    path = workspace.scratch(spark, "replaced-orders")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", cents(F.col("o_totalprice")).alias("amount"), F.to_date("o_orderdate").alias("ds")
    )
    sinks.replace_partitions(rows, path)
    last = rows.select(F.max("ds")).scalar()
    changed = rows.where(F.col("ds") == last).withColumn("amount", F.col("amount") * 2)
    sinks.replace_partitions(changed, path)
    return spark.read.schema(rows.schema).parquet(path)


# --- features ------------------------------------------------------------------------


@query
def player_rate_features(spark, sf_dir):
    return features.player_features(image.players(spark, sf_dir))


@query
def player_rate_nested(spark, sf_dir):
    matches = image.match_documents(spark, sf_dir)
    return features.player_features_nested(matches, time.utc_date(F.col("info.gameStartTimestamp")))


@query
def line_share(spark, sf_dir):
    """Each line's share of its order and team, in basis points."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_linenumber", cents(F.col("l_extendedprice")).alias("price")
    )
    shared = skew.with_group_totals(
        rows, ["l_orderkey", "l_linestatus"], {"total": F.sum("price")}
    )
    return shared.withColumn(
        "share_bp", numeric.rounded_ratio(F.col("price"), F.col("total"), 10_000)
    )


@query
def match_diff_features(spark, sf_dir):
    return features.match_features(image.players(spark, sf_dir))


DIFFERENCES = ("KILLS", "DRAGON", "GOLD_RATE", "KILLPARTICIPATION", "VISION_PER_MIN")


@query
def team_diff_join(spark, sf_dir):
    made = features.player_features(image.players(spark, sf_dir))
    return features.team_difference(made, DIFFERENCES)


# --- roles and ranks -----------------------------------------------------------------


def contribution_columns() -> dict:
    return {name: F.col(name) for name in image.CONTRIBUTION_FEATURES}


@query
def role_of_feature(spark, sf_dir):
    """Role by keyword of every word in the documents."""
    words = F.array_distinct(F.split("text", "[^A-Za-z]+"))
    return (
        table(spark, sf_dir, "documents")
        .select(F.explode(words).alias("feature"))
        .where(F.col("feature") != "")
        .distinct()
        .withColumn("role", roles.role_of(F.col("feature")))
    )


@query
def role_by_rules(spark, sf_dir):
    """The same by a table of rules: every word of the benchmark is a keyword, in the order of their hashes."""
    listed = table(spark, sf_dir, "benchmark").select(F.explode(F.transform(F.split("text", "[^A-Za-z]+"), F.upper)).alias("keyword"))
    chosen = listed.where("length(keyword) >= 3").distinct()
    number = F.conv(F.substring(F.md5("keyword"), 1, 8), 16, 10).cast("long")
    role = F.get(F.array(*[F.lit(r) for r in domain.ROLES]), (number % 5).cast("int"))
    rules = chosen.select("keyword", number.alias("priority"), role.alias("role"))
    words = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(F.split("text", "[^A-Za-z]+"))).alias("feature"))
    return keywords.with_first_rule(words.where(F.col("feature") != "").distinct(), F.col("feature"), rules, "role")


@query
def role_contribution(spark, sf_dir):
    rows = image.contributions(spark, sf_dir)
    return roles.role_basis_points(rows, contribution_columns())


@query
def role_contribution_pct(spark, sf_dir):
    rows = image.contributions(spark, sf_dir)
    return roles.role_contribution(rows, contribution_columns())


@query
def role_table(spark, sf_dir):
    """Contributions in a catalog table: made if missing, every day replaced twice, the last day by a part of it."""
    name = f"role_contribution_{uuid.uuid4().hex}"
    location = f"{workspace.scratch(spark, 'role-table')}/table"
    made = roles.role_contribution(image.contributions(spark, sf_dir), contribution_columns())
    rows = workspace.stored(made.withColumn("DS", F.to_date("DS")), "role-rows")
    for _ in range(2):
        sinks.ensure_role_table(spark, name, location)
        sinks.replace_table_day(rows, name)
    last = rows.select(F.max("DS")).scalar()
    sinks.replace_table_day(rows.where((F.col("DS") == last) & (F.col("ROLE") == "TOP")), name)
    back = spark.read.schema(schemas.ROLE_CONTRIBUTION).parquet(location)
    spark.sql(f"DROP TABLE {name}")  # its files stay, for they are not the table's own
    return back


@query
def role_daily_mean(spark, sf_dir):
    shares = roles.role_basis_points(image.contributions(spark, sf_dir), contribution_columns())
    return roles.role_daily_mean(shares, "CONTRIB_BP")


@query
def role_share_listed(spark, sf_dir):
    return roles.role_share_listed(image.contributions(spark, sf_dir), contribution_columns())


@query
def topk_features(spark, sf_dir):
    rows = image.contributions(spark, sf_dir)
    return ranking.top_features(ranking.importance(rows, contribution_columns()))


@query
def topk_features_per_role(spark, sf_dir):
    """Top three per day."""
    rows = image.contributions(spark, sf_dir)
    made = ranking.importance(rows, contribution_columns(), ["DS"])
    return ranking.top_features_by(made, ["DS"])


# --- explanation ---------------------------------------------------------------------

LINEAR = {"balance": 0.5, "nation": -2.0}


def customer_values(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        cents(F.col("c_acctbal")).alias("balance"),
        F.col("c_nationkey").cast("long").alias("nation"),
    )


@query
def shap_linear(spark, sf_dir):
    rows = customer_values(spark, sf_dir)
    phi = explain.linear_shap(rows, LINEAR)
    return rows.select("c_custkey", *[F.round(c, 4).alias(f"phi_{n}") for n, c in phi.items()])


@query
def shap_long(spark, sf_dir):
    rows = customer_values(spark, sf_dir)
    phi = {n: F.round(c, 4) for n, c in explain.linear_shap(rows, LINEAR).items()}
    return explain.shap_long(rows, ["c_custkey"], {n: F.col(n) for n in LINEAR}, phi)


@query
def shap_dot_plot(spark, sf_dir):
    """The plot's table, held against the exact ranks: of each feature its rows, whether it has at most 20 bins, and
    whether every bin ends and every colour is within a hundredth of where the exact ranks put it."""
    customers = customer_values(spark, sf_dir)
    columns, phi = {n: F.col(n) for n in LINEAR}, {n: F.col(f"phi_{n}") for n in LINEAR}
    valued = customers.select("*", *[c.alias(f"phi_{n}") for n, c in explain.linear_shap(customers, LINEAR).items()])
    rows = workspace.stored(valued, "customers")
    dots = workspace.stored(explain.dot_plot(rows, columns, phi, bins=20), "dots")
    exact, n = [], rows.count()
    for name in LINEAR:
        mine = dots.where(F.col("feature") == name)
        ends = sorted((r["bin"], r["high"], r["rows"]) for r in mine.collect())  # at most 20 rows
        ranked = rows.agg(*[F.count_if(F.col(f"phi_{name}") <= F.lit(high)).alias(f"r{b}") for b, high, _ in ends])
        # A bin ends at its quantile, and with it all rows of that very contribution.
        up_to, close = 0, F.lit(True)
        for b, _, size in ends:
            up_to += size
            close = close & (F.col(f"r{b}") == up_to) & (F.col(f"r{b}") >= n * ((b + 1) / 20 - 0.01))
        exact.append(
            ranked.select(F.lit(name).alias("feature"), F.lit(up_to).cast("long").alias("rows"), F.lit(len(ends) <= 20).alias("bounded"), close.alias("ranks_within"))
        )
    return reduce(DataFrame.unionAll, exact)


def fixed_trees() -> list[explain.Leaf]:
    """A stump on quantity, and a tree on discount then quantity."""
    q25, q10 = explain.Split(0, threshold=25.0), explain.Split(0, threshold=10.0)
    d5 = explain.Split(1, threshold=0.05)
    return [
        explain.Leaf(2.0, ((q25, True, 0.5),)),
        explain.Leaf(-1.0, ((q25, False, 0.5),)),
        explain.Leaf(4.0, ((d5, True, 0.5), (q10, True, 0.25))),
        explain.Leaf(1.0, ((d5, True, 0.5), (q10, False, 0.75))),
        explain.Leaf(-2.0, ((d5, False, 0.5),)),
    ]


@query
def shap_fixed_trees(spark, sf_dir):
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    names = ["l_quantity", "l_discount"]
    valued = explain.shap_values(table(spark, sf_dir, "lineitem"), names, fixed_trees(), keep)
    phi = explain.phi_columns(names)
    return valued.select(
        *keep, phi["l_quantity"].alias("phi_q"), phi["l_discount"].alias("phi_d"), "base"
    )


# --- text ----------------------------------------------------------------------------


@query
def normalize_host(spark, sf_dir):
    """Page addresses, with the account ending put behind the host of each."""
    host = F.concat(
        F.lit("  "),
        F.regexp_replace("url", "^http", "HTTP"),
        F.lit(".aws.snowflakecomputing.com "),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", text.normalize_host(host).alias("host")
    )


@query
def mask_secrets(spark, sf_dir):
    pairs = F.create_map(
        F.lit("user"), F.col("s_name"),
        F.lit("Password"), F.concat(F.lit("pw-"), F.col("s_suppkey").cast("string")),
        F.lit("bypass_code"), F.col("s_nationkey").cast("string"),
        F.lit("region"), F.lit(None).cast("string"),
    )
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.explode(text.mask_secrets(pairs)).alias("name", "value")
    )


# --- streams -------------------------------------------------------------------------


def send(events: DataFrame, path: str) -> None:
    """Messages to files. Of a broken one only the first ten characters arrive, or, of every
    second one, all but the number of its event time."""
    value = text.to_text(F.struct(*schemas.GOLD_MESSAGE.names))
    half = F.regexp_replace(value, '"eventTs":[0-9]+', '"eventTs":"x"')
    cut = F.when(F.col("_half"), half).otherwise(F.substring(value, 1, 10))
    sinks.publish_files(
        events.select(F.when(F.col("_broken"), cut).otherwise(value).alias("value")), path
    )


def run_gold_stream(spark, sf_dir) -> str:
    """Send all events, run the stream, run it again; its table."""
    root = workspace.scratch(spark, "stream")
    send(image.frame_events(spark, sf_dir), f"{root}/in")
    for _ in range(2):
        gold.drain(
            gold.stream_gold(
                gold.file_messages(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint",
                day="event", trigger=gold.DRAIN,
            )
        )
    return f"{root}/out"


@query
def stream_gold(spark, sf_dir):
    rows = gold.stored_gold(spark, run_gold_stream(spark, sf_dir)).drop("arrival")
    return rows.withColumn("event_time", zoneless(F.col("event_time")))


@query
def stream_rejected(spark, sf_dir):
    return gold.stored_rejected(spark, run_gold_stream(spark, sf_dir))


@query
def stream_dedup(spark, sf_dir):
    """Frames in match time: every second minute twice in a first drop, all in a second."""
    root = workspace.scratch(spark, "dedup")
    events = image.match_time_events(spark, sf_dir)
    odd = events.where(F.col("frameMinute") % 2 == 1)
    for drop in (odd.unionAll(odd), events):
        send(drop, f"{root}/in")
        once = gold.without_redelivery(gold.gold_rows(gold.file_messages(spark, f"{root}/in")))
        gold.drain(gold.dedup_sink(once, f"{root}/out", f"{root}/checkpoint", (), gold.DRAIN))
    back = spark.read.parquet(f"{root}/out")
    return back.select("matchId", "frameTimestamp", "goldDiff")


def exact_dedup_path(spark, sf_dir) -> str:
    """Odd minutes twice; a day later all of them again, and even ones that had arrived before; then nothing new."""
    root = workspace.scratch(spark, "exact")
    events = image.match_time_events(spark, sf_dir)
    odd = events.where(F.col("frameMinute") % 2 == 1)
    arrivals = {0: "2024-05-01 12:00:00", 1: "2024-05-02 12:00:00", 2: "2024-05-03 12:00:00"}
    for number, drop in enumerate((odd.unionAll(odd), events, events)):
        send(drop, f"{root}/in")
        even = F.col("frameMinute") % 2 == 0
        came = F.when(even, "2024-05-01 11:00:00").otherwise(arrivals[number]).cast("timestamp")
        rows = gold.gold_rows(gold.file_messages(spark, f"{root}/in")).withColumn("arrival", came)
        gold.drain(exact.exact_sink(rows, f"{root}/out", f"{root}/checkpoint", fold_every=2, trigger=gold.DRAIN))
    return f"{root}/out"


@query
def stream_exact_dedup(spark, sf_dir):
    path = exact_dedup_path(spark, sf_dir)
    schema = gold.gold_rows(gold.file_messages(spark, f"{path}/../in")).schema
    return exact.kept(spark, path, schema).select("matchId", "frameTimestamp", "goldDiff", zoneless(F.col("arrival")).alias("arrival"))


@query
def stream_exact_counts(spark, sf_dir):
    found = exact.counts(spark, exact_dedup_path(spark, sf_dir))
    return found.select("batch", "came", "kept", "copies", "late")


@query
def stream_ingest_new(spark, sf_dir):
    """Match documents in two drops; the third run finds nothing new."""
    root = workspace.scratch(spark, "ingest")
    matches = workspace.stored(image.match_documents(spark, sf_dir), "documents")
    start = time.utc_date(F.col("info.gameStartTimestamp"))
    cut = F.lit("1998-01-01").cast("date")
    for drop in (matches.where(start < cut), matches.where(start >= cut), None):
        if drop is not None:
            drop.write.mode("append").json(f"{root}/in", compression=sinks.CODEC)
        found = flatten.flatten_players(gold.new_documents(spark, f"{root}/in"), start)
        gold.drain(gold.parquet_sink(found, f"{root}/out", f"{root}/checkpoint", (), gold.DRAIN))
    return spark.read.parquet(f"{root}/out").select("matchId", "participantId", "goldEarned", "ds")


@query
def stream_ingest_whole(spark, sf_dir):
    """Match documents as files of several lines, in two drops, with a field nobody declared and, in every third
    match, kills of another type; the third run finds nothing new."""
    root = workspace.scratch(spark, "ingest-whole")
    matches = image.match_documents(spark, sf_dir)
    noted = F.transform(
        "info.participants", lambda p: p.withField("note", F.concat(F.lit("n"), p["participantId"].cast("string")))
    )
    sent = matches.withColumn("info", F.col("info").withField("participants", noted))
    value = F.to_json(F.struct(*sent.columns))
    odd = F.substring("metadata.matchId", 3, 20).cast("long") % 3 == 0
    strange = F.when(odd, F.regexp_replace(value, '"kills":([0-9]+)', '"kills":"k$1"')).otherwise(value)
    match = F.col("metadata.matchId")
    lines = workspace.stored(
        sent.select(part_of(match).alias("part"), (part_of(match, 256) % 2).alias("parity"), strange.alias("value")), "documents"
    )
    for parity in (0, 1, None):
        if parity is not None:
            drop = lines.where(F.col("parity") == parity)
            write_arrays(drop, f"{root}/drop={parity}")
        found = streamed.whole_players(streamed.whole_documents(spark, f"{root}/drop=*"))
        gold.drain(gold.parquet_sink(found, f"{root}/out", f"{root}/checkpoint", (), gold.DRAIN))
    players = streamed.typed(spark.read.parquet(f"{root}/out"), {"participantId": "long", "kills": "long", "note": "string"})
    return players.select(
        "matchId", "gameDuration", "ds", "participantId", "kills", "note",
        F.try_variant_get("player", "$.kills", "string").alias("kills_as_sent"),
    )


@query
def stream_gold_window(spark, sf_dir):
    """Frames in match time, in two drops: the odd minutes of all matches, then the even ones."""
    root = workspace.scratch(spark, "window")
    events = image.match_time_events(spark, sf_dir)
    for parity in (1, 0):
        send(events.where(F.col("frameMinute") % 2 == parity), f"{root}/in")
        rows = gold.gold_rows(gold.file_messages(spark, f"{root}/in"))
        windows = gold.gold_by_window(rows, width="1 hour")
        gold.drain(gold.changes_sink(windows, f"{root}/out", f"{root}/checkpoint", gold.DRAIN))
    latest = gold.latest_changes(spark, f"{root}/out")
    return latest.select(
        "matchId",
        zoneless(F.col("window_start")).alias("window_start"),
        zoneless(F.col("event_time")).alias("event_time"),
        "goldDiff",
    )


# --- models --------------------------------------------------------------------------

def model_matches(spark, sf_dir):
    """Differences, with 0 where neither side has the position."""
    matches = features.match_features(image.players(spark, sf_dir))
    filled = matches.na.fill(0.0, selection.columns_like(matches))
    return workspace.stored(filled, "matches")


@query
def ml_win_model(spark, sf_dir):
    matches = model_matches(spark, sf_dir)
    model = win_model.train_win_model(matches)
    return model.transform(matches).select("DS", "MATCHID", "BLUE_TEAM_WIN", "prediction")


SIGNS = ("TOP_KILLS_DIF", "JUNGLE_DRAGON_DIF", "MID_KILLS_DIF", "BOTTOM_GOLD_RATE_DIF")


@query
def ml_one_split(spark, sf_dir):
    """One tree of one split on who leads in four differences: SQL finds the same split and leaves."""
    signs = model_matches(spark, sf_dir).select(
        "DS", "MATCHID", "BLUE_TEAM_WIN", *[(F.col(c) > 0).cast("int").alias(c) for c in SIGNS]
    )
    signs = workspace.stored(signs, "signs")
    model = win_model.train_win_model(signs, maxIter=1, maxDepth=1, minInstancesPerNode=1)
    path = f"{workspace.scratch(spark, 'saved-model')}/model"
    win_model.save(model, path)
    return win_model.load(path).transform(signs).select("DS", "MATCHID", "prediction")


#: Features of small whole numbers, whose every value is a bin.
WHOLE = ("SOLOKILLS", "PLATES", "DRAGON", "BARONKILLS", "RIFTHERALD")


def node_rows(model: boosting.Model, spark: SparkSession) -> DataFrame:
    return model.nodes(spark).withColumns(
        {"categories": F.array_join("categories", ","), "gain": F.round("gain", 6), "value": F.round("value", 9)}
    )


@query
def ml_leafwise_trees(spark, sf_dir):
    """Splits and leaves of the first trees of the leaf-wise win model."""
    names = [f"{p}_{n}_DIF" for p in features.PREFIX.values() for n in WHOLE]
    matches = features.match_features(image.players(spark, sf_dir), names)
    rows = workspace.stored(matches.select("BLUE_TEAM_WIN", *names).na.fill(0.0, names), "differences")
    return node_rows(boosting.train(rows, names, "BLUE_TEAM_WIN", trees=2, leaves=6), spark)


@query
def ml_leafwise_scores(spark, sf_dir):
    """Margins of the same trees, and whether base and contributions add up to them."""
    names = [f"{p}_{n}_DIF" for p in features.PREFIX.values() for n in WHOLE]
    matches = features.match_features(image.players(spark, sf_dir), names).na.fill(0.0, names)
    rows = workspace.stored(matches.where("BLUE_TEAM_WIN is not null"), "differences")
    model = win_model.train(rows, names, "BLUE_TEAM_WIN", win_model.SEED_TRAIN, leafwise=True, trees=2, leaves=6)
    valued, _ = explain.explain(model, model.transform(rows), ["MATCHID", "margin", "prediction"])
    total = F.col("base") + F.aggregate("phi", F.lit(0.0), lambda t, x: t + x)
    return valued.select(
        "MATCHID", F.round("margin", 9).alias("margin"), "prediction", (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up")
    )


def whole_players(spark, sf_dir):
    players = features.player_features(image.players(spark, sf_dir))
    return workspace.stored(players.select("WIN", "TEAMPOSITION", *WHOLE), "whole-players")


@query
def ml_leafwise_positions(spark, sf_dir):
    """One leaf-wise model over all positions, with the position as a category."""
    names = [*WHOLE, "TEAMPOSITION"]
    model = boosting.train(whole_players(spark, sf_dir), names, "WIN", ["TEAMPOSITION"], trees=2, leaves=6)
    return node_rows(model, spark)


@query
def ml_leafwise_per_position(spark, sf_dir):
    """A leaf-wise model per position."""
    players = whole_players(spark, sf_dir)
    made = [
        node_rows(boosting.train(players.where(F.col("TEAMPOSITION") == p), WHOLE, "WIN", trees=1, leaves=4), spark).select(
            F.lit(p).alias("TEAMPOSITION"), "*"
        )
        for p in domain.POSITIONS
    ]
    return reduce(DataFrame.unionByName, made)


@query
def ml_category_splits(spark, sf_dir):
    """Returned lines by part and quantity: every part is a category, and a split finds the best set of them."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("returned")
    )
    model = boosting.train(rows, ["l_partkey", "l_quantity"], "returned", ["l_partkey"], trees=2, leaves=4)
    return node_rows(model, spark)


@query
def ml_shap_checks(spark, sf_dir):
    """Of each match under the default model: its roles, whether their shares add up to 100, and
    whether base and contributions add up to the margin."""
    matches = model_matches(spark, sf_dir)
    model = win_model.train_win_model(matches)
    shares = influence.contributions(model, matches).groupBy("DS", "MATCHID").agg(
        F.count("*").alias("roles"), (F.abs(F.sum("CONTRIB_PCT") - 100) <= 0.05).alias("shares_add_up")
    )
    valued, _ = explain.explain(model, selection.upper_columns(matches), ["DS", "MATCHID"])
    summed = valued.select(
        "DS", "MATCHID", (F.col("base") + F.aggregate("phi", F.lit(0.0), lambda t, x: t + x)).alias("sum")
    )
    margins = model.transform(matches).select("DS", "MATCHID", F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("margin"))
    adds_up = F.abs(F.col("sum") - F.col("margin")) < 1e-6
    return shares.join(summed, ["DS", "MATCHID"]).join(margins, ["DS", "MATCHID"]).select(
        "DS", "MATCHID", "roles", "shares_add_up", adds_up.alias("margin_adds_up")
    )


@query
def ml_shap(spark, sf_dir):
    matches = model_matches(spark, sf_dir)
    model = win_model.train_win_model(matches)
    return influence.contributions(model, matches)


@query
def ml_role_influence(spark, sf_dir):
    return influence.role_influence(model_matches(spark, sf_dir))


@query
def ml_top_features_all(spark, sf_dir):
    players = features.player_features(image.players(spark, sf_dir))
    return influence.top_features_all(workspace.stored(players, "players"))


@query
def ml_top_features_role(spark, sf_dir):
    players = features.with_position_labels(
        features.player_features(image.players(spark, sf_dir))
    )
    return influence.top_features_per_position(workspace.stored(players, "players"))
