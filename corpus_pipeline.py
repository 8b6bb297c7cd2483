"""Five stages from raw documents to balanced shards, each one a job with a table behind it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm import decontaminate, neighbour_vote, raking, setsketch, shards
from matchloom.llm.common import bounded, free_name, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = neighbour_vote.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = neighbour_vote.score(docs, model, into=score)
    return scored.where(F.col(score) >= neighbour_vote.THRESHOLD).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; of rows that repeat an id, the one whose text, and
    then whose whole row as JSON, comes first, by the MD5 of the text.

    Documents without an id or without words are in no group and stay.
    """
    found = workspace.stored(setsketch.near_duplicates(docs), "near-duplicates").where("doc_id is not null")
    gone = found.where("not kept").select("doc_id").distinct()
    left = docs.join(bounded(gone), "doc_id", "left_anti").select(*docs.columns)
    twice = found.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if twice.isEmpty():
        return left
    twice = bounded(workspace.stored(twice, "repeated-ids"))
    once = left.join(twice, "doc_id", "left_anti").select(*docs.columns)
    row = F.struct(*[F.col(c) for c in docs.columns])
    first = F.min_by(row, F.struct(F.md5("text"), F.to_json(row)))
    chosen = left.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(first.alias("row"))
    return once.unionByName(chosen.select("row.*"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns, nameless=True)
    return found.where(~F.col(found.columns[-1])).select(*found.columns[: len(docs.columns)])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target shares of tokens."""
    found = raking.mixed(docs)
    return found.where(F.col(found.columns[-1])).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document that is left."""
    return shards.assign(docs, shards=40)


STAGES = [
    ("quality classifier", good),
    ("near-dedup", distinct),
    ("decontamination", uncontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The classifier can't be expressed in SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on the table that the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = workspace.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
