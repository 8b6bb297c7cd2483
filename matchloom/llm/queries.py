"""The registered queries of the corpus operators. Each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from matchloom.llm import (
    conversations,
    decontaminate,
    host_rules,
    line_dedup,
    neighbour_vote,
    raking,
    revisits,
    setsketch,
    shards,
    spelling,
    suffix_dedup,
    token_files,
    url_filter,
)
from matchloom.llm.common import table

#: The rules that the URL query is given (fixed values).
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]

#: The tokenizer file of the token query; executors have it at the same path.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"], nameless=True
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.without_boilerplate(docs).select(
        "doc_id", "n_lines", "n_removed", F.md5("text").alias("clean_md5")
    )


def op4_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def section_captures(pages: DataFrame) -> DataFrame:
    """A crawl log of site sections from the pages, in the order of their numbers.

    A page is a capture of its section. A URL with parameters or a fragment is a repeated visit that got
    a 304 answer; others got the whole page. The section's entity tag changes with the page's size.
    """
    section = F.regexp_replace(url_filter.canonical(F.col("url")), r"(?s)/[0-9]+.*$", "")
    tag = F.concat(F.lit('"'), F.md5(F.concat(section, F.lit(":"), (F.octet_length("html") % 3).cast("string"))), F.lit('"'))
    again = F.coalesce(F.col("url").rlike("[?#]"), F.lit(False))
    date = F.col("page_id").cast("string")
    return pages.select(
        F.col("page_id").alias("id"),
        section.alias("canon"),
        F.col("page_id").alias("time"),
        F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(~again, F.md5("html")).alias("digest"),
        F.when(again, F.create_map(F.lit("content-length"), F.lit("0"), F.lit("date"), date, F.lit("etag"), F.concat(F.lit("W/"), tag)))
        .otherwise(F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), date, F.lit("etag"), tag))
        .alias("headers"),
        F.when(~again, F.col("html")).alias("body"),
    )


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(section_captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select(
        F.col("id").alias("page_id"), "kind", "response_id", "verdict",
        F.array_join(F.array_sort(lines), "\n").alias("headers"),
        F.octet_length("body").cast("long").alias("body_bytes"),
    )


def op7_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = neighbour_vote.train(docs, table(spark, sf_dir, "labels"))
    return neighbour_vote.score(docs, model).select(
        "doc_id",
        neighbour_vote.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= neighbour_vote.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = raking.mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    return found.select(
        "doc_id", "n_tokens", "topic", F.round("probability", 6).alias("probability"), "sampled",
        F.round("marginal_error", 6).alias("marginal_error"),
    )


def toxic_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The block list: canonical URLs of pages whose document (the number in the path) is toxic."""
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"/([0-9]{1,18})", 1)
    numbered = pages.select("url", F.when(number != "", number.cast("long")).alias("doc_id"))
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    return numbered.join(toxic, "doc_id").select(url_filter.canonical(F.col("url")).alias("canon"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = toxic_urls(pages, table(spark, sf_dir, "labels"))
    return url_filter.judge(pages, listed, URL_RULES)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.misspelt(table(spark, sf_dir, "documents")))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damaged(rows), rows.select("conv_id"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.report(table(spark, sf_dir, "documents"), TOKENIZER, end_id=2).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


QUERIES = {
    "op1_host_rules": op1_host_rules,
    "op2_decontaminate": op2_decontaminate,
    "op3_line_dedup": op3_line_dedup,
    "op4_setsketch": op4_setsketch,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_revisits": op6_revisits,
    "op7_neighbour_vote": op7_neighbour_vote,
    "op8_shards": op8_shards,
    "op9_raking": op9_raking,
    "op10_url_filter": op10_url_filter,
    "op11_spelling": op11_spelling,
    "op12_conversations": op12_conversations,
    "op13_token_files": op13_token_files,
}
