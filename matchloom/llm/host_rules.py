"""Quality rules with verdicts per host.

Each document is measured once, in a task of its own row. Failures are summed by host (map side
first, so a host with a third of all documents is one row per task), each host's rate is shrunk to
a beta prior fitted to the hosts by moments, and the verdicts are joined back to the documents.

Verdicts of a host, by its shrunk failure rate: ``reject`` (``REJECT`` or more: all its documents
go), ``watch`` (``WATCH`` or more: its documents must pass every rule) and ``trust`` (below: the base
rules are enough). Small hosts are near the prior, so few documents cannot condemn a host.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm.common import small_batches, utf8

#: Base rules: fewest words, and the most percent of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Rules of watched hosts: symbols per 100 characters of words, repeated lines per 100 words.
MOST_SYMBOLS, MOST_DUP_LINES = 8, 10
#: Shrunk failure rates from which a host is watched or rejected.
WATCH, REJECT = 0.02, 0.5
#: Weight of the prior, in documents, where hosts are too alike or too few to fit one; and its bounds.
LEAST_PRIOR, MOST_PRIOR = 2.0, 1000.0

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(found: list[bytes]) -> int:
    """Words inside a three-word window that occurs twice or more."""
    windows = list(zip(found, found[1:], found[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    covered = bytearray(len(found))
    for at, window in enumerate(windows):
        first = seen.setdefault(window, at)
        if first != at:
            covered[first : first + 3] = covered[at : at + 3] = b"\1\1\1"
    return covered.count(1)


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    found = text.split()  # bytes split at space and \t to \r only
    solid = text.translate(None, SPACE)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(found),
        len(solid.decode("utf-8", "replace")),
        len(solid) - len(solid.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated(found),
    )


def measured(docs: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """Key, host and the five measures of each row."""
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(host).cast("string").alias("host"),
        F.col(text).cast("string").alias("text"),
    )

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(value) for value in utf8(batch.column("text"))]
            columns = [batch.column("key"), batch.column("host")]
            columns += [pa.array([x[i] for x in found], pa.int64()) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "host", *MEASURES])

    schema = rows.drop("text").schema
    for name in MEASURES:
        schema = schema.add(name, "long")
    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )


def any_failed() -> Column:
    return (
        F.col("base_failed")
        | (100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars"))
        | (100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_words"))
    )


def host_verdicts(failures: DataFrame) -> DataFrame:
    """From host, ``docs`` and ``failed`` counts: shrunk rate and verdict of each host.

    The prior is a beta with the hosts' mean rate, weighted by documents, and a weight from the
    variance between hosts beyond what their sizes explain. Its three sums are one row.
    """
    n, k = F.col("docs").cast("double"), F.col("failed").cast("double")
    sums = failures.agg(
        F.sum("docs").cast("double").alias("total"),
        F.sum("failed").cast("double").alias("bad"),
        F.sum(n * n).alias("squares"),
        F.sum(k * k / n).alias("between"),
        F.count("*").cast("double").alias("hosts"),
    ).withColumn("mean", F.col("bad") / F.col("total"))
    spread = F.col("mean") * (1 - F.col("mean"))
    sums = sums.withColumn(  # method of moments for clusters of unequal size
        "within",
        F.try_divide(
            F.col("between") - F.col("total") * F.col("mean") * F.col("mean")
            - spread * (F.col("hosts") - 1),
            spread * (F.col("total") - F.col("squares") / F.col("total") - F.col("hosts") + 1),
        ),
    )
    weight = F.coalesce(F.try_divide(1 - F.col("within"), F.col("within")), F.lit(MOST_PRIOR))
    weight = F.when(F.col("within") <= 0, MOST_PRIOR).otherwise(weight)
    prior = sums.select("mean", F.greatest(F.lit(LEAST_PRIOR), F.least(F.lit(MOST_PRIOR), weight)).alias("weight"))
    rate = (k + F.col("mean") * F.col("weight")) / (n + F.col("weight"))
    return failures.join(F.broadcast(prior)).select(  # one row
        "host",
        "docs",
        "failed",
        rate.alias("host_rate"),
        F.when(rate >= REJECT, "reject").when(rate >= WATCH, "watch").otherwise("trust").alias("host_verdict"),
    )


def judge(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """One row per document: key (as ``doc_id``), measures, ``base_failed``, host verdict, ``kept``.

    A null host is a host of its own; null and empty texts have no words and fail the base rules.
    Repeated rows each count and each get their row. Other columns are not read.
    """
    rows = workspace.stored(  # text is read once; the narrow rows are read twice
        measured(docs, key, host, text).withColumn("base_failed", base_failed()), "host-rules"
    )
    rows = rows.withColumn("any_failed", any_failed())
    hosts = host_verdicts(
        rows.groupBy("host").agg(
            F.count("*").alias("docs"), F.count_if("any_failed").alias("failed")
        )
    ).withColumnRenamed("host", "judged")
    joined = rows.join(hosts, F.col("host").eqNullSafe(F.col("judged")), "left")
    kept = (
        ~F.col("base_failed")
        & (F.col("host_verdict") != "reject")
        & ~((F.col("host_verdict") == "watch") & F.col("any_failed"))
    )
    return joined.select(
        F.col("key").alias("doc_id"), *MEASURES, "base_failed", kept.alias("kept"), "host_verdict"
    )
