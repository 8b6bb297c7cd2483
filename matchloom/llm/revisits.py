"""Not-modified captures resolved to the response they repeat.

A revisit takes the latest earlier full response of its canonical URL. The as-of join orders narrow
capture rows by URL and time with a range exchange, so a URL with a third of all captures is spread
over many ranges. Inside a range a window gives the last response; what a range cannot see comes from
one row per range and URL. Bodies and headers are joined afterwards, to the rows that need them.

The response stands for the revisit if a validator agrees: entity tags by weak comparison where both
have one, otherwise the modification times, otherwise the payload digests. The headers are the
response's, with those replaced or added that a not-modified answer may change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom import workspace

#: Headers that a 304 answer may bring up to date (fixed values, by the HTTP caching standard).
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def as_of(captures: DataFrame) -> DataFrame:
    """``id, response_id`` for each revisit: the latest earlier response of its URL, or null.

    ``captures``: ``id, canon, time, full``, the id of any type with an order, unique and not null. Only
    strictly earlier responses count; of responses at one time the greatest id counts. A null URL or
    time has no response.
    """
    rows = captures.select("id", "canon", "time", "full").where("canon is not null and time is not null")
    # At one time revisits come before responses, which therefore are not earlier.
    order = ["canon", "time", "full", "id"]
    ranged = workspace.stored(
        rows.withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(*order, "place")
        .withColumn("range", F.spark_partition_id()),
        "captures",
    )
    response = F.when(F.col("full"), F.col("id"))
    inside = Window.partitionBy("range", "canon").orderBy("time", "full", "id", "place").rowsBetween(Window.unboundedPreceding, 0)
    seen = ranged.withColumn("inside", F.last(response, ignorenulls=True).over(inside))
    last = ranged.where("full").groupBy("range", "canon").agg(F.max_by("id", F.struct("time", "id")).alias("last"))
    # A URL has a row for each range it reaches into, so a frequent one has as many as there are ranges.
    reached = ranged.select("range", "canon").distinct().join(last, ["range", "canon"], "left")
    earlier = Window.partitionBy("canon").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        reached.withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
        .where("carried is not null")
        .select("range", "canon", "carried")
    )
    return (
        seen.where("not full")
        .join(carried, ["range", "canon"], "left")
        .select("id", F.coalesce("inside", "carried").alias("response_id"))
    )


def same_tag(a: Column, b: Column) -> Column:
    return F.regexp_replace(a, "^W/", "") == F.regexp_replace(b, "^W/", "")


def validated(mine: dict[str, Column], theirs: dict[str, Column]) -> Column:
    """Whether the first validator that both sides have agrees; false if they share none."""
    out = F.lit(False)
    for name, agrees in (("digest", None), ("last_modified", None), ("etag", same_tag)):
        a, b = mine[name], theirs[name]
        out = F.when(a.isNotNull() & b.isNotNull(), agrees(a, b) if agrees else a == b).otherwise(out)
    return out


def resolve(captures: DataFrame) -> DataFrame:
    """One row per capture: ``id, kind, response_id, verdict, headers, body``.

    ``captures``: ``id``, ``canon``, ``time``, ``kind`` (``response`` or ``revisit``), ``digest``, ``headers`` (map
    with lower-case names) and ``body``; other columns are not read. A response is its own, verdict ``full``.
    A revisit is ``resolved`` and takes the body and the merged headers, ``mismatch`` where no validator
    agrees, or ``orphan`` without an earlier response; the last two keep their own headers and body.
    Captures of another kind, null too, are ``ignored``. Null headers are none.

    Captures are told apart by their place in the input, which must be a table: a repeated row is a
    capture of its own, and a null id is an id. Of responses with one URL, time and id the later in the
    input counts.
    """
    rows = captures.select(
        "id", "canon", "time", "kind", "digest", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "body"
    ).withColumn("row", F.monotonically_increasing_id())
    narrow = rows.where("kind in ('response', 'revisit')").select(
        F.struct("id", "row").alias("id"), "canon", "time", (F.col("kind") == "response").alias("full")
    )
    found = as_of(narrow).where("response_id is not null").select(
        F.col("id.row").alias("row"), F.col("response_id.id").alias("response_id"), F.col("response_id.row").alias("response_row")
    )
    theirs = rows.where("kind = 'response'").select(
        F.col("row").alias("response_row"), F.col("digest").alias("their_digest"),
        F.col("headers").alias("their_headers"), F.col("body").alias("their_body"),
    )
    seen = rows.where("kind = 'revisit'").join(found, "row", "left")
    # An orphan gets a number of its own that no response has; a null would send all orphans to one task.
    placed = seen.withColumn("orphan", F.col("response_row").isNull()).withColumn(
        "response_row", F.coalesce("response_row", -1 - F.col("row"))
    )
    joined = placed.join(theirs, "response_row", "left")
    agrees = validated(
        {"etag": F.col("headers")["etag"], "last_modified": F.col("headers")["last-modified"], "digest": F.col("digest")},
        {"etag": F.col("their_headers")["etag"], "last_modified": F.col("their_headers")["last-modified"], "digest": F.col("their_digest")},
    )
    verdict = F.when(F.col("orphan"), "orphan").when(agrees, "resolved").otherwise("mismatch")
    updates = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("their_headers", lambda k, v: ~F.array_contains(F.map_keys(updates), k)), updates)
    revisited = joined.withColumn("verdict", verdict).select(
        "id", "kind", "response_id", "verdict",
        F.when(F.col("verdict") == "resolved", merged).otherwise(F.col("headers")).alias("headers"),
        F.when(F.col("verdict") == "resolved", F.col("their_body")).otherwise(F.col("body")).alias("body"),
    )
    own = rows.where("kind is null or kind <> 'revisit'").select(
        "id", "kind", F.when(F.col("kind") == "response", F.col("id")).alias("response_id"),
        F.when(F.col("kind") == "response", "full").otherwise("ignored").alias("verdict"), "headers", "body",
    )
    return revisited.unionByName(own)
