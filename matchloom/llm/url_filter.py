"""URL lists: a blocked Bloom filter lets possible hits through to an exact hash join.

The filter is a table of 256-bit blocks, four longs each. A URL sets eight bits, one in each 32-bit
half of a word, of the one block its hash picks, so building is one ``bit_or`` aggregation and
testing is one lookup of one row. Only URLs that pass, the listed ones and about one in a hundred
others, take part in the join on the URL itself, which removes the false ones.

Everything is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import workspace

#: Filter bits for each listed URL.
BITS_PER_URL = 12
#: A filter of at most this many blocks (48 bytes each in a hash table) is broadcast; 32 MB.
BROADCAST_BLOCKS = 700_000
#: Parameters that say where a visitor came from, not what the page is (fixed values).
TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid)="

WORDS = ("w0", "w1", "w2", "w3")


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def lower_ascii(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end; empty without ``://`` or for null."""
    rest = after_scheme(url)
    return F.coalesce(lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end."""
    rest = after_scheme(url)
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling of a URL: no scheme, ``www.`` or ``m.``, default port, fragment, tracking
    parameters, ``.html`` or last slash; parameters sorted. Null without ``://``.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"\.html?$", ""), r"/+$", "")
    query = F.regexp_extract(after_scheme(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, tail))


def mask(url: Column, word: int) -> Column:
    """The bits of a URL in one word of its block."""
    bits = F.xxhash64(F.lit("bits"), url)
    low = F.shiftrightunsigned(bits, 10 * word).bitwiseAND(31)
    high = F.shiftrightunsigned(bits, 10 * word + 5).bitwiseAND(31) + 32
    return F.call_function("shiftleft", F.lit(1).cast("long"), low.cast("int")).bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), high.cast("int"))
    )


def block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), url), F.lit(blocks))


def bloom(listed: DataFrame, blocks: int, url: str = "canon") -> DataFrame:
    """The filter: one row per block that has a bit."""
    return (
        listed.select(block(F.col(url), blocks).alias("block"), *[mask(F.col(url), i).alias(w) for i, w in enumerate(WORDS)])
        .groupBy("block")
        .agg(*[F.bit_or(w).alias(w) for w in WORDS])
    )


def listed_urls(pages: DataFrame, listed: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: key, url, and whether its canonical URL is one of ``listed.canon``.

    A null URL or one without ``://`` is never listed. Repeated list entries count once; repeated
    pages each get their row; null entries are ignored.
    """
    listed = workspace.stored(listed.select("canon").where("canon is not null").distinct(), "listed")
    blocks = max(1, -(-listed.count() * BITS_PER_URL // 256))
    bits = bloom(listed, blocks)
    if blocks <= BROADCAST_BLOCKS:
        bits = F.broadcast(bits)
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url")).withColumn("canon", canonical(F.col("url")))
    # A null URL picks block -1, which is never there.
    rows = rows.withColumn("block", F.coalesce(block(F.col("canon"), blocks), F.lit(-1)))
    passes = reduce(
        lambda a, b: a & b,
        [F.col(w).bitwiseAND(mask(F.col("canon"), i)) == mask(F.col("canon"), i) for i, w in enumerate(WORDS)],
    )
    tested = rows.join(bits, "block", "left").select(
        "key", "url", "canon", F.coalesce(passes, F.lit(False)).alias("possible")
    )
    known = listed.select("canon", F.lit(True).alias("listed"))
    hits = tested.where("possible").join(known, "canon", "left")
    rest = tested.where("not possible").withColumn("listed", F.lit(False))
    return hits.select("key", "url", F.coalesce("listed", F.lit(False)).alias("listed")).unionByName(
        rest.select("key", "url", "listed")
    )


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null without one.

    A rule such as ``example.net/en/`` fits the host and its subdomains where the path starts with
    the rule's path. Of rules equally long a blocking one wins.
    """
    name = verdict = F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rule_path}")
        name = F.when(fits, rule).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: key (as ``page_id``), host, path, rule, verdict, ``listed``.

    The rule's verdict if one fits; otherwise ``block`` for listed URLs and ``allow`` for others.
    """
    rows = listed_urls(pages, listed, key, url).select(
        F.col("key").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "listed"
    )
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed",
    )
