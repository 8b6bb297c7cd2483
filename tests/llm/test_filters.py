"""Edge cases of the host rules, decontamination, line deduplication, URL filter and shards."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from matchloom.llm import decontaminate, host_rules, line_dedup, queries, shards, url_filter
from tests.conftest import rows

TEXTS = [
    (1, "a b c", "s1"), (2, None, "s1"), (3, "", None), (None, "x y", "s2"), (5, "a b c", "s1"), (5, "a b c", "s1"),
    (7, "w " * 40000, "s3"), (8, "é\u00a0ü ## x\n\nx\n x\nx", "s3"),
]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- host rules ----------------------------------------------------------------------


def test_measures_of_odd_texts():
    assert host_rules.measure(None) == host_rules.measure(b"") == (0, 0, 0, 0, 0)
    # A no-break space is part of a word; lines are equal as they are.
    assert host_rules.measure(TEXTS[7][1].encode()) == (6, 9, 2, 1, 4)
    assert host_rules.measure(b"a b c a b c a b") == (8, 8, 0, 0, 8)
    assert host_rules.measure(b"a b c d e a b c") == (8, 8, 0, 0, 6)


def test_every_row_is_judged(texts, nothing):
    made = host_rules.judge(texts)
    assert made.count() == len(TEXTS)
    assert not made.where("kept and base_failed").count()
    assert made.where("host_verdict is null").count() == 0
    assert host_rules.judge(nothing).count() == 0


def test_bad_hosts_are_rejected_and_small_ones_shrunk(spark):
    counts = [("bad", 1000, 950), ("small", 1, 1)] + [(f"h{i}", 1000, 10 + i) for i in range(20)]
    made = host_rules.host_verdicts(spark.createDataFrame(counts, "host string, docs long, failed long"))
    got = {r["host"]: (r["host_verdict"], r["host_rate"]) for r in made.collect()}
    assert got["bad"][0] == "reject"
    assert got["small"][0] != "reject" and got["small"][1] < 1
    assert got["h0"][0] in ("trust", "watch")


# --- decontamination -----------------------------------------------------------------


def plain_hits(docs, items, window):
    """Windows by brute force."""
    pats = {}
    for item, text in items:
        found = decontaminate.words((text or "").encode())
        m = min(window, len(found))
        for i in range(len(found) - m + 1 if m else 0):
            pats.setdefault(tuple(found[i : i + m]), set()).add(str(item))
    out = []
    for key, text in docs:
        found = decontaminate.words((text or "").encode())
        hit, met = set(), set()
        for i in range(len(found)):
            for m in range(1, min(window, len(found) - i) + 1):
                for item in pats.get(tuple(found[i : i + m]), ()):
                    hit |= set(range(i, i + m))
                    met.add(item)
        ids = ",".join(sorted(met))
        out.append((key, len(found), len(hit), len(met), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [10**6, 60])
def test_contamination_equals_brute_force(spark, block_bytes):
    draw = random.Random(4)
    vocabulary = ["a", "b", "c", "ç", "x1"]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 80)))) for i in range(40)]
    docs += [(None, None), (50, ""), (51, "A, b; C"), (51, "A, b; C")]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 9)))) for i in range(12)]
    items += [(20, None), (None, "a b"), (21, "--"), (22, items[3][1])]
    made = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        keep=["doc_id"], window=5, block_bytes=block_bytes,
    )
    expected = plain_hits(docs, [x for x in items if x[0] is not None], 5)
    assert sorted((tuple(r) for r in made.collect()), key=repr) == expected


def test_items_without_id_are_searched(spark, tmp_path):
    docs = [(1, "x a b c"), (2, "a b"), (3, "c d e"), (4, "y"), (5, "a b c d e")]
    items = [(None, "a b"), (None, "d e"), (7, "c"), (8, "b c")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def sha(ids):
        return hashlib.sha256(ids.encode()).hexdigest()

    assert rows(queries.op2_decontaminate(spark, str(tmp_path))) == [
        (1, 4, 3, 3, sha("7,8"), True), (2, 2, 2, 1, sha(""), True), (3, 3, 3, 2, sha("7"), True),
        (4, 1, 0, 0, sha(""), False), (5, 5, 5, 3, sha("7,8"), True),
    ]
    left = corpus_pipeline.uncontaminated(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert rows(left, "doc_id") == [(4,)]


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 9)], "doc_id long, text string, n_words long")
    items = spark.createDataFrame([(1, "b")], "item_id long, text string")
    made = decontaminate.contamination(docs, items, keep=docs.columns)
    assert made.columns[:4] == ["doc_id", "text", "n_words", "n_words_"]
    assert tuple(made.first())[:6] == (1, "a b", 9, 2, 1, 1)
    assert decontaminate.contamination(docs.limit(0), items, keep=["doc_id"]).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0), keep=["doc_id"]).first()["contaminated"]


# --- lines ---------------------------------------------------------------------------


def test_boilerplate_leaves_by_distinct_sites(spark):
    sites = [(f"s{i}", "cookie notice\nown %d" % i) for i in range(10)]  # exactly at the limit
    rare = [(f"s{i}", "rare line\n\nown") for i in range(9)] * 30  # many rows, one site short
    null = [(None, "with null")] + [(f"s{i}", "with null") for i in range(9)]
    odd = [("s1", None), ("s1", ""), ("s1", "cookie notice")]
    data = [(s, t, 7) for s, t in sites + rare + null + odd]
    docs = spark.createDataFrame(data, "source string, text string, n_lines int")
    made = line_dedup.without_boilerplate(docs)
    assert made.columns == ["source", "text", "n_lines", "n_lines_", "n_removed"]
    got = [tuple(r)[1:] for r in made.collect()]
    gone, own = {"cookie notice", "with null"}, []
    for _, text, n in data:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if x not in gone]
        own.append((None if text is None else "\n".join(kept), n, len(lines), len(lines) - len(kept)))
    assert sorted(got, key=repr) == sorted(own, key=repr)
    assert line_dedup.without_boilerplate(docs.limit(0)).count() == 0


# --- URLs ----------------------------------------------------------------------------

URLS = [
    ("http://WWW.Example.com:80/a/?b=1&a=2&utm_source=x#top", "example.com/a?a=2&b=1"),
    ("https://m.example.com/a.html", "example.com/a"), ("https://example.com", "example.com"),
    ("no scheme", None), (None, None), ("", None), ("http://", ""), ("x://h?q", "h?q"),
]


def test_canonical_urls(spark):
    data = spark.createDataFrame([(u,) for u, _ in URLS], "url string")
    got = {r[0]: r[1] for r in data.select("url", url_filter.canonical(F.col("url"))).collect()}
    assert got == dict(URLS)


def test_filter_has_no_false_answers(spark):
    urls = spark.range(4000).select(F.concat(F.lit("http://h/"), F.col("id")).alias("url"), F.col("id").alias("page_id"))
    listed = urls.where("page_id % 3 = 0").select(url_filter.canonical(F.col("url")).alias("canon"))
    listed = listed.unionByName(listed).unionByName(spark.sql("SELECT cast(null AS string) AS canon"))
    made = url_filter.listed_urls(urls.unionByName(urls), listed)
    wrong = made.where("listed <> (key % 3 = 0)")
    assert made.count() == 8000 and wrong.count() == 0
    assert url_filter.listed_urls(urls, listed.limit(0)).where("listed").count() == 0
    assert url_filter.listed_urls(urls.limit(0), listed).count() == 0


def test_rules(spark):
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    given = {
        "http://a.net/x": ("net/", "block"), "http://a.net": (None, "allow"), "http://EXAMPLE.net/en/1": ("example.net/en/", "allow"),
        "http://a.example.net/en/1": ("example.net/en/", "allow"), "http://badexample.com/de/": (None, "allow"),
        "http://x.example.com/de/?q": ("example.com/de/", "block"), "http://net/": ("net/", "block"), "nothing": (None, "allow"),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id long, url string")
    made = url_filter.judge(pages, spark.sql("SELECT 'x' AS canon"), rules)
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in made.collect()}
    assert [got[i] for i in range(len(given))] == list(given.values())


# --- shards --------------------------------------------------------------------------


def test_shards_are_balanced_and_gapless(spark):
    draw = random.Random(2)
    data = [(i if i % 3 else None, "x" * draw.randint(0, 300) if i % 7 else None) for i in range(3000)]
    data += [(5, "same")] * 500
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    made = shards.assign(docs, 10).collect()
    assert len(made) == len(data)
    total = sum(r["size"] for r in made)
    for shard in range(10):
        mine = [r for r in made if r["shard"] == shard]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 10) <= 316
    assert {r["text_crc32"] for r in made if r["size"] == 16} == {0}
    assert all(r["text_crc32"] == zlib.crc32(b"same") for r in made if r["doc_id"] == 5 and r["size"] == 20)


def test_shards_of_few_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shards.assign(empty).count() == 0
    one = spark.createDataFrame([(1, "ü")], "doc_id long, text string")
    assert rows(shards.assign(one, 4), "doc_id", "size", "slot") == [(1, 18, 0)]
    docs = spark.createDataFrame([(i, "t" * i, "k") for i in range(40)], "doc_id long, text string, shard_ string")
    placed = shards.write(docs, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert rows(back, "doc_id", "text", "shard_") == rows(docs)
    assert rows(back, "doc_id", "shard", "slot") == rows(placed, "doc_id", "shard", "slot")
