"""The pipeline against its stages by brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from matchloom.llm import neighbour_vote, raking
from matchloom.llm.common import table
from tests.conftest import rows
from tests.llm.test_filters import plain_hits
from tests.llm.test_setsketch import brute_force

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables, with odd documents and an extra column whose name the stages use too."""
    root = tmp_path_factory.mktemp("sf")
    docs = table(spark, SF, "documents")
    known = [tuple(r) for r in docs.collect()]
    item = table(spark, SF, "benchmark").first()["text"]
    odd = [
        (9001, "und so " + item, "de", "src0", 1), (9002, None, None, None, None), (9003, "", "en", "src1", 0),
        (None, known[0][1], "en", "src1", 1), (9004, known[1][1], "en", None, 1), (9005, known[1][1] + " more", None, "src2", 1),
        (9006, known[2][1], "en", "src1", 5), (9006, known[2][1], "en", "src1", 5),
    ]
    made = spark.createDataFrame(known + odd, docs.schema).selectExpr("*", "n_chars AS n_words", "'x' AS score")
    made.write.parquet(f"{root}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def mixed_by_hand(data):
    """Kept rows of (doc_id, text, lang, source) by plain raking."""
    def label(value):
        return "null" if value is None else f"={value}"

    def topic(text, n):
        lines = len(text.split("\n")) if text is not None else 0
        if text is None or not n:
            return "none"
        return "note" if n < 60 else "list" if n < 12 * lines else "long" if n >= 1000 else "prose"

    placed = []
    for row in data:
        n = len((row[1] or "").encode().split())
        placed.append((row, n, (label(row[3]), label(row[2]), label(topic(row[1], n)))))
    cells = {}
    for _, n, cell in placed:
        if n:
            cells[cell] = cells.get(cell, 0) + n
    weight = {c: float(n) for c, n in cells.items()}
    for _ in range(300):
        for d, power in enumerate((0.5, 0.7, 0.5)):
            tokens, has = {}, {}
            for c in cells:
                tokens[c[d]] = tokens.get(c[d], 0) + cells[c]
                has[c[d]] = has.get(c[d], 0) + weight[c]
            whole = sum(n**power for n in tokens.values())
            weight = {c: w * tokens[c[d]] ** power / whole / has[c[d]] for c, w in weight.items()}
    low, high = 0.0, 1e12
    for _ in range(200):
        s = (low + high) / 2
        expected = math.fsum(min(cells[c], s * weight[c]) for c in cells)
        low, high = (s, high) if expected < raking.BUDGET * sum(cells.values()) else (low, s)
    kept = []
    for row, n, cell in placed:
        drawn = int(hashlib.md5(("" if row[0] is None else str(row[0])).encode()).hexdigest()[:8], 16) / 2**32
        if not n or drawn < min(1.0, high * weight[cell] / cells[cell]):
            kept.append(row)
    return kept


def test_equals_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    model = neighbour_vote.train(docs, table(spark, folder, "labels"))
    data = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    good = [r for r, s in zip(data, model.scores([None if r[1] is None else r[1].encode() for r in data])) if s >= 0.3]
    component = {r[0]: r[3] for r in brute_force([r[:2] for r in good])}
    once, seen = [], set()
    for r in good:
        if r[0] is None or (component[r[0]] and r[0] not in seen):
            once.append(r)
            seen.add(r[0])
    items = [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()]
    dirty = {r[0] for r in plain_hits([(i, r[1]) for i, r in enumerate(once)], items, 10) if r[5]}
    kept = mixed_by_hand([r for i, r in enumerate(once) if i not in dirty])
    sized = sorted(
        ((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in kept),
        key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]),
    )
    ends = np.cumsum([r[1] for r in sized])
    shard = [int(40 * (2 * e - r[1]) // (2 * ends[-1])) for r, e in zip(sized, ends)]
    slot = [i - shard.index(s) for i, s in enumerate(shard)]
    expected = sorted((tuple([*r, s, k]) for r, s, k in zip(sized, shard, slot)), key=repr)
    made = corpus_pipeline.run(spark, folder)
    assert rows(made, "doc_id", "size", "text_crc32", "shard", "slot") == expected


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns
        empty = stage(spark, docs.limit(0), folder)
        assert empty.columns == docs.columns and empty.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0


def test_odd_documents(spark, folder):
    docs = table(spark, folder, "documents")
    once = corpus_pipeline.distinct(spark, docs, folder)
    ids = [r[0] for r in once.select("doc_id").collect()]
    assert ids.count(9006) <= 1 and ids.count(None) == 1 and 9002 in ids and 9003 in ids
    assert 9004 not in ids and 9005 not in ids
    clean = corpus_pipeline.uncontaminated(spark, docs, folder)
    assert 9001 not in {r[0] for r in clean.select("doc_id").collect()}


def test_random_order_does_not_matter(spark, folder, tmp_path):
    draw = random.Random(1).randint(2, 9)
    table(spark, folder, "documents").repartition(draw).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        table(spark, folder, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert rows(corpus_pipeline.run(spark, str(tmp_path))) == rows(corpus_pipeline.run(spark, folder))
