"""Suffix deduplication against every 200-byte string of small tables."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from matchloom.llm import suffix_dedup

SCHEMA = "doc_id long, text string"


def brute_force(rows):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of (doc_id, text) rows."""
    n = suffix_dedup.LENGTH
    data = [(key, (text or "").encode()) for key, text in rows]
    seen = Counter(b[i : i + n] for _, b in data for i in range(len(b) - n + 1))
    out = []
    for key, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((key, len(b), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in suffix_dedup.report(docs).collect()), key=repr)


def sentence(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdeé", k=draw.randint(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    shared = sentence(1, 120)
    rows = [(i, sentence(100 + i, 30) + shared + sentence(200 + i, 30)) for i in range(6)]
    rows += [(10, sentence(300, 20) + shared[150:480] + "x"), (11, shared[40:239]), (12, shared[40:240])]
    rows += [(20, None), (21, ""), (None, shared[:260]), (22, "a" * 1500), (23, "ab" * 700 + "c")]
    rows += [(30, sentence(5, 60))] * 2 + [(31, sentence(5, 60)), (32, sentence(6, 20) * 8)]
    rows += [(40, sentence(7, 30000)), (41, sentence(7, 30000)[5000:60000])]
    return rows


def test_equals_brute_force(spark, corpus):
    assert got(spark, corpus) == brute_force(corpus)


@pytest.mark.parametrize("group", [1, 3])
def test_crowded_grams_are_dealt_again(spark, corpus, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows = [r for r in corpus if r[0] is None or r[0] < 40]
    assert got(spark, rows) == brute_force(rows)


def test_documents_of_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    made = sorted((tuple(r) for r in suffix_dedup.report(docs).collect()), key=repr)
    assert made == brute_force(rows)


def test_without_repeats_keeps_columns_and_cuts_texts(spark):
    shared = sentence(1, 60)
    docs = spark.createDataFrame(
        [(1, "one " + shared, "a"), (2, "two " + shared, "b"), (3, None, None)], "text_ long, text string, r1 string"
    )
    out = {r["text_"]: (r["text"], r["r1"]) for r in suffix_dedup.without_repeats(docs).collect()}
    assert out == {1: ("one", "a"), 2: ("two", "b"), 3: (None, None)}


def test_empty_table(spark):
    assert got(spark, []) == []


def test_blind_trie_orders_and_joins_equal_strings():
    draw = random.Random(3)
    strings = [bytes([7, *draw.choices(range(3), k=9)]) for _ in range(400)]
    trie = suffix_dedup.BlindTrie(strings[0], 0)
    for i, s in enumerate(strings[1:], 1):
        trie.add(s, i)
    leaves = list(trie.leaves())
    assert [strings[x[0]] for x in leaves] == sorted(set(strings))
    assert all(len({strings[i] for i in x}) == 1 for x in leaves)
    assert sorted(i for x in leaves for i in x) == list(range(400))


def test_runs_cover_every_suffix_once():
    text = sentence(9, 300).encode()
    for gram in suffix_dedup.GRAMS:
        starts, counts, _, _, times = suffix_dedup.runs(text, gram)
        covered = np.concatenate([np.arange(s, s + n * k) for s, n, k in zip(starts, counts, times)])
        assert covered.tolist() == list(range(len(text) - suffix_dedup.LENGTH + 1))


@pytest.mark.parametrize("period", [1, 2, 7, 31, 150, 400])
def test_periodic_texts_are_few_runs(period):
    draw = random.Random(period)
    text = (bytes(draw.choices(range(97, 123), k=period)) * (300_000 // period + 1))[:300_000]
    starts, counts, _, _, times = suffix_dedup.runs(text, suffix_dedup.GRAMS[0])
    assert len(starts) < 6000
    assert int((counts * times).sum()) == len(text) - suffix_dedup.LENGTH + 1


def test_periodic_texts_equal_brute_force(spark):
    words = ["ab", "abc", "x" * 31 + "y", sentence(3, 12)]
    rows = [(i, w * (2500 // len(w))) for i, w in enumerate(words)]
    rows += [(10, "ab" * 99 + "a"), (11, "ab" * 150 + sentence(4, 40)), (12, sentence(3, 12) * 2 + "!"), (13, "zab" * 80 + "ab" * 120), (14, "abc" * 70)]
    assert got(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("seed", range(4))
def test_shallow_sort_equals_sorting(seed):
    """Groups of equal first bytes, in order, out of segments of any size."""
    draw = random.Random(seed)
    alphabet = [b"a", b"b", bytes(8), b"\xff" * 8, b"abcdefgh" * 4][: 2 + seed]
    data = np.frombuffer(b"".join(draw.choices(alphabet, k=4000)) + bytes(300), np.uint8)
    at = np.array(draw.sample(range(3000), 1500))
    segment = np.sort([draw.choice([0, 0, 0, 1, 2, draw.randint(3, 200)]) for _ in at])
    depth = suffix_dedup.SHALLOW
    order, group = suffix_dedup.shallow_sort(data, at, segment)
    prefix = [(int(s), data[a : a + depth].tobytes()) for s, a in zip(segment, at)]
    counted = Counter(prefix)
    assert sorted(order.tolist()) == [i for i, p in enumerate(prefix) if counted[p] > 1]
    by_group = {}
    for i, g in zip(order.tolist(), group.tolist()):
        by_group.setdefault(g, set()).add(prefix[i])
    assert all(len(p) == 1 for p in by_group.values())
    assert len(by_group) == sum(n > 1 for n in counted.values())
