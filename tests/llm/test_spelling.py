"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchloom.llm import spelling
from tests.conftest import rows


def near(a, b):
    """One insertion, deletion or replacement apart, by trying them."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_force(counts, ratio=10):
    words = sorted(counts)
    form, n_near = {}, {}
    for w in words:
        others = [o for o in words if near(w, o)]
        n_near[w] = len(others)
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), counts[w], n_near[w], counts[form[w]] if form[w] else None) for w in words), key=repr)


def vocabulary(seed, n=400):
    """Words of few letters, so that many are near, with runs of one letter and letters beyond 16 bits."""
    draw = random.Random(seed)
    letters = "ab" if seed else "abcé\U00010400"
    words = {"".join(draw.choice(letters) for _ in range(draw.choice([7, 7, 8, 9, 10, 14]))) for _ in range(n)}
    words |= {"a" * k for k in range(6, 15)}
    return {w: draw.choice([1, 2, 3, 30, 400, 4000]) for w in words}


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def given(spark, counts):
    made = spark.createDataFrame(list(counts.items()), "word string, n long")
    return made.select("word", F.explode(F.expr("sequence(1L, n)")).alias("n"))


@pytest.mark.parametrize("seed, tile", [(0, 1024), (1, 1024), (1, 8), (2, 3)])
def test_equals_all_pairs(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(spelling, "ROWS", 500)
    counts = vocabulary(seed)
    words = given(spark, counts).unionAll(spark.createDataFrame([(None, 1)], "word string, n long"))
    kept = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert rows(spelling.variants(words, tile=tile), *COLUMNS) == brute_force(kept)


def test_chains_end_at_the_last_form(spark):
    counts = {"aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaabbb": 2000}
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.variants(given(spark, counts)).collect()}
    assert got["aaaaaaaa"] == ("aaaaaaab", "aaaaabbb") and got["aaaaabbb"] == (None, "aaaaabbb")


def test_a_tile_alone():
    words = ["abcdefg", "abcdefh", "abcdefgh"]
    n = len(words)
    made = pa.table({"m": [7] * n, "part": [2] * n, "agree": [1] * n, "x": [0] * n, "y": [0] * n, "block": [0] * n, "word": words, "n": [5, 9, 9]})
    got = spelling.compare(made).to_pylist()
    assert {r["word"]: (r["near"], r["best"]) for r in got} == {
        "abcdefg": (2, "abcdefgh"), "abcdefh": (2, "abcdefgh"), "abcdefgh": (2, "abcdefh"),
    }


def test_misspelt_runs_of_odd_documents(spark):
    data = [(1, "Hello Ünderstanding, x"), (None, "WONDERFUL wonderful"), (3, None), (4, ""), (5, "a" * 5000 + " Naïveté-Naïveté"), (5, "a" * 5000)]
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in data], "doc_id long, text string, word string, n long")
    expected = Counter()
    for doc_id, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 2 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            expected[run] += 1
    got = spelling.misspelt(docs, every=2)
    assert Counter(r["word"] for r in got.collect() if len(r["word"]) >= 7) == {w: n for w, n in expected.items() if len(w) >= 7}
    assert {r["word"]: r["n"] for r in spelling.variants(got, times=1).collect()} == {w: n for w, n in expected.items() if len(w) >= 7}
    assert spelling.variants(got.limit(0)).count() == 0
    assert spelling.variants(spelling.misspelt(docs.limit(0))).columns == list(COLUMNS)
