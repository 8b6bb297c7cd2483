"""SetSketch near-duplicates against all pairs of small tables, and the sketch itself."""

import random
import time

import numpy as np
import pytest

from matchloom.llm import setsketch, shingles
from matchloom.llm.components import components
from tests.conftest import rows

SCHEMA = "doc_id long, text string, n_shingles string"


def plain_sets(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(data):
    """doc_id, n_shingles, component_id, kept of (doc_id, text) rows."""
    found = [(key, plain_sets(text)) for key, text in data]
    parent = {key: key for key, _ in found}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(found):
        for b, t in found[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(
        (
            (key, len(s), *((root(key), key == root(key)) if s and key is not None else (key, None if key is None else True)))
            for key, s in found
        ),
        key=repr,
    )


def words(draw, n):
    return [f"w{draw.randint(0, 5000)}" for _ in range(n)]


def edited(draw, text, n):
    text = list(text)
    for _ in range(n):
        text[draw.randrange(len(text))] = f"e{draw.randint(0, 10**6)}"
    return text


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(8)
    data = []
    base = words(draw, 150)
    for n in range(60):  # from copies of one text to texts that are just not linked
        data.append((1000 + n, " ".join(edited(draw, base, n % 9))))
    chain = words(draw, 120)
    for n in range(25):  # linked only one to the next
        chain = edited(draw, chain, 2)
        data.append((2000 - n, " ".join(chain)))
    for n in range(30):
        data.append((3000 + n, " ".join(words(draw, 60) + base[:70])))
    data += [(1, None), (2, ""), (3, " \n"), (None, "a b c"), (4, "a b c"), (5, "A  b\tC"), (6, "a b"), (7, "a b c d e")]
    data += [(8, "x y z u v w"), (8, "x y z u v w"), (8, " ".join(base)), (9, "long " * 60000), (10, "long " * 59000)]
    return data


def got(spark, data):
    docs = spark.createDataFrame([(*r, "clash") for r in data], SCHEMA)
    return sorted((tuple(r) for r in setsketch.near_duplicates(docs).collect()), key=repr)


def test_equals_all_pairs(spark, corpus):
    assert got(spark, corpus) == brute_force(corpus)


def test_small_blocks_change_nothing(spark, corpus, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 4)
    monkeypatch.setattr(setsketch, "CENTRE_BLOCK", 4)
    assert got(spark, corpus[:90]) == brute_force(corpus[:90])


def test_an_id_with_several_texts_joins_their_groups(spark):
    draw = random.Random(5)
    a, b, c, d = (words(draw, 40) for _ in range(4))
    data = [(5, a), (7, a), (7, b), (9, b)]  # 7 is the least id of b, not of a
    data += [(20, a), (21, c), (22, edited(draw, c, 1)), (30, a), (30, c), (30, d), (31, d), (25, d)]
    data = [(key, " ".join(text)) for key, text in data] + [(7, ""), (40, "x y z"), (40, "x y z")]
    made = got(spark, data)
    assert made == brute_force(data)
    assert {r[2] for r in made if r[1] and r[0] != 40} == {5}


def test_a_large_block_without_families_ends(spark):
    """16,384 sketches that are alike in a few registers only: centres are looked for a bounded number of times."""
    draw = np.random.default_rng(5)
    sketches = draw.integers(20000, 20400, (setsketch.CENTRE_BLOCK, setsketch.REGISTERS)).astype(np.uint16)
    rows_ = {
        "rep": np.arange(len(sketches)), "n": np.full(len(sketches), 300), "component": np.arange(len(sketches)),
        "registers": [s.tobytes() for s in sketches],
    }
    begun = time.process_time()
    found = list(setsketch.Group(rows_, False).stars())
    assert len(found) == setsketch.CENTRES
    assert time.process_time() - begun < 60


@pytest.mark.parametrize("centres", [1, 3])
def test_fewer_centres_change_nothing(spark, corpus, monkeypatch, centres):
    monkeypatch.setattr(setsketch, "CENTRES", centres)
    assert got(spark, corpus) == brute_force(corpus)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_registers_estimate_similarity_and_merge():
    draw = np.random.default_rng(1)
    for n, m, both in ((900, 900, 800), (60, 80, 50), (5000, 4000, 3900), (1, 1, 1)):
        pool = draw.integers(0, 2**64, n + m, dtype=np.uint64)
        a, b = pool[:n], pool[n - both : n - both + m]
        x, y = setsketch.registers(a), setsketch.registers(b)
        truth = both / (n + m - both)
        above, below = setsketch.counts(x[None], y[None])
        guess = setsketch.likelihood(above, below, np.array([n]), np.array([m]))[0]
        assert abs(guess - truth) < 5 * (0.25 / setsketch.REGISTERS) ** 0.5
        union = np.unique(np.concatenate((a, b)))
        # An element stops when all its later values are too large, so parts may differ from the whole
        # only where a part has fewer values; the minimum is the same.
        assert (setsketch.merged(x, y) == setsketch.registers(union)).all()


def test_registers_of_a_set_do_not_depend_on_order():
    items = np.random.default_rng(2).integers(0, 2**64, 700, dtype=np.uint64)
    assert (setsketch.registers(items) == setsketch.registers(items[::-1].copy())).all()


def test_shingle_sets_of_a_batch_are_those_of_each_text():
    texts = [b"a b c d e f", None, b"", b"A B c  d\te f", b"a b", b"b a", "é ü a b c d".encode(), b" x "]
    together = shingles.sets(texts)
    assert [len(s) for s in together] == [2, 0, 0, 2, 1, 1, 2, 1]
    assert all((s == t).all() for s, t in zip(together, (shingles.sets([x])[0] for x in texts)))
    assert (together[0] == together[3]).all() and together[4][0] != together[5][0]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(i, i + 1) for i in range(100, 140)] + [(draw.randint(0, 60), draw.randint(0, 60)) for _ in range(40)]
    links += [(5, 5), (None, 3), (200, 7), (7, 200)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    expected = sorted(((x, root(x)) for x in parent if root(x) != x), key=repr)
    made = components(spark.createDataFrame(links, "a long, b long"))
    assert rows(made, "node", "component") == expected
