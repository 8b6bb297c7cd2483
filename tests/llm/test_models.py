"""Neighbour votes, revisits and raking on small tables and odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.llm import neighbour_vote, raking, revisits
from tests.conftest import rows

# --- quality -------------------------------------------------------------------------


def sample_texts(n=120):
    draw = random.Random(5)
    good = [" ".join("".join(draw.choices("abcdefg", k=draw.randint(2, 8))) for _ in range(80)) for _ in range(n)]
    bad = [" ".join(w + draw.choice(["!!", "$$$", "%%%"]) for w in t.split()) for t in good[: n // 4]]
    return [(i, t, int(i < n)) for i, t in enumerate(good + bad)]


@pytest.fixture(scope="module")
def labelled(spark):
    data = sample_texts()
    docs = spark.createDataFrame([(k, t, "x") for k, t, _ in data] + [(900, None, None), (901, "", ""), (None, "a", "a")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, y, 0) for k, _, y in data] + [(900, None, 1), (None, 1, 1), (902, 0, 0), (3, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    return data, docs, labels


def test_held_out_accuracy_and_every_row_scored(labelled):
    data, docs, labels = labelled
    model = neighbour_vote.train(docs, labels)
    made = neighbour_vote.score(docs, model)
    assert made.columns == ["doc_id", "text", "score", "score_"]
    got = {r["doc_id"]: r["score_"] for r in made.collect()}
    assert len(got) == len(data) + 3 and all(0 <= x <= 1 for x in got.values())
    held = [(k, y) for k, _, y in data if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum((got[k] >= neighbour_vote.THRESHOLD) == y for k, y in held) >= 0.95 * len(held)
    # The labels of held-out rows are not learnt.
    assert len(model.labels) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k, _, _ in data)


def test_scores_equal_a_plain_vote(labelled):
    _, docs, labels = labelled
    model = neighbour_vote.train(docs, labels)
    texts = [t.encode() for _, t, _ in sample_texts()[5::17]] + [b"", None]
    for text, made in zip(texts, model.scores(texts)):
        v = neighbour_vote.weighted([neighbour_vote.terms(text)], model.idf)[0] @ model.space
        cosines = [float(v @ x / max(1e-9, np.linalg.norm(v))) for x in model.vectors]
        best = sorted(range(len(cosines)), key=lambda i: -cosines[i])[: neighbour_vote.NEIGHBOURS]
        weight = [max(0.0, cosines[i]) ** neighbour_vote.POWER * model.stands_for[i] for i in best]
        expected = sum(w * model.labels[i] for w, i in zip(weight, best)) / sum(weight)
        assert made == pytest.approx(expected, abs=1e-3)


def test_without_labels_or_documents(labelled):
    _, docs, labels = labelled
    model = neighbour_vote.train(docs, labels.limit(0))
    assert {r[0] for r in neighbour_vote.score(docs, model, into="s").select("s").collect()} == {0.5}
    model = neighbour_vote.train(docs.limit(0), labels)
    assert neighbour_vote.score(docs.limit(0), model).count() == 0


def test_the_sample_is_bounded(labelled, monkeypatch):
    monkeypatch.setattr(neighbour_vote, "MAX_PER_LABEL", 10)
    model = neighbour_vote.train(labelled[1], labelled[2])
    assert len(model.labels) <= 20 and model.stands_for.max() > 5


# --- revisits ------------------------------------------------------------------------

CAPTURE = "id long, canon string, time long, kind string, digest string, headers map<string,string>, body string, verdict string"


def captures(spark, data):
    return spark.createDataFrame([(*r, "clash") for r in data], CAPTURE)


def test_revisits_take_the_latest_earlier_response(spark):
    tag = {"etag": '"1"', "content-type": "text/html", "date": "1"}
    data = [
        (1, "u", 10, "response", "d1", tag, "one"), (2, "u", 20, "response", "d2", {"last-modified": "m"}, "two"),
        (3, "u", 15, "revisit", None, {"etag": 'W/"1"', "date": "2", "content-length": "0", "vary": "x"}, None),
        (4, "u", 15, "revisit", None, {"etag": '"9"'}, None), (5, "u", 30, "revisit", None, {"last-modified": "m"}, None),
        (6, "u", 30, "revisit", "d2", {}, None), (7, "u", 10, "revisit", None, tag, None), (8, "v", 99, "revisit", None, tag, None),
        (9, None, 99, "revisit", None, None, None), (10, "u", None, "revisit", None, tag, ""), (11, "u", 40, "metadata", None, None, "m"),
        (12, "u", 50, None, None, None, None), (13, "u", 20, "response", "d3", None, "later id"), (14, "u", 60, "revisit", "d3", None, None),
        (None, "u", 1, "response", "d0", tag, "no id"),
    ]
    got = {r["id"]: r for r in revisits.resolve(captures(spark, data)).collect()}
    assert len(got) == 15 and (got.pop(None)["verdict"]) == "full"
    seen = {k: (r["response_id"], r["verdict"]) for k, r in got.items()}
    assert seen == {
        1: (1, "full"), 2: (2, "full"), 13: (13, "full"), 3: (1, "resolved"), 4: (1, "mismatch"), 5: (13, "mismatch"),
        6: (13, "mismatch"), 7: (None, "resolved"), 8: (None, "orphan"), 9: (None, "orphan"), 10: (None, "orphan"),
        11: (None, "ignored"), 12: (None, "ignored"), 14: (13, "resolved"),
    }
    assert got[3]["body"] == "one" and got[14]["body"] == "later id" and got[10]["body"] == ""
    assert got[3]["headers"] == {"etag": 'W/"1"', "content-type": "text/html", "date": "2", "vary": "x"}
    assert got[4]["headers"] == {"etag": '"9"'}
    assert revisits.resolve(captures(spark, [])).count() == 0


def test_repeated_and_nameless_captures_are_rows_of_their_own(spark):
    data = [
        (1, "u", 10, "response", "d1", {}, "one"), (2, "u", 20, "revisit", "d1", {}, None), (None, "u", 15, "response", "d2", {}, "no id"),
        (None, "u", 20, "revisit", "d2", {}, None), (3, "v", 20, "revisit", "d1", {}, "own"),
    ]
    got = revisits.resolve(captures(spark, data * 3).coalesce(1)).collect()
    assert len(got) == 15
    seen = sorted(((r["id"], r["kind"], r["response_id"], r["verdict"], r["body"]) for r in got), key=repr)
    expected = [
        (1, "response", 1, "full", "one"), (2, "revisit", None, "mismatch", None), (None, "response", None, "full", "no id"),
        (None, "revisit", None, "resolved", "no id"), (3, "revisit", None, "orphan", "own"),
    ]
    assert seen == sorted(expected * 3, key=repr)


def test_as_of_equals_brute_force_with_a_hot_url(spark):
    draw = random.Random(1)
    data = [(i, "hot" if i % 3 == 0 else f"u{draw.randint(0, 40)}", draw.randint(0, 300), draw.random() < 0.05) for i in range(3000)]
    made = revisits.as_of(spark.createDataFrame(data, "id long, canon string, time long, full boolean").repartition(5))
    expected = []
    for i, canon, time, full in data:
        if not full:
            before = [(t, j) for j, c, t, f in data if f and c == canon and t < time]
            expected.append((i, max(before)[1] if before else None))
    assert rows(made, "id", "response_id") == sorted(expected, key=repr)


# --- mixing --------------------------------------------------------------------------

DOCS = "doc_id long, text string, source string, lang string, topic string"


def mixing_docs(spark, n=2000):
    draw = random.Random(3)
    data = [
        (i, " ".join(["w"] * draw.choice([3, 20, 90, 700])), "s0" if i % 3 == 0 else f"s{draw.randint(1, 4)}", draw.choice(["en", "en", "de", None]), "t")
        for i in range(n)
    ]
    return spark.createDataFrame(data + [(None, None, None, None, None), (5, "", "s9", "xx", "t"), (5, "", "s9", "xx", "t")], DOCS)


@pytest.mark.parametrize("local", [10**6, 0])
def test_expected_tokens_meet_budget_and_marginals(spark, monkeypatch, local):
    monkeypatch.setattr(raking, "LOCAL_CELLS", local)
    monkeypatch.setattr(raking, "TOLERANCE", 1e-6)
    docs = mixing_docs(spark)
    made = raking.mixed(docs, budget=0.2).toPandas()
    assert list(made.columns) == [*docs.columns, "n_tokens", "topic_", "probability", "marginal_error", "sampled"]
    assert len(made) == docs.count()
    expected = (made.n_tokens * made.probability).sum()
    assert expected == pytest.approx(0.2 * made.n_tokens.sum(), rel=1e-6)
    assert made[made.n_tokens == 0].sampled.all()
    if (made[made.n_tokens > 0].probability < 1).all():  # no cell is kept whole: marginals are exact
        for column, power in (("source", 0.5), ("lang", 0.7), ("topic_", 0.5)):
            groups = made[made.n_tokens > 0].fillna("null").groupby(column)
            has = groups.apply(lambda g: (g.n_tokens * g.probability).sum())
            want = groups.n_tokens.sum() ** power
            assert np.allclose(has / has.sum(), want / want.sum(), rtol=1e-4)


def test_both_ways_of_raking_agree(spark, monkeypatch):
    docs = mixing_docs(spark, 500)
    here = raking.mixed(docs).select("doc_id", F.round("probability", 6), "sampled")
    monkeypatch.setattr(raking, "LOCAL_CELLS", 0)
    assert rows(raking.mixed(docs).select("doc_id", F.round("probability", 6), "sampled")) == rows(here)


def test_targets_that_cannot_be_met_are_told(spark, monkeypatch):
    """Each source has a language of its own, so the two targets contradict each other."""
    data = [(i, "w " * 50, "s1" if i % 4 else "s2", "en" if i % 4 else "de", "t") for i in range(40)]
    docs = spark.createDataFrame(data, DOCS)
    shares = {"source": {"s1": 0.5, "s2": 0.5}, "lang": {"en": 0.9, "de": 0.1}}
    monkeypatch.setattr(raking, "ROUNDS", 300)
    monkeypatch.setattr(raking, "JOB_ROUNDS", 3)
    for cells in (10**6, 0):
        monkeypatch.setattr(raking, "LOCAL_CELLS", cells)
        (off,) = {r[0] for r in raking.mixed(docs, shares=shares, budget=0.1).select("marginal_error").collect()}
        assert off > 0.5
    agreeing = {"source": {"s1": 0.5, "s2": 0.5}, "lang": {"en": 0.5, "de": 0.5}}
    monkeypatch.setattr(raking, "LOCAL_CELLS", 10**6)
    made = raking.mixed(docs, shares=agreeing, budget=0.1).toPandas()
    assert made.marginal_error.max() <= 1e-10


def test_slow_targets_go_on_to_the_end():
    """A table whose raked weights go to 0 in the limit: later rounds still change them, and it is told."""
    cells = [(10, "a", "x"), (10, "a", "y"), (10, "b", "y")]
    weights, off = raking.rake_here(cells, [{"a": 0.5, "b": 0.5}, {"x": 0.5, "y": 0.5}])
    assert 0 < off < 1e-3 and weights[1] < 1e-3


def test_given_shares_and_empty_tables(spark):
    docs = mixing_docs(spark, 300)
    made = raking.mixed(docs, shares={"lang": {"en": 1.0}}, budget=0.1).toPandas()
    other = made[(made.lang != "en") & (made.n_tokens > 0)]
    assert (other.probability == 0).all() and not other.sampled.any()
    assert raking.mixed(docs.limit(0)).count() == 0
    assert raking.mixed(docs.where("text is null")).count() == 1
