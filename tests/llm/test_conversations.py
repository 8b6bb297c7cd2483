"""Conversation repair against trying all edits."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from matchloom.llm import conversations
from tests.conftest import rows

SCHEMA = "conv_id long, turn long, role string, text string, audit string, digest string, cost long"


def table_of(spark, data):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in data], SCHEMA)


def planted(data):
    """The damage, row by row."""
    out = []
    for conv, turn, role, text in data:
        known = [" " if v is None else v for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{known[0]}:{known[1]}".encode()) % 20
        role, text = known[2:]
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def by_hand(data):
    """Every way of editing, from the last row; rows as ``(turn, role, text)``."""
    data = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in data:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @cache
    def best(i, state, inserted=0):
        ways = []
        if i == len(data):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            _, role, text = data[i]
            cost, audit, out = best(i + 1, state)
            ways.append((4 + cost, "D" + audit, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                if role[:1] in follow[state]:
                    cost, audit, out = best(i + 1, role[:1])
                    ways.append((more + cost, "K" + audit, ((role, text), *out)))
                for name in ("user", "assistant"):
                    if name[0] in follow[state]:
                        cost, audit, out = best(i + 1, name[0])
                        ways.append((3 + more + cost, "R" + audit, ((name, text), *out)))
        if inserted < 2:
            for name in ("user", "assistant"):
                if name[0] in follow[state]:
                    cost, audit, out = best(i, name[0], inserted + 1)
                    ways.append((3 + cost, "I" + audit, ((name, ""), *out)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, out = best(0, "")
    turns = {t for t, _, _ in data if t is not None}
    initials = [role[:1] for _, role, _ in data]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, out,
    )


def expected(data):
    out = []
    for conv in {r[0] for r in data}:
        *counts, cost, audit, left = by_hand([r[1:] for r in planted(data) if r[0] == conv])
        text = "\n".join(f"{role}:{text}" for role, text in left)
        out.append((conv, *counts, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    texts = ["Yes.", "no", "", " \n", "Why?", "a\nb. ", "é!", None, "x" * 3000 + "."]
    data = [(5, None, None, None), (6, 0, "system", "S."), (6, 0, "system", "S."), (7, -3, "tool", "T."), (7, 9, "", "E.")]
    for conv in [*range(100, 220), None]:
        turn = draw.choice([0, -2])
        for _ in range(draw.choice([1, 2, 3, 5, 9])):
            data.append((conv, draw.choice([turn, turn, turn, None]), draw.choice(["user", "assistant", "system", "user", "assistant", "tool", None]), draw.choice(texts)))
            turn += draw.choice([0, 1, 1, 1, 2])
    return data


def digests(spark, data):
    given = table_of(spark, data)
    return rows(conversations.report(conversations.damaged(given), given.select("conv_id")))


def test_equals_brute_force(spark, corpus):
    assert digests(spark, corpus) == expected(corpus)


def test_repeated_tables_and_order(spark, corpus):
    twice = corpus + corpus[::-1]
    assert digests(spark, twice) == expected(twice)
    assert digests(spark, []) == []


def test_repaired_rows_are_conversations(spark, corpus):
    found = {}
    for r in conversations.repaired(table_of(spark, corpus)).collect():
        found.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"]))
    for conv in {r[0] for r in corpus}:
        plain = [(t, " " if role is None else role, " " if text is None else text) for c, t, role, text in corpus if c == conv]
        *_, out = by_hand(plain)
        assert sorted(found.get(conv, [])) == [(i, role, text) for i, (role, text) in enumerate(out)]
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in out))


def test_one_long_conversation(spark):
    draw = random.Random(9)
    data = [(1, t, draw.choice(["user", "assistant", "system"]), f"{draw.randint(0, 3000)}{draw.choice(['.', '', '!'])}") for t in range(4000)]
    got = digests(spark, data)[0]
    symbols = []
    seen = set()
    for _, _, role, text in planted(data):
        gone = not text or (role, text) in seen
        seen.add((role, text))
        symbols.append(0 if gone else conversations.symbol("sua".index(role[0]), text[-1] not in ".!?"))
    now = conversations.END
    for of in reversed(symbols):
        now = conversations.before(now, of)
    assert got[6] == now[0]
    assert sum(letter != "I" for letter in got[7]) == len(symbols)


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_blocks_of_any_length_give_one_audit(block):
    draw = random.Random(block)
    tables, usual = conversations.Tables(block), conversations.tables()
    for _ in range(300):
        symbols = bytes(draw.choices(range(9), k=draw.randint(0, 17)))
        assert tables.audit(symbols) == usual.audit(symbols)
    assert len(usual.vectors) < 100 and all(min(v) == 0 for v in usual.vectors)
