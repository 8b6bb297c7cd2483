"""The first of many ordered keyword rules that occurs anywhere in a name.

A rule is a keyword with a priority and what it stands for; of all rules whose keyword a name contains the
least priority wins. Thousands of rules are one Aho-Corasick automaton: a table that gives the next state for
each state and character, and the least priority that ends in each state. A task walks all names of a
batch through it together, a character at a time, so a name costs its length whatever the number of rules.

The table's size is known from the rules' counted characters. Up to ``TABLE_BYTES`` the automaton is broadcast;
beyond, the substrings of the names that have a keyword's length are joined with the rules.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most bytes of an automaton's table that are broadcast.
TABLE_BYTES = 64 << 20
#: Characters that are walked at once, names padded to the longest of their piece.
CELLS = 1 << 22
NO_RULE = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Automaton:
    """``step[state, letter]`` is the next state, ``best[state]`` the least rule that ends there. Letter 0
    is any character that is in no keyword."""

    letters: np.ndarray
    step: np.ndarray
    best: np.ndarray

    def first_rules(self, names: Sequence[str | None]) -> np.ndarray:
        """The least rule in each name; ``NO_RULE`` where none occurs, or without a name."""
        out = np.full(len(names), NO_RULE)
        known = np.array([i for i, n in enumerate(names) if n is not None], np.int64)
        sizes = np.array([len(names[i]) for i in known], np.int64)
        order = np.argsort(sizes, kind="stable")
        begin = 0
        while begin < len(order):
            # Names of like length together, so that little is padded.
            widths = sizes[order[begin:]]
            fits = np.flatnonzero(widths * np.arange(1, len(widths) + 1) <= CELLS)
            piece = order[begin : begin + max(1, len(fits))]
            begin += len(piece)
            out[known[piece]] = self.walk([names[i] for i in known[piece]], sizes[piece])
        return out

    def walk(self, names: Sequence[str], sizes: np.ndarray) -> np.ndarray:
        points = np.frombuffer("".join(names).encode("utf-32-le"), "<u4")
        place = np.searchsorted(self.letters, points)
        place[place == len(self.letters)] = 0
        letter = np.where(self.letters[place] == points, place + 1, 0) if len(self.letters) else np.zeros(len(points), np.int64)
        ends = np.cumsum(sizes)
        state = np.zeros(len(names), np.int64)
        best = np.full(len(names), self.best[0])
        active = 0  # names rise in length, so those that go on are the last ones
        for k in range(int(sizes.max(initial=0))):
            active = int(np.searchsorted(sizes, k, "right"))
            state[active:] = self.step[state[active:], letter[ends[active:] - sizes[active:] + k]]
            best[active:] = np.minimum(best[active:], self.best[state[active:]])
        return best


def automaton(keywords: Sequence[str]) -> Automaton:
    """Of keywords in the order of their rules."""
    letters = np.array(sorted({ord(c) for k in keywords for c in k}), np.uint32)
    number = {int(c): i + 1 for i, c in enumerate(letters)}
    goto: list[dict[int, int]] = [{}]
    best = [NO_RULE]
    for rule, keyword in enumerate(keywords):
        at = 0
        for c in keyword:
            letter = number[ord(c)]
            if letter not in goto[at]:
                goto[at][letter] = len(goto)
                goto.append({})
                best.append(NO_RULE)
            at = goto[at][letter]
        best[at] = min(best[at], rule)
    step = np.zeros((len(goto), len(letters) + 1), np.int32)
    fail = [0] * len(goto)
    waiting = deque([0])
    while waiting:  # by depth: a state's fail state is done before it
        at = waiting.popleft()
        if at:
            step[at] = step[fail[at]]
            best[at] = min(best[at], best[fail[at]])
        for letter, to in goto[at].items():
            fail[to] = int(step[fail[at], letter]) if at else 0
            step[at, letter] = to
            waiting.append(to)
    return Automaton(letters, step, np.array(best, np.int64))


def table_bytes(rules: DataFrame, keyword: str) -> int:
    """Most bytes that the table of the rules can take: a state per character, a cell per state and letter."""
    chars, letters = rules.select(
        F.coalesce(F.sum(F.char_length(keyword)), F.lit(0)),
        F.lit(rules.select(F.explode(F.split(keyword, "")).alias("c")).distinct().count()),
    ).first()
    return 4 * (chars + 1) * (letters + 1)


def with_first_rule(
    rows: DataFrame, name: Column, rules: DataFrame, into: str, *, keyword: str = "keyword",
    priority: str = "priority", value: str = "role", most: int = TABLE_BYTES,
) -> DataFrame:
    """``rows`` with the ``value`` of the first rule whose keyword occurs in ``name``, both in upper case.

    Null names and names without a keyword have none. Of rules with one priority the one with the least
    keyword counts; an empty keyword is in every name. Null keywords and priorities are no rules.
    """
    given = rules.select(
        F.upper(keyword).alias("keyword"), F.col(priority).alias("priority"), F.col(value).cast("string").alias("value")
    ).where("keyword is not null and priority is not null")
    if table_bytes(given, "keyword") > most:
        return joined(rows, F.upper(name), given, into)
    ordered = given.orderBy("priority", "keyword", "value").collect()  # their table is within ``most``
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((automaton([r["keyword"] for r in ordered]), [r["value"] for r in ordered]))

    @F.pandas_udf("string")
    def first(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found, values = shared.value
        values = np.array([*values, None], object)
        for batch in batches:
            rule = found.first_rules([None if pd.isna(n) else n for n in batch])
            yield pd.Series(values[np.where(rule == NO_RULE, len(values) - 1, rule)])

    return rows.withColumn(into, first(F.upper(name)))


def substrings(name: Column, n: int) -> Column:
    """All parts of a name of ``n`` characters."""
    starts = F.sequence(F.lit(1), F.char_length(name) - n + 1)
    if n == 0:
        return F.array(F.lit(""))
    return F.when(F.char_length(name) >= n, F.transform(starts, lambda i: F.substring(name, i, F.lit(n)))).otherwise(
        F.array().cast("array<string>")
    )


def joined(rows: DataFrame, name: Column, given: DataFrame, into: str) -> DataFrame:
    """The same by a join, for rules of any number: each different name's substrings of the keywords' lengths
    with the rules, and the least of a name back to its rows."""
    one = Window.partitionBy("keyword").orderBy("priority", "value")
    first = given.withColumn("n", F.row_number().over(one)).where("n = 1").drop("n")
    sizes = sorted(r[0] for r in given.select(F.char_length("keyword")).distinct().collect())  # numbers of characters
    named = rows.select(name.alias("_name")).where("_name is not null").distinct()
    parts = [substrings(F.col("_name"), n) for n in sizes]
    inside = F.array_distinct(F.concat(*parts)) if parts else F.array().cast("array<string>")
    hits = named.select("_name", F.explode(inside).alias("keyword")).join(first, "keyword")
    best = hits.groupBy("_name").agg(F.min(F.struct("priority", "keyword", "value")).alias("_rule"))
    picked = best.select("_name", F.col("_rule.value").alias("_value"))
    out = rows.withColumn("_name", name).join(picked, "_name", "left")
    return out.select(*rows.columns, F.col("_value").alias(into))
