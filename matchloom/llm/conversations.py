"""Conversations repaired to ``system? (user assistant)+`` by their cheapest edits.

Each row is kept, given another role, or deleted, and empty rows are inserted, at fixed costs. The cheapest
edits are found over four states (the start, after a system, a user, an assistant row). From the last
row to the first a vector holds what each state still costs. Inserting links the states, so vectors less
their least component are few, and the Four-Russians method applies: for every such normalised vector and
every block of ``BLOCK`` symbols a table has the vector before the block and the cost to add. Whole blocks are
looked up; only the vectors between them are held. Then blocks are expanded the way back, from the first
row to the last, and at each row the least letter is taken that is still on a cheapest way, so ties are
settled by the whole audit and not by the order in which a table was filled.

Rows become narrow for this: role's initial, faults and a digest, alike rows of a turn as one with a count. A
conversation's symbols are a byte a row, as long as the audit that is returned. The texts pass by once,
sorted, behind the audit of their conversation; no conversation's texts are held.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.llm.common import pieces

#: Costs of the edits; a truncated row that is not deleted costs more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Symbols in a block: 9 ** BLOCK blocks for each vector.
BLOCK = 4

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The only state that a new row can lead to.
NEXT = (USER, USER, ASSISTANT, USER)
#: A symbol: 0 must be deleted; then a role (system, user, assistant, other), whole or truncated.
SYMBOLS, OTHER = 9, 3
INITIALS = {"s": 0, "u": 1, "a": 2}
UNREACHED = 1 << 20


def symbol(role: int, truncated: bool) -> int:
    return 1 + role + 4 * truncated


def kept_to(state: int, of: int) -> int | None:
    """The state after a kept row, if its role may stand there."""
    role = (of - 1) % 4
    if of == 0 or role == OTHER:
        return None
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if state == USER else None


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    start, system, user, assistant = costs
    u, a = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(start, INSERT + u), min(system, INSERT + u), u, a


def before(after: tuple[int, ...], of: int) -> tuple[int, ...]:
    """Costs of each state before a row, from those after it."""
    more = TRUNCATED if of > 4 else 0
    costs = []
    for state in range(4):
        ways = [DELETE + after[state]]
        if of:
            ways.append(REROLE + more + after[NEXT[state]])
            kept = kept_to(state, of)
            if kept is not None:
                ways.append(more + after[kept])
        costs.append(min(ways))
    return with_inserts(costs)


END = with_inserts([0, UNREACHED, UNREACHED, 0])


class Tables:
    """All normalised vectors, the steps between them, and the steps of whole blocks."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [END]
        number = {END: 0}
        steps: list[list[tuple[int, int]]] = []
        while len(steps) < len(self.vectors):
            row = []
            for of in range(SYMBOLS):
                made = before(self.vectors[len(steps)], of)
                least = min(made)
                vector = tuple(c - least for c in made)
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                row.append((number[vector], least))
            steps.append(row)
        self.to = np.array([[v for v, _ in row] for row in steps])
        self.added = np.array([[c for _, c in row] for row in steps])
        blocks = np.arange(SYMBOLS**block)
        to = np.repeat(np.arange(len(steps))[:, None], len(blocks), axis=1)
        added = np.zeros_like(to)
        for place in range(block):  # from the last symbol, which is the lowest digit
            digit = blocks // SYMBOLS**place % SYMBOLS
            added += self.added[to, digit]
            to = self.to[to, digit]
        self.block_to, self.block_added = to.tolist(), added.tolist()
        self.expanded: dict[tuple[int, bytes, int], tuple[str, int]] = {}

    def expand(self, after: int, symbols: bytes, state: int) -> tuple[str, int]:
        """Edits of a block entered in ``state``, with the vector behind it, and the state they lead to."""
        found = self.expanded.get((after, symbols, state))
        if found:
            return found
        ways = [after]
        for of in reversed(symbols):
            ways.append(int(self.to[ways[-1], of]))
        ways.reverse()
        letters, now = [], state
        for i, of in enumerate(symbols):
            here, then = self.vectors[ways[i]], self.vectors[ways[i + 1]]
            added = int(self.added[ways[i + 1], of])
            more = TRUNCATED if of > 4 else 0
            while True:
                left = here[now] + added
                kept = kept_to(now, of)
                if DELETE + then[now] == left:  # in the order of the letters
                    letters.append("D")
                elif INSERT + here[NEXT[now]] == here[now]:
                    letters.append("I")
                    now = NEXT[now]
                    continue
                elif kept is not None and more + then[kept] == left:
                    letters.append("K")
                    now = kept
                else:
                    letters.append("R")
                    now = NEXT[now]
                break
        self.expanded[after, symbols, state] = "".join(letters), now
        return self.expanded[after, symbols, state]

    def audit(self, symbols: bytes) -> tuple[int, str]:
        """Least cost and the least audit of that cost."""
        whole = len(symbols) // self.block * self.block
        cost, vector = 0, 0
        for of in reversed(symbols[whole:]):
            cost, vector = cost + int(self.added[vector, of]), int(self.to[vector, of])
        digits = np.frombuffer(symbols, np.uint8, whole).reshape(-1, self.block).astype(np.int64)
        numbers = digits @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))
        last = vector
        behind = array("i")
        for number in numbers[::-1].tolist():
            behind.append(vector)
            cost, vector = cost + self.block_added[vector][number], self.block_to[vector][number]
        cost += self.vectors[vector][START]
        state, out = START, []
        for i, after in enumerate(reversed(behind)):
            letters, state = self.expand(after, symbols[i * self.block : (i + 1) * self.block], state)
            out.append(letters)
        # The rest behind the last whole block, from its own end.
        assert not behind or last == behind[0]
        letters, state = self.expand(0, symbols[whole:], state)
        out.append(letters)
        while END[state]:
            out.append("I")
            state = NEXT[state]
        return cost, "".join(out)


@cache
def tables() -> Tables:
    return Tables()


def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def truncated(text: Column) -> Column:
    """Whether the last character that isn't white space ends no sentence."""
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def plain(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, digest``: nulls of role and text are one space."""
    made = rows.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    return made.withColumn("digest", F.md5("text"))


#: Rows of a conversation: by turn, nulls first, then by role and the digest of the text.
ORDER = ("turn", "role", "digest")


def narrow(rows: DataFrame) -> DataFrame:
    """One row for alike rows of a turn: ``conv, turn, role, digest, n``, their faults, whether the first
    of them is the first of its role and text, and the role's initial."""
    keys = ["conv", "turn", "role", "digest"]
    counted = rows.groupBy(*keys, blank(F.col("text")).alias("blank"), truncated(F.col("text")).alias("truncated")).agg(
        F.count("*").alias("n")
    )
    first = counted.groupBy(F.col("conv").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))["turn"].alias("f_turn")
    )
    same = (
        F.col("conv").eqNullSafe(F.col("f_conv"))
        & (F.col("role") == F.col("f_role"))
        & (F.col("digest") == F.col("f_digest"))
    )
    return counted.join(first, same).select(
        *keys, "blank", "truncated", "n",
        F.col("turn").eqNullSafe(F.col("f_turn")).alias("first"),
        F.substring("role", 1, 1).alias("initial"),
    )


MEASURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LEGAL = {"su", "ua", "au"}


class Faults:
    """What is counted of one conversation while its narrow rows pass by."""

    def __init__(self):
        self.symbols: list[bytes] = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.least, self.most = 0, None, None
        self.initial = None

    def add(self, turn: int | None, initial: str, n: int, is_blank: bool, is_first: bool, is_cut: bool) -> None:
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1  # copies stand beside each other
        self.initial = initial
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        if is_blank:
            self.blank += n
            self.symbols.append(bytes(n))
            return
        gone = n - is_first
        self.duplicate += gone
        if is_first:
            self.truncated += is_cut
            self.symbols.append(bytes([symbol(INITIALS.get(initial, OTHER), is_cut)]))
        if gone:
            self.symbols.append(bytes(gone))

    def result(self) -> tuple:
        cost, audit = tables().audit(b"".join(self.symbols))
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def by_conversation(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    """``(conv, is it the first row of a conversation, values)`` of rows sorted by conversation."""
    last: list = []
    for batch in batches:
        for conv, *values in zip(batch.column("conv").to_pylist(), *(batch.column(c).to_pylist() for c in names)):
            yield conv, last != [conv], values
            last = [conv]


def streamed(rows: DataFrame, function: Callable, schema: T.StructType) -> DataFrame:
    return rows.mapInArrow(function, schema)


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row per conversation: ``conv``, the measures, and ``audit``, the initials of its edits in order.

    ``ids``: conversations (``conv_id``) that are returned even if they have no rows.
    """
    kind = rows.schema["conv_id"].dataType
    sent = narrow(plain(rows)).select("conv", "turn", "role", "digest", "n", "blank", "truncated", "first", "initial")
    if ids is not None:
        empty = ids.select(F.col("conv_id").alias("conv")).distinct()
        named = [F.lit(None).cast(f.dataType).alias(f.name) for f in sent.schema.fields[1:]]
        sent = sent.unionByName(empty.select("conv", *named))
    schema = T.StructType(
        [T.StructField("conv", kind), *[T.StructField(m, T.LongType()) for m in MEASURES], T.StructField("audit", T.StringType())]
    )
    arrow = pa.schema([(m, pa.int64()) for m in MEASURES] + [("audit", pa.string())])

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, done, open_ = None, [], None

        def sent_on() -> pa.RecordBatch:
            convs = pa.array([c for c, _ in done], conv_type)
            columns = zip(*(values for _, values in done))
            made = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
            return pa.RecordBatch.from_arrays([convs, *made], ["conv", *arrow.names])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field("conv").type
                yield batch

        size = 0
        for conv, new, (turn, initial, n, is_blank, is_first, is_cut) in by_conversation(
            typed(), ("turn", "initial", "n", "blank", "first", "truncated")
        ):
            if new:
                if open_:
                    done.append((open_[0], open_[1].result()))
                    size += len(done[-1][1][-1])
                    if len(done) >= 4096 or size > 8 << 20:
                        yield sent_on()
                        done, size = [], 0
                open_ = conv, Faults()
            if n is not None:
                open_[1].add(turn, initial, n, is_blank, is_first, is_cut)
        if open_:
            done.append((open_[0], open_[1].result()))
            yield sent_on()

    ordered = sent.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "digest")
    return streamed(ordered, audit, schema)


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of each row that is left or new, from the edits and the rows in order."""
    state = START
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield NAMES[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = kept_to(state, symbol(INITIALS[role[:1]], False))
            yield role, text
        elif letter == "R":
            state = NEXT[state]
            yield NAMES[state], text


def behind_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Conversations' audits, each followed by the rows in order."""
    texts = plain(rows)
    audits_ = found.select(
        "conv", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("digest"), F.col("audit").alias("text"), *MEASURES,
    )
    none = [F.lit(None).cast("long").alias(m) for m in MEASURES]
    both = texts.select("conv", F.lit(1).alias("part"), "turn", "role", "digest", "text", *none).unionByName(audits_)
    return both.repartition("conv").sortWithinPartitions("conv", "part", F.asc_nulls_first("turn"), "role", "digest")


def conversations(batches: Iterator[pa.RecordBatch], names: tuple[str, ...] = ()) -> Iterator[tuple]:
    """``(conv, audit, values, rows)`` of each conversation; take all rows of one before the next."""
    source = by_conversation(pieces(batches, "text", 8 << 20), ("role", "text", *names))
    ahead = next(source, None)

    def rows() -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while (ahead := next(source, None)) is not None and not ahead[1]:
            yield ahead[2][0], ahead[2][1]

    while ahead is not None:
        conv, _, (_, audit, *values) = ahead
        left = rows()
        yield conv, audit, values, left
        for _ in left:
            pass


def repaired(rows: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id, place, role, text``; ``place`` counts from 0.

    ``rows``: ``conv_id, turn, role, text``; other columns are not read. Null roles and texts are one space, a
    null id is an id, null turns come first. Rows of one turn are in the order of role and of the MD5 of
    the text, so repeated rows stand together. A role counts by its first character; an empty one is none
    of the three. A conversation that loses all rows has none here.
    """
    schema = T.StructType(
        [
            T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("place", T.LongType()),
            T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
        ]
    )

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type = pa.null()

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field("conv").type
                yield batch

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*held))
            types = [conv_type, pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], schema.names)

        held, size = [], 0
        for conv, audit, _, left in conversations(typed()):
            for place, (role, text) in enumerate(edited(audit, left)):
                held.append((conv, place, role, text))
                size += len(text)
                if len(held) >= 4096 or size > 8 << 20:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    return streamed(behind_audits(rows, audits(rows)), repair, schema)


def report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row per conversation: ``conv_id``, the measures of its faults, cost and audit of its repair, and
    ``repaired_sha256`` of the repaired ``role:text`` lines. ``ids`` and odd rows as in ``audits`` and
    ``repaired``; without rows all is zero, with an empty audit."""
    schema = T.StructType(
        [
            T.StructField("conv_id", rows.schema["conv_id"].dataType), *[T.StructField(m, T.LongType()) for m in MEASURES],
            T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
        ]
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field("conv").type, *[pa.int64()] * len(MEASURES), pa.string(), pa.string()]

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], schema.names)

        held, size = [], 0
        for conv, audit, values, left in conversations(chain([first], batches), MEASURES):
            sha, between = hashlib.sha256(), b""
            for role, text in edited(audit, left):
                sha.update(between + f"{role}:{text}".encode())
                between = b"\n"
            held.append((conv, *values, audit, sha.hexdigest()))
            size += len(audit)
            if len(held) >= 4096 or size > 8 << 20:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    return streamed(behind_audits(rows, audits(rows, ids)), digests, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by the checksum of ``conv_id:turn``, modulo 20: 0
    drops a row, 1 empties its text, 2 removes what ends sentences, 3 repeats it, 4 makes it a user's.
    Nulls are one space in the checksum, in roles and in texts."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    copies = F.when(F.col("kind") == 0, F.array().cast("array<int>")).when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    made = rows.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("kind"))
    return made.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")
