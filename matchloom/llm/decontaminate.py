"""Benchmark passages in documents, by Wu-Manber search over words.

A pattern is a window of consecutive item words; the alphabet is words. For patterns of one length
``m`` the search looks at the block of the two words that end at a position. The shift table says
how far the end can move at least before a pattern could end there (``m - 1`` for a block in no
pattern), so most words are never looked at. At shift 0 the block picks the bucket of patterns that
end in it, the first word of the window narrows it, and the whole window is compared.

Items shorter than a window give patterns of their own length; each length has its own tables.
Items go to the tasks in blocks of bounded text size, and each Python worker makes the tables of a
block for itself; documents pass the blocks one after the other, whole, without a shuffle. After
``PASS_BLOCKS`` blocks the documents with what was found so far are written to a table, so however
large the benchmark is, no task holds the tables of more blocks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from matchloom import workspace
from matchloom.llm.common import byte_size, free_name, small_batches, utf8

#: Words of a window.
WINDOW = 10
#: Most text bytes of the items in one broadcast block of tables (tables take about 50 times that).
BLOCK_BYTES = 4_000_000
#: Blocks that documents pass in one job.
PASS_BLOCKS = 4

#: Columns of the result.
RESULTS = {
    "n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean",
}

#: A-Z lower-cased; other ASCII than digits and letters separates words.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Patterns:
    """Shift table and buckets for patterns of one length."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.block = min(2, length)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[bytes, list[tuple[bytes, ...]]]] = {}
        self.items: dict[tuple[bytes, ...], set[str]] = {}

    def add(self, pattern: tuple[bytes, ...], item: str) -> None:
        if pattern in self.items:
            self.items[pattern].add(item)
            return
        self.items[pattern] = {item}
        for end in range(self.block, self.length + 1):
            block = pattern[end - self.block : end]
            self.shift[block] = min(self.shift.get(block, self.length), self.length - end)
        suffix = pattern[self.length - self.block :]
        self.bucket.setdefault(suffix, {}).setdefault(pattern[0], []).append(pattern)

    def find(self, text: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """Start and pattern of each occurrence."""
        length, block, shift = self.length, self.block, self.shift
        skip, end, size = length - block + 1, length, len(text)
        while end <= size:
            key = tuple(text[end - block : end])
            move = shift.get(key, skip)
            if move:
                end += move
                continue
            for pattern in self.bucket[key].get(text[end - length], ()):
                if tuple(text[end - length : end]) == pattern:
                    yield end - length, pattern
            end += 1


def tables(items: Iterable[tuple[str, bytes | None]], window: int) -> list[Patterns]:
    by_length: dict[int, Patterns] = {}
    for item, text in items:
        found = words(text)
        length = min(window, len(found))
        for start in range(len(found) - length + 1 if length else 0):
            held = by_length.setdefault(length, Patterns(length))
            held.add(tuple(found[start : start + length]), item)
    return list(by_length.values())


#: The tables that this process has made, by the name of their block.
MADE: dict[str, list[Patterns]] = {}


def made_once(name: str, shared: Broadcast, window: int) -> list[Patterns]:
    if name not in MADE:
        while len(MADE) >= PASS_BLOCKS:
            MADE.pop(next(iter(MADE)))
        MADE[name] = tables(shared.value, window)
    return MADE[name]


def scan(
    batches: Iterator[pa.RecordBatch], name: str, shared: Broadcast, window: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Adds the spans and items that one block of patterns finds to those found so far."""
    held = made_once(name, shared, window)
    for batch in batches:
        starts = batch.column("starts").to_pylist()
        ends = batch.column("ends").to_pylist()
        items = batch.column("items").to_pylist()
        for row, text in enumerate(utf8(batch.column("text"))):
            found = words(text)
            for patterns in held:
                for start, pattern in patterns.find(found):
                    starts[row].append(start)
                    ends[row].append(start + patterns.length)
                    items[row].extend(patterns.items[pattern])
            items[row] = sorted(set(items[row]), key=lambda x: (x is None, x))
        columns = [batch.column(name) for name in schema.names[:-3]]
        columns += [
            pa.array(values, schema.field(name).type)
            for name, values in (("starts", starts), ("ends", ends), ("items", items))
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def digest(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, hits = [], []
        for text, starts, ends in zip(
            utf8(batch.column("text")),
            batch.column("starts").to_pylist(),
            batch.column("ends").to_pylist(),
        ):
            counts.append(len(words(text)))
            hit, reached = 0, 0
            for start, end in sorted(zip(starts, ends)):
                if end > reached:
                    hit += end - max(start, reached)
                    reached = end
            hits.append(hit)
        items = batch.column("items").to_pylist()
        columns = [batch.column(name) for name in schema.names[:-5]]
        columns += [
            pa.array(counts, pa.int64()),
            pa.array(hits, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(i for i in x if i is not None).encode()).hexdigest() for x in items]),
            pa.array([hit > 0 for hit in hits]),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def blocks(benchmark: DataFrame, key: str, text: str, most: int, nameless: bool) -> Iterator[list]:
    """Items as lists of (id, UTF-8 text), each list of about ``most`` bytes or less, one item at least."""
    items = benchmark.where(F.col(text).isNotNull() & (F.lit(nameless) | F.col(key).isNotNull()))
    total = items.agg(F.sum(byte_size(F.col(text)))).first()[0] or 0
    parts = max(1, -(-total * 2 // most)) if total > most else 1
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64(key, text), F.lit(parts)) == part)
        yield [
            (row[0], row[1].encode())
            for row in mine.select(F.col(key).cast("string"), F.col(text)).toLocalIterator()
        ]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    keep: list[str],
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    nameless: bool = False,
) -> DataFrame:
    """One row per document: the columns ``keep``, then the counts of the contract.

    ``n_words``, ``n_hit`` (words inside any occurrence), ``n_items``, ``items_sha256`` and
    ``contaminated``, each with an underscore more if ``keep`` has the name. Null and empty texts
    have no words; items without text or words have no windows. With ``nameless`` items without an id
    are searched too: together they count as one in ``n_items`` and are in no ``items_sha256``; else
    they are left out. Repeated rows each get their row. A null or empty benchmark finds nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    none = "cast(array() as array<{}>)"
    rows = docs.select(
        *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)],
        F.col(text).cast("string").alias("text"),
        F.expr(none.format("int")).alias("starts"),
        F.expr(none.format("int")).alias("ends"),
        F.expr(none.format("string")).alias("items"),
    )
    arrow = to_arrow_schema(rows.schema)
    passed: list[Broadcast] = []
    for items in blocks(benchmark, item, item_text, block_bytes, nameless):
        if len(passed) == PASS_BLOCKS:
            rows = workspace.stored(rows, "scanned")
            while passed:
                passed.pop().destroy()
        passed.append(spark.sparkContext.broadcast(items))
        step = partial(scan, name=uuid.uuid4().hex, shared=passed[-1], window=window, schema=arrow)
        rows = rows.mapInArrow(step, rows.schema)
    kept = rows.select(*[f"keep_{i}" for i in range(len(keep))])
    out = kept.schema
    for name, kind in RESULTS.items():
        out = out.add(name, kind)
    made = rows.mapInArrow(partial(digest, schema=to_arrow_schema(out)), out)
    names = {name: free_name(docs.select(keep), name) for name in RESULTS}
    # By position: the names kept may be those of the results.
    return made.toDF(*keep, *names.values())
