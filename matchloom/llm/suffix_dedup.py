"""Repeated byte strings across a corpus, by sorting the suffixes that can repeat.

A string of ``LENGTH`` bytes is a suffix cut at that length; it repeats if a neighbour in suffix order
has the same bytes. No task can hold all suffixes, so they are dealt by content: a suffix goes to the
least hash of the ``k``-byte grams inside it, which equal strings share. Consecutive suffixes with the
same least gram, in the same place, are one run and travel as one stretch of text.

1. Runs whose gram is met once in the corpus are done: nothing in them repeats. This takes 28 bytes
   for a run, about one run for 85 bytes, and no text. Runs that follow each other and are the same
   stretch, as in periodic text, are one row with their number.
2. Runs of one gram that are all the same stretch repeat as a whole.
3. Of the others each distinct stretch is fetched once. The suffixes of a gram's stretches are sorted
   deep-shallow: a multikey quicksort by 8-byte characters parts every open segment around a pivot of its
   own into less, equal and greater, the equal ones going on with the next character, to ``SHALLOW`` bytes;
   one pass of array operations parts all segments at once. What is still together has a long common
   prefix and goes into blind tries, which compare each suffix with one other.
4. A gram with more than ``GROUP`` different stretches is not sorted in one task. Its stretches are
   dealt again by longer grams, at last by whole strings, of which no two stretches differ.

Positions come back as spans by joins on the stretch and on the row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm.common import small_batches
from matchloom.llm.shingles import BASE, INVERSE, mix, powers

#: Bytes of a string that counts as repeated.
LENGTH = 200
#: Bytes of the grams by which suffixes are dealt, and dealt again where a gram is too frequent.
GRAMS = (32, 128, LENGTH)
#: Depth of the shallow sort.
SHALLOW = 40
#: Most different stretches of a gram that one task sorts.
GROUP = 1024
#: Suffixes sorted at once.
CHUNK = 300_000
#: Most spans that are broadcast, 8 bytes each beside their rows.
BROADCAST_SPANS = 2_000_000

BYTE = np.random.default_rng(23).integers(0, 2**64, 256, dtype=np.uint64)


def runs(text: bytes, gram: int) -> tuple[np.ndarray, ...]:
    """First suffix, number of suffixes, gram hash, stretch hash and times in a row of each run of a text."""
    data = np.frombuffer(text, np.uint8)
    suffixes = len(data) - LENGTH + 1
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * powers(BASE, len(data)))))
    back = powers(INVERSE, len(data))
    hashes = mix((total[gram:] - total[:-gram]) * back[: len(data) - gram + 1])
    width, have, least = LENGTH - gram + 1, 1, hashes
    while have < width:  # least of `have` grams from each position on, doubled
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    # A run ends with its gram's first place in the suffix, so two suffixes of a run never are equal.
    starts = np.flatnonzero(
        np.concatenate(([True], (least[1:] != least[:-1]) | (hashes[: suffixes - 1] == least[:-1])))
    )
    counts = np.diff(np.concatenate((starts, [suffixes])))
    ends = starts + counts + LENGTH - 1
    stretch = mix((total[ends] - total[starts]) * back[starts] + counts.astype(np.uint64))
    grams = least[starts]
    first = np.concatenate(
        ([True], (grams[1:] != grams[:-1]) | (stretch[1:] != stretch[:-1]) | (counts[1:] != counts[:-1]))
    )
    times = np.diff(np.concatenate((np.flatnonzero(first), [len(starts)])))
    return starts[first], counts[first], grams[first].view(np.int64), stretch[first].view(np.int64), times


def find_runs(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    names = ["r1", "r2", "start", "n", "gram", "stretch", "times"]
    for batch in batches:
        rows, found = [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            if text is not None and len(text) >= LENGTH:
                found.append(runs(text, gram))
                rows.append(np.full(len(found[-1][0]), row))
        if found:
            at = pa.array(np.concatenate(rows))
            starts, counts, grams, stretches, times = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("r1").take(at), batch.column("r2").take(at),
                    pa.array(starts.astype(np.int32)), pa.array(counts.astype(np.int32)),
                    pa.array(grams), pa.array(stretches), pa.array(times.astype(np.int32)),
                ],
                names=names,
            )


class BlindTrie:
    """Patricia trie of strings of one length that share a prefix.

    Nodes know how many bytes all strings below them share, and branch on the next byte. A string is
    first led blindly to some leaf, compared with that leaf alone, and put where they part.
    """

    def __init__(self, first: bytes, name: int) -> None:
        self.root: list = [first, [name]]  # leaf: string and names; node: depth, children, any leaf

    def add(self, string: bytes, name: int) -> None:
        node = self.root
        while len(node) == 3:
            node = node[1].get(string[node[0]], node[2])
        if node[0] == string:
            node[1].append(name)
            return
        other = node[0]
        apart = int.from_bytes(string, "big") ^ int.from_bytes(other, "big")
        depth = len(string) - (apart.bit_length() + 7) // 8
        parent, node = None, self.root
        while len(node) == 3 and node[0] < depth:
            parent, node = node, node[1][string[node[0]]]
        leaf = [string, [name]]
        if len(node) == 3 and node[0] == depth:
            node[1][string[depth]] = leaf
            return
        split = [depth, {string[depth]: leaf, other[depth]: node}, leaf]
        if parent is None:
            self.root = split
        else:
            parent[1][string[parent[0]]] = split

    def leaves(self) -> Iterator[list[int]]:
        """The names of each distinct string, in order of the strings."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if len(node) == 2:
                yield node[1]
            else:
                stack.extend(node[1][byte] for byte in sorted(node[1], reverse=True))


def median_of_three(characters: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The middle one of the first, the middle and the last character of each segment."""
    a, b, c = (characters[begin + at] for at in (0, size // 2, size - 1))
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def shallow_sort(data: np.ndarray, at: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share ``SHALLOW`` bytes with another of their segment, those that do side by side, and
    the number of each such group. ``segment`` rises."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    order = np.arange(len(at), dtype=np.int32)
    depth = np.zeros(len(at), np.int32)
    new = np.concatenate(([True], segment[1:] != segment[:-1]))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    groups = 0
    while True:
        begin = np.flatnonzero(new)
        size = np.diff(np.concatenate((begin, [len(order)])))
        # A suffix alone in its segment is in its place; one that shares enough goes to the deep phase.
        deep = (size > 1) & (depth[begin] >= SHALLOW)
        if deep.any():
            done.append((order[np.repeat(deep, size)], np.repeat(np.arange(groups, groups + int(deep.sum())), size[deep])))
            groups += int(deep.sum())
        left = (size > 1) & ~deep
        if not left.any():
            break
        rows = np.repeat(left, size)
        order, depth, size = order[rows], depth[rows], size[left]
        begin = np.cumsum(size) - size
        of = np.repeat(np.arange(len(size), dtype=np.int32), size)
        characters = words[at[order] + depth].view(">u8").ravel().astype(np.uint64)
        pivot = median_of_three(characters, begin, size)[of]
        less, equal = characters < pivot, characters == pivot
        # Where each suffix goes: behind those of its part before it, and behind the parts before its own.
        n_less, n_equal = np.add.reduceat(less, begin, dtype=np.int32), np.add.reduceat(equal, begin, dtype=np.int32)
        rank_less, rank_equal = np.cumsum(less, dtype=np.int32) - less, np.cumsum(equal, dtype=np.int32) - equal
        rank_less -= rank_less[begin][of]
        rank_equal -= rank_equal[begin][of]
        first = begin.astype(np.int32)[of]
        up_to = n_less[of]
        greater = np.arange(len(order), dtype=np.int32) - rank_less - rank_equal + up_to + n_equal[of]
        place = np.where(less, first + rank_less, np.where(equal, first + up_to + rank_equal, greater))
        parted, deeper = np.empty_like(order), np.empty_like(depth)
        parted[place], deeper[place] = order, depth + 8 * equal
        order, depth = parted, deeper
        new = np.zeros(len(order), bool)
        new[begin] = True
        for ahead in (begin + n_less, begin + n_less + n_equal):
            new[ahead[ahead < len(order)]] = True
    if not done:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([o for o, _ in done]), np.concatenate([g for _, g in done])


def together(data: np.ndarray, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Which suffixes of a segment, cut at ``LENGTH``, equal another of the same segment.

    ``data`` holds the stretches one after the other, ``at`` where each suffix begins.
    """
    repeats = np.zeros(len(at), bool)
    order, segment = shallow_sort(data, at, segment)
    if not len(order):
        return repeats
    edges = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1], [True]))).tolist()
    whole, places, names = data.tobytes(), at[order].tolist(), order.tolist()
    for begin, end in zip(edges, edges[1:]):
        string = whole[places[begin] : places[begin] + LENGTH]
        if end - begin == 2:  # a trie of two is their comparison
            if string == whole[places[begin + 1] : places[begin + 1] + LENGTH]:
                repeats[names[begin]] = repeats[names[begin + 1]] = True
            continue
        trie = BlindTrie(string, names[begin])
        for i in range(begin + 1, end):
            trie.add(whole[places[i] : places[i] + LENGTH], names[i])
        for leaf in trie.leaves():
            if len(leaf) > 1:
                repeats[leaf] = True
    return repeats


def sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated parts of stretches, from rows ordered by gram: ``gram, stretch, copies, text``."""
    held: list[tuple] = []
    waiting = 0

    def made(rows: list[tuple]) -> pa.RecordBatch:
        lengths = np.array([len(r[3]) for r in rows])
        counts = lengths - LENGTH + 1
        begins = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(r[3] for r in rows) + bytes(SHALLOW + 8), np.uint8)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        _, group = np.unique(np.array([r[0] for r in rows]), return_inverse=True)
        hits = together(data, np.repeat(begins, counts) + within, np.repeat(group, counts))
        hits |= np.repeat(np.array([r[2] > 1 for r in rows]), counts)
        owner = np.repeat(np.arange(len(rows)), counts)
        on = np.concatenate(([False], hits, [False]))
        row = np.concatenate(([-1], owner, [-1]))
        first = np.flatnonzero(on[1:-1] & (~on[:-2] | (row[:-2] != row[1:-1])))
        last = np.flatnonzero(on[1:-1] & (~on[2:] | (row[2:] != row[1:-1])))
        whose = owner[first]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.array([r[0] for r in rows])[whose]),
                pa.array(np.array([r[1] for r in rows])[whose]),
                pa.array(within[first].astype(np.int32)),
                pa.array((within[last] + LENGTH).astype(np.int32)),
            ],
            names=["gram", "stretch", "from", "to"],
        )

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("gram", "stretch", "copies", "text"))):
            if waiting > CHUNK and row[0] != held[-1][0]:
                yield made(held)
                held, waiting = [], 0
            held.append(row)
            waiting += len(row[3]) - LENGTH + 1
    if held:
        yield made(held)


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted stretches of each text."""
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            for w in wanted:
                end = w["start"] + w["n"] + LENGTH - 1
                out.append((w["gram"], w["stretch"], w["copies"], text[w["start"] : end]))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["gram", "stretch", "copies", "text"],
            )


def few(rows: DataFrame, counted: int) -> DataFrame:
    return F.broadcast(rows) if counted <= BROADCAST_SPANS else rows


def repeats(texts: DataFrame, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """Spans ``r1, r2, from, to`` of bytes in strings that start anywhere else too.

    ``texts``: ``r1, r2, text`` (binary), the same rows each time they are read.
    """
    small_batches(texts.sparkSession)
    all_runs = texts.mapInArrow(
        partial(find_runs, gram=grams[0]), "r1 long, r2 long, start int, n int, gram long, stretch long, times int"
    )
    met = (
        all_runs.groupBy("gram")
        .agg(F.sum("times").alias("met"), F.min("stretch").alias("lo"), F.max("stretch").alias("hi"))
        .where("met > 1")
        .select("gram", (F.col("lo") != F.col("hi")).alias("differ"))
    )
    # Stored, so that the join has a shuffle of its own, in which a frequent gram can be split.
    met = workspace.stored(all_runs.join(workspace.stored(met, "met"), "gram"), "runs")
    spans = met.where("not differ").select(
        "r1", "r2", F.col("start").alias("from"), (F.col("start") + F.col("times") * F.col("n") + LENGTH - 1).alias("to")
    )

    mixed = met.where("differ")
    stretches = workspace.stored(
        mixed.groupBy("gram", "stretch").agg(
            F.sum("times").alias("copies"), *[F.first(c).alias(c) for c in ("r1", "r2", "start", "n")]
        ),
        "stretches",
    )
    size = stretches.count()
    if not size:
        return spans
    wanted = stretches.groupBy("r1", "r2").agg(
        F.collect_list(F.struct("gram", "stretch", "copies", "start", "n")).alias("wanted")  # of one text
    )
    fetched = texts.join(few(wanted, size), ["r1", "r2"])
    content = workspace.stored(
        fetched.select("text", "wanted").mapInArrow(cut, "gram long, stretch long, copies long, text binary"), "content"
    )
    crowded = workspace.stored(
        stretches.groupBy("gram").agg(F.count("*").alias("different")).where(F.col("different") > GROUP).select("gram"), "crowded"
    )
    parts = "gram long, stretch long, from int, to int"
    found = (
        content.join(crowded, "gram", "left_anti").repartition("gram").sortWithinPartitions("gram").mapInArrow(sorted_groups, parts)
    )
    if not crowded.isEmpty():
        again = content.join(crowded, "gram", "left_semi")
        deeper = repeats(again.select(F.col("gram").alias("r1"), F.col("stretch").alias("r2"), "text"), grams[1:])
        whole = again.where("copies > 1").select("gram", "stretch", F.lit(0).alias("from"), F.length("text").alias("to"))
        found = found.unionByName(deeper.select(F.col("r1").alias("gram"), F.col("r2").alias("stretch"), "from", "to")).unionByName(whole)
    # A stretch that follows itself repeats as a whole, so its span goes on to the end of the last one.
    end = F.col("start") + (F.col("times") - 1) * F.col("n") + F.col("to")
    back = mixed.join(found, ["gram", "stretch"]).select("r1", "r2", (F.col("start") + F.col("from")).alias("from"), end.alias("to"))
    return spans.unionByName(back)


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching spans of a row as one."""
    for batch in batches:
        begins, ends = [], []
        for spans in batch.column("spans").to_pylist():
            mine: list[list[int]] = []
            for begin, end in sorted((s["from"], s["to"]) for s in spans):
                if mine and begin <= mine[-1][1]:
                    mine[-1][1] = max(mine[-1][1], end)
                else:
                    mine.append([begin, end])
            begins.append([m[0] for m in mine])
            ends.append([m[1] for m in mine])
        yield pa.RecordBatch.from_arrays(
            [batch.column("r1"), pa.array(begins, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
            names=["r1", "begins", "ends"],
        )


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``row``, ``data`` (UTF-8 bytes) and the byte offsets ``begins``, ``ends`` to remove.

    ``docs`` must give the same rows in the same partitions each time it is read, as a table does.
    Rows without repeats have null offsets.
    """
    rows = docs.select(
        F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b"")).alias("text"),
        *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(docs.columns)],
        F.monotonically_increasing_id().alias("r1"),
        F.lit(0).cast("long").alias("r2"),
    )
    spans = repeats(rows.select("r1", "r2", "text"))
    merged = workspace.stored(
        spans.groupBy("r1")
        .agg(F.collect_list(F.struct("from", "to")).alias("spans"))  # of one text
        .mapInArrow(merge, "r1 long, begins array<int>, ends array<int>"),
        "spans",
    )
    size = merged.agg(F.sum(F.size("begins"))).first()[0] or 0
    return rows.join(few(merged, size), "r1", "left")


def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for data, begins, ends in zip(*(batch.column(n).to_pylist() for n in ("text", "begins", "ends"))):
            kept, last, removed = sha256(), 0, 0
            for begin, end in zip(begins or (), ends or ()):
                kept.update(data[last:begin])
                removed += end - begin
                last = end
            kept.update(data[last:])
            out.append((len(data), removed, len(begins or ()), kept.hexdigest()))
        columns = list(zip(*out)) if out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Null and empty texts have no bytes. Repeated rows are occurrences like any other, so a text that
    is there twice and has ``LENGTH`` bytes or more is removed in both.
    """
    rows = repeated_spans(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("whole")), "whole")
    kind = docs.select(F.col(key)).dtypes[0][1]
    return rows.select(F.col("keep_0").alias("doc_id"), "text", "begins", "ends").mapInArrow(
        summary, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs``, repeated bytes taken out of the text; broken characters are replaced."""
    rows = repeated_spans(docs, text)
    whole = F.lit(0).cast("int")
    starts = F.concat(F.array(whole), F.coalesce("ends", F.expr("cast(array() as array<int>)")))
    stops = F.concat(F.coalesce("begins", F.expr("cast(array() as array<int>)")), F.array(F.octet_length("text")))
    left = F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda p: F.hex(F.substring(F.col("text"), p["a"] + 1, p["b"] - p["a"])))
    clean = F.decode(F.unhex(F.array_join(left, "")), "UTF-8")
    return rows.select(
        *[
            (F.when(F.col(f"keep_{i}").isNotNull(), clean) if c == text else F.col(f"keep_{i}")).alias(c)
            for i, c in enumerate(docs.columns)
        ]
    )
