"""Near-duplicate documents by SetSketch registers.

Every shingle of a document spreads exponentially distributed values over the registers, one in each
of the truncated intervals of [0, inf), so that its values come in rising order and a sketch is done
when the next interval lies above all its minima. A register holds the logarithm of its minimum: it
depends on the set alone, sketches of parts merge by taking the maximum, and two sets agree in a
register with about the probability of their Jaccard similarity.

1. Documents of the same set are one class, named by its least id. Only classes go on.
2. Bands of registers give bucket keys (``BANDS`` bands of ``ROWS``; a pair at 0.75 is missed with
   probability 5e-6). Buckets with the same members are looked at once.
3. In a bucket, registers are compared in blocks of bounded size, several tasks for a large bucket.
   A pair's similarity is the maximum of the joint likelihood of the registers that are above, below
   and equal, given both set sizes. Pairs far below the limit, five deviations, are left.
4. Links are confirmed on the full sets, in three rounds: each member with the centre of its family in the
   bucket; then with its likeliest partner in another component; then every likely pair that is still
   in different components. A group of copies is one component after the first round and has no pairs
   in the others. The first round looks for ``CENTRES`` centres in a block and leaves the rest to the
   others. An id that repeats with other texts joins the classes of all of them. The last round confirms
   inside the task that finds the pair, in one of the buckets the two share, and gives out links only, so no
   pairs travel and no link is lost; a row goes there once for each block of its bucket, with its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm.common import bounded, pieces, small_batches, utf8
from matchloom.llm.components import components
from matchloom.llm.shingles import mix, sets, shared

#: Link documents with 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Bands and registers of a band. Their product is a power of two.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Base of the logarithm and rate of the exponential values.
LOG_BASE, RATE = 1.001, 20.0
#: Likelihood estimates from here on are confirmed: five deviations of an estimate below 0.75.
LIKELY = 0.55
#: Rows of a bucket in one block; a task compares two blocks. Of a block when centres are looked for.
BLOCK, CENTRE_BLOCK = 2048, 16384
#: Centres that are looked for in a block. Members without one are compared in the later rounds.
CENTRES = 64
#: Rows of a family are at least so near its centre, in equal registers.
FAMILY = 0.7
#: Text bytes sketched at once; a task needs about 100 times that.
PIECE = 250_000

#: Where each interval of values begins: the quantiles of the exponential distribution.
INTERVAL = -np.log1p(-np.arange(REGISTERS) / REGISTERS) / RATE
SPAN = np.concatenate((-np.expm1(-RATE * np.diff(INTERVAL)), [1.0]))


def registers(elements: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes, as 16-bit registers."""
    least = np.full(REGISTERS, np.inf)
    base = mix(elements)
    step, offset = (base & np.uint64(REGISTERS // 2 - 1)) * np.uint64(2) + np.uint64(1), base >> np.uint64(40)
    together = max(1, 1024 // max(1, len(elements)))
    for begin in range(0, REGISTERS, together):
        level = np.arange(begin, min(begin + together, REGISTERS), dtype=np.uint64)[:, None]
        drawn = mix(elements + (level + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
        share = (drawn >> np.uint64(11)).astype(float) * 2.0**-53
        at = level[:, 0].astype(int)
        values = INTERVAL[at][:, None] - np.log1p(-share * SPAN[at][:, None]) / RATE
        # Each element visits every register once: an odd step over a power of two.
        where = (step * level + offset) & np.uint64(REGISTERS - 1)
        np.minimum.at(least, where.astype(np.intp).ravel(), values.ravel())
        if at[-1] + 1 < REGISTERS and least.max() <= INTERVAL[at[-1] + 1]:
            break
    return np.floor(1 - np.log(least) / np.log(LOG_BASE)).clip(0, 65535).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sketched sets."""
    return np.maximum(a, b)


GRID = np.linspace(0, 1, 101)


def likelihood(above: np.ndarray, below: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of pairs with the greatest joint likelihood.

    ``above`` and ``below`` are how many registers of the first are greater and less than the
    second's; ``n`` and ``m`` the sizes of the sets.
    """
    u = (n / (n + m))[:, None]
    v = 1 - u

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x.clip(0) * (LOG_BASE - 1) / LOG_BASE) / np.log(LOG_BASE)

    over, under = chance(u - v * GRID), chance(v - u * GRID)
    equal = (1 - over - under).clip(1e-12)
    score = (
        above[:, None] * np.log(over.clip(1e-12))
        + below[:, None] * np.log(under.clip(1e-12))
        + (REGISTERS - above - below)[:, None] * np.log(equal)
    )
    score[GRID > np.minimum(u / v, v / u) + 0.005] = -np.inf
    return GRID[score.argmax(1)]


def sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, n_shingles, k1, k2, registers``; ``k1, k2`` identify the set."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            found = sets(utf8(batch.column("text")))
            keys = np.array(
                [np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in found]
            ).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array(keys[:, 0]),
                    pa.array(keys[:, 1]),
                    pa.array([registers(s).tobytes() if len(s) else b"" for s in found], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "k1", "k2", "registers"],
            )

    return rows.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, registers binary")


def counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many registers of each row of ``a`` are above and below those of ``b``."""
    return (a > b).sum(1), (a < b).sum(1)


def sizes_fit(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can reach the limit at all."""
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def as_objects(column: pa.ChunkedArray) -> np.ndarray:
    """Bytes of each row."""
    out = np.empty(len(column), object)
    out[:] = [value for chunk in column.chunks for value in utf8(chunk)]
    return out


def commonest(sketches: np.ndarray) -> np.ndarray:
    """The most frequent value of each register."""
    ordered = np.sort(sketches, axis=0)
    size = len(ordered)
    new = np.ones(ordered.shape, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.arange(size, dtype=np.int32)[:, None]
    began = np.maximum.accumulate(np.where(new, place, np.int32(0)), axis=0)
    return np.take_along_axis(ordered, (place - began).argmax(0)[None], 0)[0]


class Group:
    """Likely pairs in different components, in one block of a bucket or between two of its blocks."""

    def __init__(self, rows: dict[str, np.ndarray], cross: bool) -> None:
        self.ids, self.sizes, self.label = rows["rep"], rows["n"], rows["component"]
        self.sketches = np.frombuffer(b"".join(rows["registers"]), np.uint16).reshape(-1, REGISTERS)
        self.side = rows["block"] if cross else None
        self.rows = rows

    def candidates(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each position the later ones that can be likely, and the counts of registers."""
        for i in range(len(self.ids) - 1):
            fits = self.label[i + 1 :] != self.label[i]
            if self.side is not None:
                fits &= self.side[i + 1 :] != self.side[i]
            if fits.any():
                fits &= sizes_fit(self.sizes[i + 1 :], self.sizes[i])
                j = np.flatnonzero(fits) + i + 1
                above, below = counts(self.sketches[i], self.sketches[j])
                hold = REGISTERS - above - below >= 0.4 * REGISTERS
                if hold.any():
                    yield i, j[hold], above[hold], below[hold]

    def likely(self, i: np.ndarray, j: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
        return likelihood(above, below, self.sizes[i], self.sizes[j]) >= LIKELY

    def stars(self, centres: int = CENTRES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each member with the centre of its family, for so many centres.

        A centre is the member that agrees most with the commonest value of each register: the
        text that copies were made of, where each of them differs in another place.
        """
        left = np.arange(len(self.ids))
        for _ in range(centres):
            if len(left) < 2:
                break
            sketches = self.sketches[left]
            if len(left) <= 8:
                agree = (sketches[:, None, :] == sketches[None]).sum((1, 2))
            else:
                agree = (sketches == commonest(sketches)).sum(1)
            centre = int(agree.argmax())
            above, below = counts(sketches[centre], sketches)
            at = np.full(len(left), left[centre])
            hold = sizes_fit(self.sizes[left], self.sizes[at]) & self.likely(at, left, above, below)
            hold[centre] = False
            yield self.ids[at[hold]], self.ids[left[hold]]
            family = REGISTERS - above - below >= FAMILY * REGISTERS
            family[centre] = True
            left = left[~family]

    def meet_here(self, i: int, j: np.ndarray) -> np.ndarray:
        """Whether this bucket is the first that i and j share."""
        same = (self.sketches[i] == self.sketches[j]).reshape(-1, BANDS, ROWS).all(2)
        looked_at = (self.rows["buckets"][i] >> np.arange(BANDS)) & 1
        return (same & (looked_at == 1)).argmax(1) == self.rows["band"][i]

    def likely_here(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each position with the later ones that it is likely to be near, where this is their first bucket."""
        for i, j, above, below in self.candidates():
            here = self.meet_here(i, j)
            if here.any():
                hold = self.likely(np.full(here.sum(), i), j[here], above[here], below[here])
                if hold.any():
                    yield i, j[here][hold]

    def every(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All links that join components, but for those that earlier ones joined already."""
        # A block can have millions of likely pairs: four bytes each here, a hundred as tuples.
        pairs = [(i, j.astype(np.int32)) for i, j in self.likely_here()]
        in_pairs = np.zeros(len(self.ids), bool)
        for i, j in pairs:
            in_pairs[i] = in_pairs[j] = True
        used = np.flatnonzero(in_pairs).tolist()
        held: dict[int, np.ndarray] = {}
        for begin in range(0, len(used), 256):
            some = used[begin : begin + 256]
            held.update(zip(some, sets([self.rows["text"][x] for x in some])))
        joined: dict[int, int] = {}

        def root(label: int) -> int:
            while label in joined:
                label = joined[label]
            return label

        out = []
        for i, j in ((i, k) for i, later in pairs for k in later.tolist()):
            a, b = root(int(self.label[i])), root(int(self.label[j]))
            if a != b:
                both = shared(held[i], held[j])
                if 100 * both >= PERCENT * (len(held[i]) + len(held[j]) - both):
                    joined[max(a, b)] = min(a, b)
                    out.append((self.ids[i], self.ids[j]))
        if out:
            yield tuple(np.array(x) for x in zip(*out))

    def nearest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each member the partner with most equal registers, the first among equals."""
        size = len(self.ids)
        equal, partner = np.zeros(size, int), np.full(size, -1)
        over, under = np.zeros(size, int), np.zeros(size, int)
        for i, j, above, below in self.candidates():
            same = REGISTERS - above - below
            better = same > equal[j]
            at = j[better]
            equal[at], partner[at], over[at], under[at] = same[better], i, below[better], above[better]
            best = int(same.argmax())
            if same[best] > equal[i]:
                equal[i], partner[i], over[i], under[i] = same[best], j[best], above[best], below[best]
        have = np.flatnonzero(partner >= 0)
        if len(have):
            hold = self.likely(have, partner[have], over[have], under[have])
            yield self.ids[have[hold]], self.ids[partner[have[hold]]]


BLOCKS = ["key", "lo", "hi"]


def in_blocks(members: DataFrame, which: str) -> DataFrame:
    """A row for each two blocks of a bucket that a member is compared in; for ``stars`` its own block only."""
    blocks = F.ceil(F.col("rows") / (CENTRE_BLOCK if which == "stars" else BLOCK))
    dealt = members.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    if which == "stars":
        spread = dealt.withColumn("other", F.col("block"))
    else:
        spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
    return spread.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})


def pairs_apart(placed: DataFrame, which: str) -> DataFrame:
    """Likely pairs ``a > b`` of the rows ``in_blocks``, which have ``n, registers, component`` too.

    ``stars``: each member with its family's centre, inside a block. Of the pairs with members of other
    components, also between blocks, the ``nearest`` of each, or the confirmed links among ``every`` one; these
    need ``text``, ``band`` and ``buckets`` too.
    """
    extra, centres = ["text", "band", "buckets"] if which == "every" else [], CENTRES
    spread = placed.select(*BLOCKS, "rep", "n", "registers", "component", "block", *extra)
    ordered = spread.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep")

    def emit(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        columns = {
            n: as_objects(rows.column(n)) if n in ("registers", "text") else rows.column(n).to_numpy()
            for n in rows.column_names
        }
        change = np.flatnonzero(
            (np.diff(columns["key"]) != 0) | (np.diff(columns["lo"]) != 0) | (np.diff(columns["hi"]) != 0)
        )
        edges = [0, *(change + 1).tolist(), rows.num_rows]
        for begin, end in zip(edges, edges[1:]):
            label = columns["component"][begin:end]
            if (label != label[0]).any():
                group = Group({n: x[begin:end] for n, x in columns.items()}, columns["lo"][begin] != columns["hi"][begin])
                yield from group.stars(centres) if which == "stars" else getattr(group, which)()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made(rows: pa.Table) -> pa.RecordBatch:
            found = list(emit(rows)) or [(np.empty(0, np.int64), np.empty(0, np.int64))]
            a, b = (np.concatenate(x).astype(np.int64) for x in zip(*found))
            pairs = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b)), 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            # The last group may go on in the next batch.
            last = [rows.column(n).to_numpy() for n in BLOCKS]
            same = np.logical_and.reduce([x == x[-1] for x in last])
            done = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if done:
                yield made(rows.slice(0, done))
                held = rows.slice(done).to_batches()
        if held:
            yield made(pa.Table.from_batches(held))

    return ordered.mapInArrow(run, "a long, b long").distinct()


def still_open(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members, with their component, of buckets that hold several components."""
    placed = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    placed = workspace.stored(placed, "placed")
    # Stored, so that the join has a shuffle of its own, in which a large bucket can be split.
    several = workspace.stored(
        placed.groupBy("key").agg(F.min("component").alias("first"), F.max("component").alias("last"))
        .where("first < last").select("key"),
        "several",
    )
    return placed.join(several, "key", "left_semi")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the limit; ``texts`` has ``id, text``."""
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text_a", PIECE):
            held = []
            one, two = utf8(batch.column("text_a")), utf8(batch.column("text_b"))
            place = {text: i for i, text in enumerate(dict.fromkeys(one + two))}
            made = sets(list(place))
            for left, right in zip(one, two):
                s, t = made[place[left]], made[place[right]]
                both = shared(s, t)
                held.append(100 * both >= PERCENT * (len(s) + len(t) - both))
            keep = pa.array(held, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"]
            )

    return rows.mapInArrow(run, "a long, b long").distinct()


def through_ids(named: DataFrame, reps: DataFrame) -> DataFrame | None:
    """Links ``a > b`` of each id that has several texts with the classes of these texts."""
    several = (
        named.groupBy("doc_id")
        .agg(*[f("k" + i).alias(n + i) for i in "12" for f, n in ((F.min, "lo"), (F.max, "hi"))])
        .where("lo1 < hi1 or lo2 < hi2").select("doc_id")
    )
    several = workspace.stored(several, "repeated-ids")
    if several.isEmpty():
        return None
    theirs = named.select("doc_id", "k1", "k2").join(bounded(several), "doc_id", "left_semi")
    held = theirs.distinct().join(reps, ["k1", "k2"]).where("doc_id > rep")
    return workspace.stored(held.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")), "id-links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    The id must be a whole number. Rows of one id are one document for linking, and each gets its
    row. A row without id, or without words, is linked with nothing: its component is its own id, and
    it is kept; without an id both are null. Empty input gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = workspace.stored(sketched(docs, key, text), "sketches")
    named = rows.where("n_shingles > 0 and doc_id is not null")
    reps = workspace.stored(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes")
    classes = workspace.stored(
        named.join(reps, ["k1", "k2"]).where("doc_id = rep").select("rep", F.col("n_shingles").alias("n"), "registers"),
        "class-sketches",
    )
    bands = classes.select(
        "rep",
        F.posexplode(
            F.expr(f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(registers, i * {2 * ROWS} + 1, {2 * ROWS})))")
        ).alias("band", "key"),
    )
    buckets = (
        bands.groupBy("key")
        .agg(F.count("*").alias("rows"), F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.bit_xor(F.xxhash64("rep")).alias("all"))
        .where("lo < hi")
        .groupBy("rows", "lo", "hi", "all")
        .agg(F.min("key").alias("key"))
        .select("key", "rows")
    )
    members = workspace.stored(bands.join(workspace.stored(buckets, "bucket-sizes"), "key"), "buckets")

    def texts_of(pairs: DataFrame) -> DataFrame:
        ids = workspace.stored(pairs.select(F.explode(F.array(*pairs.columns)).alias("id")).distinct(), "ids")
        return workspace.stored(
            docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(bounded(ids), "id"),
            "texts",
        )

    alone = members.join(classes, "rep").withColumn("component", F.col("rep"))
    tested = workspace.stored(pairs_apart(in_blocks(alone, "stars"), "stars"), "pairs")
    links = workspace.stored(confirmed(tested, texts_of(tested)), "confirmed")
    through = through_ids(named, reps)
    if through is not None:
        links = links.unionByName(through)
    found = components(links)
    for which in ("nearest", "every"):
        rows_left = workspace.stored(still_open(members, found), "open")
        if rows_left.isEmpty():
            break
        if which == "nearest":
            pairs = pairs_apart(in_blocks(rows_left.join(classes, "rep"), which), which).join(tested, ["a", "b"], "left_anti")
            pairs = workspace.stored(pairs, "pairs")
            more = confirmed(pairs, texts_of(pairs))
        else:
            looked_at = members.groupBy("rep").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), "band")).alias("buckets"))
            ids = workspace.stored(rows_left.select(F.col("rep").alias("a")).distinct(), "ids")
            whole = classes.join(looked_at, "rep").join(texts_of(ids).withColumnRenamed("id", "rep"), "rep")
            more = pairs_apart(in_blocks(rows_left.join(whole, "rep"), which), which)
        more = workspace.stored(more, "confirmed")
        if not more.isEmpty():
            # Components so far stand for the links they were made of.
            links = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
            found = components(links)

    named_as = reps.join(found, reps["rep"] == found["node"], "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component_id")
    )
    out = rows.select("doc_id", "n_shingles", "k1", "k2")
    linked = out.where("n_shingles > 0 and doc_id is not null").join(named_as, ["k1", "k2"])
    single = out.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(single).select(
        "doc_id", "n_shingles", "component_id",
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )
