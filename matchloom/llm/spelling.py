"""Spelling variants: words one edit apart, and the frequent form that each rare one stands for.

Two words are near if one inserted, deleted or replaced code point makes them equal, that is, if their
common prefix and suffix together reach the longer length less one. Prefixes and suffixes are compared
by dense tiles: the words of two blocks as padded matrices of code points, column by column.

Which words meet in a tile: a word is cut into three parts, and an edit falls into one of them, so near
words agree in the other two. A class ``m`` holds the words of ``m`` code points and, as the longer side of
an insertion, those of ``m + 1``; its buckets are the words that agree but for part 0, 1 or 2. A pair that
meets in several buckets counts in the first. A bucket of more than ``TILE`` words is dealt into blocks by
a hash, and each pair of blocks is a tile of its own, so no task gets a whole bucket. Tiles return counts
and best forms of words, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm.common import bounded

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Least code points and occurrences of a word, and how many times more frequent its form is.
LENGTH, TIMES, RATIO = 7, 2, 10
PARTS = 3
#: Words of a block, and cells of the tiles that are compared at once.
TILE, CELLS = 1024, 1 << 21
#: Rows of one Arrow batch that are prepared together.
ROWS = 1 << 15


def runs(text: Column, least: int = LENGTH) -> Column:
    """Maximal runs of Latin letters of at least ``least`` code points, A to Z lower-cased."""
    letters = F.lit(r"[a-zÀ-ÿ]{%d,}" % least)
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), letters, F.lit(0))


def counted(words: DataFrame, least: int = LENGTH, times: int = TIMES) -> DataFrame:
    """``word, n`` of a column ``word``: distinct words that are long and frequent enough."""
    long = words.where(F.char_length("word") >= least)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def cuts(m: Column | int | np.ndarray) -> list:
    """Where the parts of ``m`` code points begin and end."""
    return [m * i // PARTS for i in range(PARTS + 1)]


def buckets(words: DataFrame, least: int) -> DataFrame:
    """A row per word and bucket: ``m, part, agree`` (a hash of what the words agree in), ``word, n``."""
    size = F.char_length("word")
    keys = []
    for longer in (False, True):
        m = size - 1 if longer else size
        for part in range(PARTS):
            begin, end = (F.floor(m * p / PARTS).cast("int") for p in (part, part + 1))
            head = F.substring("word", F.lit(1), begin)
            tail = F.substring("word", end + (2 if longer else 1), size)
            agree = F.xxhash64(head, tail)
            keys.append(
                F.when(m >= least, F.struct(m.cast("int").alias("m"), F.lit(part).alias("part"), agree.alias("agree")))
            )
    return words.select("word", "n", F.explode(F.array_compact(F.array(*keys))).alias("key")).select("key.*", "word", "n")


def tiled(rows: DataFrame, tile: int) -> DataFrame:
    """Buckets of two words or more, cut into tiles: adds ``x <= y``, the tile's blocks, and ``block``."""
    key = ["m", "part", "agree"]
    large = bounded(
        workspace.stored(
            rows.groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > tile), "large-buckets"
        )
    )
    blocks = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    sized = rows.join(large, key, "left").withColumn("block", F.coalesce(own, F.lit(0)))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(blocks, F.lit(1)) - 1))
    met = sized.withColumn("other", other)
    return met.select(
        *key, F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "word", "n"
    )


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words, padded behind; the same from the last backward; lengths."""
    sizes = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    flat = flat.astype(np.uint16 if flat.max(initial=0) < 1 << 16 else np.uint32)
    width = int(sizes.max(initial=1))
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    ahead = np.zeros((len(words), width), flat.dtype)
    back = np.zeros((len(words), width), flat.dtype)
    ahead[row, place] = flat
    back[row, sizes[row] - 1 - place] = flat
    return ahead, back, sizes


def common(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Length of the common start of each row of ``a`` with each of ``b``, tile by tile."""
    same = np.ones((len(a), a.shape[1], b.shape[1]), bool)
    length = np.zeros(same.shape, np.uint8 if width < 256 else np.uint32)
    for k in range(width):
        same &= a[:, :, None, k] == b[:, None, :, k]
        length += same
    return length


def near_pairs(left: np.ndarray, right: np.ndarray, m: np.ndarray, part: np.ndarray, made: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows one edit apart of several tiles; ``left`` and ``right`` have a tile's rows in each row,
    -1 where it has fewer. Only pairs whose first bucket is this one."""
    ahead, back, sizes = made
    width = int(m.max())
    prefix = common(ahead[left][..., :width], ahead[right][..., :width], width).astype(np.int32)
    suffix = common(back[left][..., :width], back[right][..., :width], width).astype(np.int32)
    m = m[:, None, None]
    # Padding is alike too, so no length goes beyond the shorter word, which has m code points.
    prefix, suffix = np.minimum(prefix, m), np.minimum(suffix, m)
    a, b = sizes[left][:, :, None], sizes[right][:, None, :]
    longer = np.maximum(a, b)
    near = (np.minimum(a, b) == m) & (prefix + suffix >= longer - 1) & ((a != b) | (prefix < m))
    near &= (left >= 0)[:, :, None] & (right >= 0)[:, None, :]
    edges = cuts(m)
    for j in range(PARTS - 1):
        earlier = (prefix >= edges[j]) & (suffix >= m - edges[j + 1]) & (j < part[:, None, None])
        near &= ~earlier
    tile, x, y = np.nonzero(near)
    return left[tile, x], right[tile, y]


def compare(rows: pa.Table) -> pa.RecordBatch:
    """Near words counted, and the best of them, of whole tiles: ``word, near, best_n, best``."""
    words = rows.column("word").to_pylist()
    n = rows.column("n").to_numpy()
    key = np.stack([rows.column(c).to_numpy() for c in ("m", "part", "agree", "x", "y")])
    begin = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
    size = np.diff(np.r_[begin, len(words)])
    block = rows.column("block").to_numpy()
    x, y, m, part = key[3], key[4], key[0], key[1]
    made = codes(words)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    # A tile on the diagonal has one block, against itself; others have their first block to the left.
    diagonal = x[begin] == y[begin]
    first = np.add.reduceat(block == x, begin)
    lefts, rights = first, np.where(diagonal, size, size - first)
    offset = np.where(diagonal, 0, first)
    shape = np.stack([lefts, rights])
    klass = np.where(shape > 0, 1 << np.ceil(np.log2(np.maximum(shape, 1))).astype(int), 0)
    useful = (lefts > 0) & (rights > 0) & ~(diagonal & (size < 2))
    for a, b in {(int(p), int(q)) for p, q in klass[:, useful].T}:
        of = np.flatnonzero(useful & (klass[0] == a) & (klass[1] == b))
        step = max(1, CELLS // (a * b))
        for k in range(0, len(of), step):
            tiles = of[k : k + step]
            left = begin[tiles, None] + np.arange(a)
            right = begin[tiles, None] + offset[tiles, None] + np.arange(b)
            left[np.arange(a) >= lefts[tiles, None]] = -1
            right[np.arange(b) >= rights[tiles, None]] = -1
            p, q = near_pairs(left, right, m[begin[tiles]], part[begin[tiles]], made)
            pairs.append((p, q))
            if not diagonal[tiles].all():
                crossing = ~diagonal[np.searchsorted(begin, p, "right") - 1]
                pairs.append((q[crossing], p[crossing]))
    p = np.concatenate([np.empty(0, int), *[p for p, _ in pairs]])
    q = np.concatenate([np.empty(0, int), *[q for _, q in pairs]])
    order = sorted(set(q.tolist()), key=lambda i: (-n[i], words[i]))
    rank = np.zeros(len(words), int)
    rank[order] = np.arange(len(order))
    count = np.bincount(p, minlength=len(words))
    best = np.full(len(words), len(order))
    np.minimum.at(best, p, rank[q])
    found = np.flatnonzero(count)
    at = np.array(order, int)[best[found]] if len(found) else np.empty(0, int)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[i] for i in found], pa.string()), pa.array(count[found], pa.int64()),
            pa.array(n[at], pa.int64()), pa.array([words[i] for i in at], pa.string()),
        ],
        ["word", "near", "best_n", "best"],
    )


def neighbours(words: DataFrame, least: int = LENGTH, tile: int = TILE) -> DataFrame:
    """``word, n_near, best_n, best`` of each word that has a near one: how many, and the most frequent of
    them, of equals the first in code-point order."""
    key = ["m", "part", "agree", "x", "y"]
    rows, together = tiled(buckets(words, least), tile), ROWS

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0
        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting < together:
                continue
            whole = pa.Table.from_batches(held)
            keys = np.stack([whole.column(c).to_numpy() for c in key])
            differ = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
            cut = int(differ[-1]) + 1 if len(differ) else 0  # the last tile may go on
            if cut:
                yield compare(whole.slice(0, cut))
            held = whole.slice(cut).to_batches()
            waiting = whole.num_rows - cut
        if waiting:
            yield compare(pa.Table.from_batches(held))

    placed = rows.repartition(*key).sortWithinPartitions(*key, "block")
    found = placed.mapInArrow(tiles, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: forms followed to the last.

    A form is ``RATIO`` times as frequent as its word, so there is no circle and a way is as long as the
    logarithm of the counts; each round doubles the part of it that is known.
    """
    now = workspace.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = workspace.stored(now.join(on, "root", "left").select("word", "root", "next"), "roots")
        if step.where("next is not null").isEmpty():
            return now
        now = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, *, least: int = LENGTH, times: int = TIMES, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """A row per distinct word: ``word, form, root, n, n_near, form_n``.

    ``words``: a column ``word``, a row per occurrence; other columns are not read and null words are
    none. Words shorter than ``least`` or rarer than ``times`` are left out. A word's form is its most frequent near
    word, if it occurs ``ratio`` times as often; of equally frequent ones the first in code-point order.
    No words give no rows.
    """
    known = workspace.stored(counted(words.select("word"), least, times), "words")
    found = neighbours(known, least, tile)
    enough = F.col("best_n") >= ratio * F.col("n")
    formed = workspace.stored(
        known.join(found, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    led = roots(formed.where("form is not null"))
    return formed.join(led, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def misspelt(docs: DataFrame, least: int = LENGTH, every: int = 31) -> DataFrame:
    """Runs of the documents as a column ``word``, some with a code point taken out.

    A run whose checksum with the document's id is divisible by ``every`` loses the code point at the
    checksum modulo its length. A null text has no runs; a null id counts as an empty one.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.select(key.alias("key"), F.explode(runs(F.col("text").cast("string"), least)).alias("run"))
    h = F.crc32(F.concat("key", F.lit(":"), "run"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return found.withColumn("h", h).select(F.when(F.col("h") % every == 0, less).otherwise(F.col("run")).alias("word"))
