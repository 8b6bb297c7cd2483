"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become term weights: hashed words, word shapes (``Aa``, ``a***``) and bucketed statistics of
the whole text, each group scaled to its own share. A bounded sample of labelled documents gives the
inverse document frequencies and, by a randomised singular value decomposition, the latent space.
The sample's vectors and labels, a few MB by the bounds below, are broadcast; every document is
multiplied with all of them in blocks, and its nearest neighbours vote with their cosine to a power.

The sample holds equally many rows of both labels where there are enough; each vote counts as many
rows as it stands for, so a score is the share of good documents among the neighbours.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from matchloom.llm.common import free_name, small_batches, utf8

#: Most labelled documents of each label that the model is fitted on.
MAX_PER_LABEL = 2048
#: Hashed words, hashed shapes and statistics, and how much each group weighs.
WORD_TERMS, SHAPE_TERMS, STAT_TERMS = 6144, 1920, 128
TERMS = WORD_TERMS + SHAPE_TERMS + STAT_TERMS
GROUPS = ((0, WORD_TERMS, 0.4), (WORD_TERMS, WORD_TERMS + SHAPE_TERMS, 1.0), (WORD_TERMS + SHAPE_TERMS, TERMS, 1.0))
#: Latent dimensions, neighbours, and the power of the cosine.
RANK, NEIGHBOURS, POWER = 64, 15, 8
#: Documents scored at once; their dense weights take 32 kB each, several times.
SCORED = 64
#: Documents with at least this score are good.
THRESHOLD = 0.3

LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)
SHAPES = bytes(
    65 if 65 <= c <= 90 else 97 if c >= 128 or 97 <= c <= 122 else 48 if 48 <= c <= 57 else c
    for c in range(256)
)
RUN = re.compile(rb"([Aa0])\1+")


def bucket(part: int, whole: int) -> int:
    """A share as one of 16 buckets, narrow near 0; 0 is none at all."""
    return 0 if part <= 0 or whole <= 0 else min(15, 1 + int(14 * min(1.0, part / whole) ** 0.5))


def terms(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and their counts in a whole text; a null text is empty."""
    text = text or b""
    words = text.translate(LETTERS).split()
    hashed = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % WORD_TERMS
    counts = np.bincount(hashed, minlength=TERMS).astype(np.float32)
    solid = text.split()
    for shape, n in Counter(text.translate(SHAPES).split()).items():
        counts[WORD_TERMS + zlib.crc32(RUN.sub(rb"\1", shape)) % SHAPE_TERMS] += n
    lines = [line for line in text.split(b"\n") if line.strip()]
    pairs = list(zip(solid, solid[1:]))
    upper = len(text) - len(text.translate(None, bytes(range(65, 91))))
    symbols = len(text) - len(text.translate(None, b"#*$%&|<>!"))
    stats = (
        min(15, int(np.log2(len(solid) + 1) * 2)),
        bucket(symbols, len(text)),
        bucket(upper, len(text)),
        bucket(len(lines) - len(set(lines)), len(lines)),
        bucket(len(pairs) - len(set(pairs)), len(pairs)),
        bucket(sum(a == b for a, b in pairs), len(pairs)),
        bucket(len(solid) - len(set(solid)), len(solid)),
        bucket(len(text) - len(text.translate(None, b"0123456789")), len(text)),
    )
    for i, value in enumerate(stats):
        counts[WORD_TERMS + SHAPE_TERMS + 16 * i + value] += 1
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at]


def weighted(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    """Dense weights of rows: log counts times idf, each group of terms at its share of length 1."""
    out = np.zeros((len(rows), TERMS), np.float32)
    for row, (at, counts) in enumerate(rows):
        out[row, at] = np.log1p(counts) * idf[at]
    for begin, end, share in GROUPS:
        part = out[:, begin:end]
        length = np.sqrt(np.einsum("ij,ij->i", part, part))[:, None]  # without a copy of the part
        part *= share / np.maximum(length, 1e-9)
    return out


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    """Some MB: ``TERMS * RANK`` and at most ``2 * MAX_PER_LABEL * RANK`` floats."""

    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    stands_for: np.ndarray
    prior: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """Share of good neighbours of each text; the prior where no neighbour is similar."""
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        latent = unit_rows(weighted([terms(t) for t in texts], self.idf) @ self.space)
        cosines = latent @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, nearest, 1), 0.0).astype(float) ** POWER
        votes = votes * self.stands_for[nearest]
        total = votes.sum(1)
        good = (votes * self.labels[nearest]).sum(1)
        return np.where(total > 0, good / np.where(total > 0, total, 1), self.prior).clip(0, 1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, of_label: dict[int, int]) -> Model:
    """The model of a bounded sample; ``of_label``: how many labelled rows there are of each label."""
    total = sum(of_label.values())
    prior = of_label.get(1, 0) / total if total else 0.5
    seen = np.zeros(TERMS)
    for at, _ in rows:
        seen[at] += 1
    idf = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + 1
    matrix = weighted(rows, idf)
    rank = min(RANK, max(1, len(rows)))
    random = np.random.default_rng(7)
    basis = random.standard_normal((TERMS, min(rank + 16, TERMS))).astype(np.float32)
    for _ in range(3):  # randomised subspace iteration
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, turned = np.linalg.svd(matrix @ basis, full_matrices=False)
    space = (basis @ turned[:rank].T).astype(np.float32)
    drawn = Counter(labels.tolist())
    each = np.array([of_label[int(y)] / drawn[int(y)] for y in labels])
    return Model(idf, space, unit_rows(matrix @ space), labels.astype(float), each, prior)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on at most ``MAX_PER_LABEL`` labelled documents of each label, none of them held out.

    The sample is the labelled rows with the least hash of their key. Rows without key or with
    another label than 0 and 1 are left out; contradicting rows count each. Without any labelled
    document every score is the prior.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).where(
        F.col("key").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("key"))
    )
    of_label = {row["y"]: row["n"] for row in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.md5(F.col("key").cast("string"))
    picked = [known.where(F.col("y") == y).orderBy(order, "key").limit(MAX_PER_LABEL) for y in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # by the limit 2 * MAX_PER_LABEL rows
    rows = (
        docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
        .join(sample, "key")
        .select("y", "key", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [terms(value) for value in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("y"),
                    batch.column("key").cast(pa.string()),
                    # As bytes: the driver would hold lists as an object for each number.
                    pa.array([at.tobytes() for at, _ in made], pa.binary()),
                    pa.array([counts.tobytes() for _, counts in made], pa.binary()),
                ],
                names=["y", "key", "at", "counts"],
            )

    found = (  # a key may repeat in documents, so the bound is set again
        rows.mapInArrow(run, "y int, key string, at binary, counts binary")
        .orderBy(F.md5("key"), "y", "at", "counts")
        .limit(2 * MAX_PER_LABEL)
        .collect()
    )
    return fit(
        [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["counts"], np.float32)) for r in found],
        np.array([r["y"] for r in found], int),
        of_label,
    )


def score(docs: DataFrame, model: Model, *, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, in a column named ``into`` (renamed if it is taken).

    Null and empty texts are scored by their statistics. Only the text enters a score.
    """
    into = free_name(docs, into)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields]).add(into, "double")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, SCORED):
                part = batch.slice(begin, SCORED)
                scores = model.scores(utf8(part.column(text).cast(pa.string())))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores, pa.float64())], schema=arrow
                )

    return docs.mapInArrow(run, schema)
