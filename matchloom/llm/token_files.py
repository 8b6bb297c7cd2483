"""Token ids in binary segment files of patched frame-of-reference blocks.

Documents are put in one order by a range exchange and tokenised where they are written. A task cuts its
stream of ids into segments at document ends; each segment is one file, written by Spark's text sink as
raw bytes, so a file appears only when its task has committed.

A segment, little-endian:

    head       magic ``PFB1``, u32 range, u32 number in the range, u32 ids a block, u64 ids, u64 documents
    blocks     u32 least id, u16 ids, u8 width, u8 bytes of a patch, u16 exceptions; offsets from the least
               id, packed at ``width`` bits; the exceptions' places (u8); their patches: what the offsets
               have above ``width`` bits
    index      u64 start of each block, and of the index
    directory  i64 document ids, u8 1 where there is no id, u64 numbers of ids
    tail       u64 starts of index and directory, u32 CRC-32 of all bytes before, magic ``1BFP``, ``\\n``

The width is what the given percentile of a block's offsets needs, so a few large ids do not widen all.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom import workspace
from matchloom.llm.common import byte_size, pieces

BLOCK, PERCENTILE = 256, 90
#: A segment ends with the document that fills it.
SEGMENT_IDS = 1 << 24
#: Blocks that are unpacked at once, 32 bytes an id, and bytes of text that are tokenised at once.
CHUNK_BLOCKS, CHUNK_BYTES = 4096, 8 << 20
#: Most pieces of text whose ids a task remembers.
REMEMBERED = 500_000

HEAD, BLOCK_HEAD, TAIL = struct.Struct("<4sIIIQQ"), struct.Struct("<IHBBH"), struct.Struct("<QQI4s")

# Texts of these characters are cut here as a byte-level pre-tokeniser cuts them (fixed pattern of
# that kind of tokeniser, its classes written out for Latin letters); others are cut by the library.
LETTER, NUMBER, SPACE = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾", r"\t\n\x0b\x0c\r "
KNOWN = re.compile(r"[\t\n\x0b\x0c\r -~¡-ſ‐-‧‰-⁞₠-₿]*")
PIECE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_letters() -> str:
    """The character that stands for each byte in a byte-level model: itself where it prints, or else
    the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return "".join(chr(256 + others.index(b) if b in others else b) for b in range(256))


class Pieces(dict):
    """The ids of each piece of text that was asked for."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        self[piece] = ids = array("I", [token.id for token in self.model.tokenize(mapped)]).tobytes()
        return ids


class Encoder:
    """Ids of texts by a tokenizer file, as little-endian unsigned 32-bit integers.

    Strings of special tokens are ordinary text. A byte-level tokenizer without a normalizer treats each
    piece of a text alone, so the ids of a piece are asked for once and remembered.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        made = json.loads(self.tokenizer.to_str())
        cut = made["pre_tokenizer"] or {}
        self.by_piece = (
            made["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut["add_prefix_space"]
        )
        self.known = Pieces(self.tokenizer.model)

    def direct(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self.direct(texts)
        cut = [PIECE.findall(t) if KNOWN.fullmatch(t) else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        whole = iter(self.direct([t for t, parts in zip(texts, cut) if t and not parts]))
        ids = self.known.__getitem__
        return [b"".join(map(ids, parts)) if parts or not t else next(whole) for t, parts in zip(texts, cut)]


@cache
def encoder(file: str) -> Encoder:
    return Encoder(file)


def bits_of(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned value needs."""
    return np.frexp(values.astype(np.float64))[1]


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of up to ``BLOCK`` ids; only the last has fewer."""
    if not len(ids):
        return []
    n = -(-len(ids) // BLOCK)
    rows = np.full(n * BLOCK, ids[-1], np.uint32)
    rows[: len(ids)] = ids
    rows = rows.reshape(n, BLOCK)
    if last := len(ids) % BLOCK:
        rows[-1, last:] = rows[-1, :last].min()
    least = rows.min(axis=1)
    offsets = rows - least[:, None]
    at = min(BLOCK - 1, max(0, round(BLOCK * percentile / 100) - 1))
    width = bits_of(np.partition(offsets, at, axis=1)[:, at])
    above = (offsets.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    row, place = np.nonzero(above)
    patched = np.bincount(row, minlength=n)
    most = above.max(axis=1)
    size = np.select([most == 0, most < 256, most < 65536], [0, 1, 2], 4)
    ends, patch_ends = np.cumsum(patched), np.cumsum(patched * size)
    places = place.astype(np.uint8).tobytes()
    wide = above[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    patches = wide[np.arange(4) < size[row][:, None]].tobytes()
    counts = np.full(n, BLOCK)
    counts[-1] = len(ids) - (n - 1) * BLOCK
    packed: list[bytes] = [b""] * n
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        raw = np.unpackbits(offsets[of].astype("<u4").view(np.uint8).reshape(len(of), BLOCK, 4), axis=2, bitorder="little")
        tight = np.packbits(raw[:, :, :w].reshape(len(of), BLOCK * w), axis=1, bitorder="little")
        for k, i in enumerate(of):
            packed[i] = tight[k].tobytes()
    return [
        BLOCK_HEAD.pack(least[i], counts[i], width[i], size[i], patched[i])
        + packed[i]
        + places[ends[i] - patched[i] : ends[i]]
        + patches[patch_ends[i] - patched[i] * size[i] : patch_ends[i]]
        for i in range(n)
    ]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of several runs, one after the other."""
    begins = np.cumsum(lengths) - lengths
    return np.repeat(starts - begins, lengths) + np.arange(int(lengths.sum()))


def unpack(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``data`` (bytes), in their order."""
    if not len(starts):
        return np.empty(0, np.uint32)
    heads = data[starts[:, None] + np.arange(BLOCK_HEAD.size)]
    least = heads[:, :4].copy().view("<u4")[:, 0]
    counts = heads[:, 4:6].copy().view("<u2")[:, 0].astype(np.int64)
    width, size = heads[:, 6].astype(np.int64), heads[:, 7].astype(np.int64)
    patched = heads[:, 8:10].copy().view("<u2")[:, 0].astype(np.int64)
    offsets = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        of = np.flatnonzero(width == w)
        tight = data[starts[of, None] + BLOCK_HEAD.size + np.arange(BLOCK * w // 8)]
        raw = np.zeros((len(of), BLOCK, 32), np.uint8)
        raw[:, :, :w] = np.unpackbits(tight, axis=1, bitorder="little").reshape(len(of), BLOCK, w)
        offsets[of] = np.packbits(raw, axis=2, bitorder="little").reshape(len(of), BLOCK * 4).view("<u4")
    row = np.repeat(np.arange(len(starts)), patched)
    after = starts + BLOCK_HEAD.size + BLOCK * width // 8
    at = spread(after, patched)
    patch = after[row] + patched[row] + (at - after[row]) * size[row]
    above = np.zeros(len(row), np.uint64)
    for k in range(4):
        has = size[row] > k
        above[has] |= data[patch[has] + k].astype(np.uint64) << np.uint64(8 * k)
    offsets[row, data[at]] += (above << width[row].astype(np.uint64)).astype(np.uint32)
    whole = offsets + least[:, None]
    return whole.reshape(-1)[spread(np.arange(len(starts)) * BLOCK, counts)]


class Segment:
    """A segment while it is written: blocks that are full, the ids of the last, the directory."""

    def __init__(self, range_: int, number: int):
        self.key = range_, number
        self.blocks: list[bytes] = []
        self.open: list[bytes] = []
        self.waiting = 0
        self.ids = 0
        self.documents: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.open.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids) // 4
        self.documents.append((doc_id, len(ids) // 4))
        if self.waiting >= CHUNK_BLOCKS * BLOCK * 4:
            self.flush(self.waiting // (4 * BLOCK) * (4 * BLOCK))

    def flush(self, size: int) -> None:
        held = b"".join(self.open)
        for begin in range(0, size, CHUNK_BLOCKS * BLOCK * 4):
            end = min(size, begin + CHUNK_BLOCKS * BLOCK * 4)
            self.blocks += pack(np.frombuffer(held, "<u4", (end - begin) // 4, begin))
        self.open, self.waiting = [held[size:]], len(held) - size

    def bytes(self) -> bytes:
        self.flush(self.waiting)
        head = HEAD.pack(b"PFB1", *self.key, BLOCK, self.ids, len(self.documents))
        starts = np.cumsum([len(head), *map(len, self.blocks)]).astype("<u8")
        keys = np.array([0 if d is None else d for d, _ in self.documents], "<i8")
        missing = np.array([d is None for d, _ in self.documents], np.uint8)
        sizes = np.array([n for _, n in self.documents], "<u8")
        body = b"".join([head, *self.blocks, starts.tobytes(), keys.tobytes(), missing.tobytes(), sizes.tobytes()])
        at = int(starts[-1])
        return body + TAIL.pack(at, at + starts.nbytes, zlib.crc32(body), b"1BFP")


class Reader:
    """The parts of a segment file."""

    def __init__(self, data: bytes):
        if len(data) < HEAD.size + TAIL.size + 1 or data[-1:] != b"\n":
            raise ValueError("no whole segment")
        end = len(data) - 1 - TAIL.size
        index, directory, checksum, last = TAIL.unpack_from(data, end)
        first, self.range, self.number, block, self.ids, n = HEAD.unpack_from(data)
        if (first, last, block) != (b"PFB1", b"1BFP", BLOCK):
            raise ValueError("not a segment of this format")
        if zlib.crc32(memoryview(data)[:end]) != checksum:
            raise ValueError("segment with changed bytes")
        self.data = np.frombuffer(data, np.uint8)
        self.starts = np.frombuffer(data, "<u8", (directory - index) // 8, index)[:-1].astype(np.int64)
        self.doc_ids = np.frombuffer(data, "<i8", n, directory)
        self.missing = np.frombuffer(data, np.uint8, n, directory + 8 * n).astype(bool)
        self.sizes = np.frombuffer(data, "<u8", n, directory + 9 * n).astype(np.int64)

    def read(self, first: int, count: int) -> np.ndarray:
        """Ids ``first`` to ``first + count``: only their blocks are unpacked."""
        begin, end = first // BLOCK, -(-(first + count) // BLOCK)
        return unpack(self.data, self.starts[begin:end])[first - begin * BLOCK :][:count]

    def chunks(self) -> Iterator[bytes]:
        for begin in range(0, len(self.starts), CHUNK_BLOCKS):
            yield unpack(self.data, self.starts[begin : begin + CHUNK_BLOCKS]).astype("<u4").tobytes()

    def documents(self) -> Iterator[Iterator[bytes]]:
        """The ids of each document, in pieces, in the order of the file; take each before the next."""
        source, held, at = self.chunks(), b"", 0

        def parts(left: int) -> Iterator[bytes]:
            nonlocal held, at
            while left:
                if at == len(held):
                    held, at = next(source), 0
                part = held[at : at + left]
                at += len(part)
                left -= len(part)
                yield part

        for size in self.sizes:
            yield parts(4 * int(size))


def write(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 2, key: str = "doc_id", text: str = "text",
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Tokenise whole texts and write their ids to segment files in the order of their keys.

    ``tokenizer`` is a file that all executors have at this path. ``end_id`` follows each document. A null
    text is empty, a null key comes first; rows of one key are ordered by checksum and size of their
    texts, and rows alike in these by their place, so that one key can fill many ranges. Other columns
    are not read. No rows give a folder without segments. A document is never cut; a segment of more than
    ``segment_ids`` ids holds one longer document at its end.
    """
    end = np.array([end_id], "<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        segment = None
        for batch in pieces(batches, "text", CHUNK_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ranges, ids = batch.column("range"), batch.column("doc_id").to_pylist()
            for doc_id, made in zip(ids, encode(texts)):
                if segment is None:
                    segment = Segment(ranges[0].as_py(), 0)
                elif segment.ids >= segment_ids:
                    yield pa.RecordBatch.from_arrays([pa.array([segment.bytes()], pa.binary())], ["segment"])
                    segment = Segment(segment.key[0], segment.key[1] + 1)
                segment.add(doc_id, made + end)
        if segment is not None:
            yield pa.RecordBatch.from_arrays([pa.array([segment.bytes()], pa.binary())], ["segment"])

    order = ["doc_id", "text_crc32", "size", "place"]
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).withColumns(
        {
            "text_crc32": F.coalesce(F.crc32("text"), F.lit(0)),
            "size": byte_size(F.col("text")),
            "place": F.monotonically_increasing_id(),
        }
    )
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    (
        ranged.select("doc_id", "text", F.spark_partition_id().alias("range"))
        .mapInArrow(segments, "segment binary")
        .select(F.col("segment").cast("string").alias("value"))
        .write.mode("overwrite").option("maxRecordsPerFile", 1).option("compression", "none").text(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per document of the files: ``doc_id, range, number, rank, first, n_tokens, ids_crc32``.

    ``rank`` and ``first`` count the documents and ids before it in its segment. Every block is unpacked.
    """
    names = ["doc_id", "range", "number", "rank", "first", "n_tokens", "ids_crc32"]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                reader = Reader(data.as_py())
                sums = []
                for parts in reader.documents():
                    checksum = 0
                    for part in parts:
                        checksum = zlib.crc32(part, checksum)
                    sums.append(checksum)
                n = len(reader.sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_ids, pa.int64(), mask=reader.missing),
                        pa.array(np.full(n, reader.range, np.int32)),
                        pa.array(np.full(n, reader.number, np.int32)),
                        pa.array(np.arange(n, dtype=np.int64)),
                        pa.array(np.cumsum(reader.sizes) - reader.sizes),
                        pa.array(reader.sizes),
                        pa.array(sums, pa.int64()),
                    ],
                    names,
                )

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    schema = "doc_id long, range int, number int, rank long, first long, n_tokens long, ids_crc32 long"
    return files.mapInArrow(documents, schema)


def ids_of(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids`` of every document of the files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                reader = Reader(data.as_py())
                for i, parts in enumerate(reader.documents()):
                    ids = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
                    doc_id = pa.array([None if reader.missing[i] else int(reader.doc_ids[i])], pa.int64())
                    yield pa.RecordBatch.from_arrays([doc_id, pa.array([ids], pa.list_(pa.int64()))], ["doc_id", "ids"])

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    return files.mapInArrow(documents, "doc_id long, ids array<long>")


def located(documents: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all documents before one, from the totals of segments and ranges."""
    totals = documents.groupBy("range", "number").agg(F.sum("n_tokens").alias("ids"))
    ranges = totals.groupBy("range").agg(F.sum("ids").alias("ids"))  # as many as the exchange has partitions
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("range").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    of_range = ranges.select("range", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before_range"))
    of_segment = totals.select("range", "number", F.coalesce(F.sum("ids").over(inside), F.lit(0)).alias("before"))
    bases = of_segment.join(of_range, "range").select("range", "number", (F.col("before") + F.col("before_range")).alias("base"))
    return documents.join(bases, ["range", "number"]).withColumn("start", F.col("base") + F.col("first")).drop("base")


def report(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files to the shared folder, read them back, and tell of each document what they hold:
    ``doc_id, start, n_tokens, ids_crc32, segment``."""
    spark = docs.sparkSession
    path = f"{workspace.scratch(spark, 'token-files')}/ids"
    write(docs, path, tokenizer, end_id=end_id)
    found = workspace.stored(read(spark, path), "token-documents")
    return located(found).select(
        "doc_id", "start", "n_tokens", "ids_crc32", F.concat_ws("-", "range", "number").alias("segment")
    )
