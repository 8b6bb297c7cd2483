"""Token files: exact round trips, and the query against the tokenizer alone."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from matchloom.llm import queries, token_files
from matchloom.llm.common import table
from tests.conftest import rows

FILE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(FILE)


def expected(plain, data):
    start, out = 0, []
    order = lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()))
    for doc_id, text in sorted(data, key=order):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_query_equals_the_tokenizer(spark, plain):
    data = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert rows(queries.op13_token_files(spark, SF)) == expected(plain, data)


ODD = [
    (3, "Hello  world\n\n x"), (None, "no id"), (1, None), (2, ""), (3, "Hello  world\n\n x"), (3, "another"), (-7, "é   日本語 \U0001f600 don't"),
    (9, "word " * 30000), (10, " \t\r\n\x0b\x0c"), (11, "\x1c\x85　 a"), (None, None), (12, "½ªº µ²x'S 's"),
]


@pytest.mark.parametrize("segment_ids", [1, 40, 1 << 24])
def test_odd_rows_and_segments(spark, plain, tmp_path, segment_ids):
    docs = spark.createDataFrame([(t, 1, 2, i, "c") for i, t in ODD], "text string, start long, range int, doc_id long, segment string")
    token_files.write(docs.repartition(3), str(tmp_path / "ids"), FILE, segment_ids=segment_ids)
    found = token_files.read(spark, str(tmp_path / "ids"))
    assert rows(token_files.located(found), "doc_id", "start", "n_tokens", "ids_crc32") == expected(plain, ODD)
    segments = found.select("range", "number").distinct().count()
    assert segments == len(ODD) if segment_ids == 1 else segments <= len(ODD)
    back = {(r["doc_id"], tuple(r["ids"])) for r in token_files.ids_of(spark, str(tmp_path / "ids")).collect()}
    assert back == {(i, (*plain.encode(t or "", add_special_tokens=False).ids, 2)) for i, t in ODD}


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.report(docs, FILE).count() == 0


def test_changed_bytes_are_noticed(plain):
    segment = token_files.Segment(0, 0)
    segment.add(4, np.arange(1000, dtype="<u4").tobytes())
    data = segment.bytes() + b"\n"
    reader = token_files.Reader(data)
    assert reader.read(300, 20).tolist() == list(range(300, 320))
    with pytest.raises(ValueError, match="changed"):
        token_files.Reader(data[:100] + b"\xff" + data[101:])
    with pytest.raises(ValueError, match="whole"):
        token_files.Reader(data[:-1])


def test_outliers_are_patched_not_widened():
    ids = np.array([7, 5, 6, 2**32 - 1] * 16 + [5] * 192, np.uint32)
    (block,) = token_files.pack(ids)
    least, count, width, patch, exceptions = token_files.BLOCK_HEAD.unpack_from(block)
    assert (least, count, width, patch, exceptions) == (5, 256, 2, 4, 16)
    assert len(block) == token_files.BLOCK_HEAD.size + 256 * 2 // 8 + 16 * (1 + 4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 60000), st.integers(0, 2**32 - 1)), max_size=900), st.sampled_from([1, 50, 90, 100]))
def test_blocks_round_trip(ids, percentile):
    blocks = token_files.pack(np.array(ids, np.uint32), percentile)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].astype(np.int64)
    data = np.frombuffer(b"".join(blocks), np.uint8)
    assert token_files.unpack(data, starts).tolist() == ids


LETTERS = st.text(st.sampled_from("abZé's'tllre  \n\t\r1²½.,-ſ‐“€<|>") | st.characters(max_codepoint=0x2100), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(LETTERS, max_size=5))
def test_pieces_are_those_of_the_tokenizer(texts):
    encoder = token_files.encoder(FILE)
    assert encoder.by_piece
    assert encoder(texts) == encoder.direct(texts)


def test_every_known_character_in_context():
    encoder = token_files.encoder(FILE)
    known = [chr(c) for c in range(0x2100) if token_files.KNOWN.fullmatch(chr(c))]
    texts = [t for c in known for t in (f"a{c}a", f" {c} ", c + c, f"1{c}1", f".{c}.", f"\n{c}", f"{c} \n x{c}", f"'{c}'s{c}")]
    assert encoder(texts) == encoder.direct(texts)
