from __future__ import annotations

import base64
import hashlib
import struct

import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm import bpe
from trailmark.llm.queries import QUERIES

PATH = public.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        vocabulary = file.read()
    return bpe.Encoder(vocabulary, public.PATTERN, max_pieces=50), bpe.Decoder(vocabulary)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aeinrst '\n\t12é中文\U0001f600!ßшиَا"), max_size=60) | st.text(max_size=40))
def test_equals_library(encoder, library, text):
    ids = encoder[0].encode(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode_ordinary(text)
    assert encoder[1].decode(ids, chunk=2) == text


def test_dropping_states_changes_nothing(library):
    with open(PATH, "rb") as file:
        small = bpe.Encoder(file.read(), public.PATTERN, max_pieces=1)
    small.transducer.max_states = 3
    for text in ("the reference " * 50, "a" * 3000, "x" * 70 + " déjà vu"):
        ids = small.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode_ordinary(text)


def test_stream_holds_cut_characters():
    stream, data = bpe.Utf8Stream(), "aé中\U0001f600z".encode()
    assert "".join(stream.feed(data[i : i + 1]) for i in range(len(data))) + stream.end() == data.decode()
    assert bpe.Utf8Stream().feed(b"\xe4\xb8") == ""


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "one two", None), (3, "one two", None), (None, "é" * 20000, "y")],
        "doc_id long, text string, ids string",
    )
    decoded = bpe.decode(bpe.encode(docs, PATH, public.PATTERN), PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id, len(r.text), r.n_tokens * 4 == len(r.ids)) for r in decoded) == [
        (False, 1, 0, True), (False, 2, 0, True), (False, 3, 7, True), (False, 3, 7, True), (True, None, 20000, True)
    ]
    assert bpe.encode(docs.limit(0), PATH, public.PATTERN).count() == 0


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_arrays_are_decoded(spark, encoder):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    assert bpe.encode_to_arrays(docs, PATH, public.PATTERN).count() == 2
    assert encoder[0].round_trip("déjà vu 中") == encoder[0].encode("déjà vu 中")
    with pytest.raises(Exception, match="do not decode"):  # a pattern that passes over blanks
        bpe.encode_to_arrays(docs, PATH, "[a-z]+").collect()


def test_tables_are_bounded_within_a_piece(library):
    import random

    with open(PATH, "rb") as file:
        encoder = bpe.Encoder(file.read(), public.PATTERN)
    encoder.transducer.max_states = 500
    text = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=20_000))
    ids = encoder.encode(text)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode_ordinary(text)
    assert len(encoder.transducer.readings) <= 502


def test_digests(spark, library):
    docs = spark.createDataFrame([(1, None, "x"), (2, "déjà vu", "x"), (2, "déjà vu", "x"), (None, "z" * 3000, None)], "doc_id long, text string, ids_sha256 string")
    rows = bpe.digests(docs, PATH, public.PATTERN).collect()
    for text, row in zip(("", "déjà vu", "déjà vu", "z" * 3000), rows, strict=True):
        ids = library.encode_ordinary(text)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digests(docs.limit(0), PATH, public.PATTERN).count() == 0
