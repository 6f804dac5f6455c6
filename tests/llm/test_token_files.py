from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trailmark.llm import token_files
from trailmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public.path("word_bpe_49k.json")
END = 2


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return token_files.WordEncoder(file.read(), END)


def expected(library, docs):
    """Rows of the result from documents in their order, one after the other."""
    start, rows = 0, []
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, END]
        rows.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return rows


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aeSinrst'’ \n\t\r\x1c\x85\xa012éÀ×ÿſŀ,.;́中\U0001f600!ßΣİ<|>"), max_size=60) | st.text(max_size=40))
def test_words_give_the_ids_of_whole_texts(encoder, library, text):
    for t in (text, text + "<|endoftext|>" + text, text + " café, naïve. THE x'S 3.14, don't; Ünter " + text):
        ids = encoder.encode([t])[0]
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == [*library.encode(t, add_special_tokens=False).ids, END]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50), max_size=3000))
def test_blocks_round_trip(values):
    found = token_files.pack(np.array(values, np.uint32))
    assert len(found) == -(-len(values) // token_files.BLOCK)
    assert [int(v) for block in found for v in token_files.unpack(block)] == values


def test_outliers_do_not_widen_a_block():
    plain = np.arange(1024, dtype=np.uint32) % 16 + 70_000
    odd = plain.copy()
    odd[::100] = 4_000_000_000
    (narrow,), (patched,) = token_files.pack(plain), token_files.pack(odd)
    assert len(narrow) < 1024 * 4 // 8 + 20 and len(patched) == len(narrow) + 6 * 11


def test_any_part_of_a_file():
    sink = pa.BufferOutputStream()
    writer, lengths = token_files.FileWriter(sink), [0, 5000, 1, 0, 1023, 1024, 2049, 0]
    texts = [np.arange(n, dtype="<u4").tobytes() for n in lengths]
    writer.add([None, 2, 3, 4, 5, 6, 7, 8], texts)
    writer.close()
    reader = token_files.FileReader(pa.BufferReader(sink.getvalue()))
    for limits in ([0, 9097], [0, 5000, 9097], [0, 1, 5001, 7048, 7049, 9097], [*range(0, 9097, 700), 9097]):
        rows = []
        for low, high in zip(limits, limits[1:], strict=False):
            for batch in reader.documents(low, high, 10, high == 9097):
                rows += batch.to_pylist()
        assert [(r["doc_id"], r["n_tokens"], r["ids"]) for r in rows] == list(zip([None, 2, 3, 4, 5, 6, 7, 8], lengths, texts, strict=True))
        assert [r["start"] for r in rows] == [10, 10, 5010, 5011, 5011, 6034, 7058, 9107]


def test_rows(spark, library, tmp_path):
    rows = [(9, "zebra one", "x"), (3, None, "x"), (3, None, "x"), (None, "null id", None), (-4, "word " * 9000, "y"), (7, "", "y"), (8, " \n ", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    token_files.write(docs, str(tmp_path / "some"), PATH, END)
    got = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in token_files.read(spark, str(tmp_path / "some")).collect()]
    ordered = sorted([row[:2] for row in rows], key=lambda row: (row[0] is not None, row[0] or 0))
    assert sorted(got, key=lambda r: r[1]) == expected(library, ordered)

    token_files.write(docs.limit(0), str(tmp_path / "none"), PATH, END)
    assert token_files.read(spark, str(tmp_path / "none")).collect() == []


def test_rows_of_one_id_lie_in_one_fixed_order(spark, library, tmp_path):
    # half of the rows are the same one; texts of an id come by hash, whatever order they arrive in
    rows = [(1, "alike")] * 300 + [(1, f"text {i}") for i in range(300)]
    seen = []
    for name, some in (("a", rows), ("b", rows[::-1])):
        docs = spark.createDataFrame(some, "doc_id long, text string").repartition(7)
        token_files.write(docs, str(tmp_path / name), PATH, END)
        found = token_files.read(spark, str(tmp_path / name)).collect()
        seen.append([bytes(r.ids) for r in sorted(found, key=lambda r: r.start)])
        assert [r.start for r in sorted(found, key=lambda r: r.start)] == list(np.cumsum([0, *[r.n_tokens for r in sorted(found, key=lambda r: r.start)]])[:-1])
    assert seen[0] == seen[1] and len(seen[0]) == 600


def test_only_committed_files_are_read(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")
    token_files.write(docs, str(tmp_path / "t"), PATH, END)
    (tmp_path / "t" / "000000-lost.pfor").write_bytes(b"half a file")
    assert token_files.read(spark, str(tmp_path / "t")).count() == 2


def test_query(spark, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = QUERIES["op11_token_files"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == expected(library, docs)
