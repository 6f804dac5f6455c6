from __future__ import annotations

import collections
import hashlib

import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from trailmark.llm import alignment
from trailmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BYTE_LEVEL, PIECES = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def made():
    with open(BYTE_LEVEL, "rb") as a, open(PIECES, "rb") as b:
        return alignment.Tokenizers(a.read(), b.read())


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECES)


def expected(libraries, made, text):
    """Groups of a whole text by its tokens, one after the other."""
    if not text:
        return []
    a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    full = (" " + text).encode()
    if b"".join(made.a_bytes[i] for i in a) != full or b"".join(made.b_bytes[i] for i in b) != full:
        return []
    groups, at_a, at_b, x, y = [], 0, 0, [], []
    a, b = collections.deque(a), collections.deque(b)
    while a or b:
        if at_a <= at_b:
            x.append(a.popleft())
            at_a += len(made.a_bytes[x[-1]])
        else:
            y.append(b.popleft())
            at_b += len(made.b_bytes[y[-1]])
        if at_a == at_b:
            groups.append((tuple(x), tuple(y)))
            x, y = [], []
    return groups


def brute(libraries, made, docs):
    found = [(doc_id, expected(libraries, made, text)) for doc_id, text in docs]
    count = collections.Counter((a[-1], b[-1]) for _, groups in found for a, b in groups)
    most = collections.Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    rows = []
    for doc_id, groups in found:
        links = [(a[-1], b[-1]) for a, b in groups]
        sha = hashlib.sha256(alignment.shown(groups)).hexdigest() if groups else ""
        n_a, n_b = sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups)
        best = sum(count[link] == most[link[1]] for link in links)
        rows.append((doc_id, n_a, n_b, len(groups), len(links), best, sum(count[link] for link in links), sha))
    return sorted(rows, key=str)


TEXTS = st.text(st.sampled_from("aeinrstE '\n\t 12,.é中\U0001f600!ß ﬁ<|>"), max_size=60) | st.text(max_size=40)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_give_the_tokens_of_whole_texts(made, libraries, text):
    chunk = alignment.Chunk(made, "x")
    chunk.add([(1, text), (2, "before the " + text), (3, text)])
    groups = expected(libraries, made, text)
    digest = hashlib.sha256(alignment.shown(groups)).hexdigest() if groups else ""
    row = chunk.row().to_pylist()[0]
    assert row["sha"][0] == row["sha"][2] == digest
    assert (row["n_a"][0], row["n_b"][0], row["n_groups"][0]) == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aeinrst 中é,12"), min_size=1, max_size=60), st.lists(st.integers(0, 80), max_size=4), st.integers(0, 4))
def test_fragments_compose_to_the_whole(made, text, places, bracket):
    found = made.stream(made.pieces(" " + text))
    if found is None:
        return
    a, a_ends, b, b_ends = found
    limits, parts = [0, *sorted(places), 10**6], []
    for low, high in zip(limits, limits[1:], strict=False):
        i, j = ([n for n, end in enumerate(ends) if low < end <= high] for ends in (a_ends, b_ends))
        parts.append(alignment.fragment([a[n] for n in i], [a_ends[n] for n in i], [b[n] for n in j], [b_ends[n] for n in j]))
    whole = alignment.fragment(a, a_ends, b, b_ends)
    cut = min(bracket, len(parts))
    assert alignment.composed(parts) == whole
    assert alignment.compose(alignment.composed(parts[:cut]), alignment.composed(parts[cut:])) == whole
    assert all(alignment._unflat(alignment._flat(p)) == p for p in parts)
    assert alignment.compose(alignment.Fragment(), whole) == whole == alignment.compose(whole, alignment.Fragment())


ROWS = [
    (1, None, "x", 1),
    (2, "", "x", 1),
    (3, "one two, three\nfour", None, 1),
    (3, "one two, three\nfour", None, 1),
    (None, "naïve  café \t x " * 90 + "中文" * 300, "y", 1),
    (5, "<|endoftext|> and </s> are <0x41> plain\r\n", "y", 1),
    (6, "the " * 5000, "y", 1),
    (7, "z" * 900, "y", 1),
    (8, " ", "y", 1),
]


def test_rows(spark, made, libraries):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, sha string, n_a int")
    want = brute(libraries, made, [row[:2] for row in ROWS])
    for size in (1 << 16, 700, 64):  # the smaller, the more texts are cut into ranges
        got = alignment.align(docs, BYTE_LEVEL, PIECES, range_bytes=size).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert alignment.align(docs.limit(0), BYTE_LEVEL, PIECES).count() == 0


def test_query(spark, made, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op12_alignment"](spark, SF).collect()
    assert sorted(map(tuple, rows), key=str) == brute(libraries, made, docs)


def test_ranges_that_begin_at_a_line_break(spark, made, libraries):
    """Words and single line breaks only, so that ranges of many sizes begin in a piece that begins with a line break."""
    texts = ["word\nline of text\n" * 60 + "end", "\n".join(f"l{i} it's" for i in range(300)), "a\nb", "x\n" + "yy " * 200 + "z"]
    rows = [*enumerate(texts), (9, None), (10, "")]
    want = brute(libraries, made, rows)
    for size in (5, 33, 100):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6, "doc_id")
        got = alignment.align(docs, BYTE_LEVEL, PIECES, range_bytes=size).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_partitions_of_empty_texts(spark, made, libraries):
    rows = [(n, None if n % 2 else "") for n in range(8)] + [(None, "some words")]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "doc_id long, text string")
    got = alignment.align(docs, BYTE_LEVEL, PIECES).collect()
    assert sorted(map(tuple, got), key=str) == brute(libraries, made, rows)
