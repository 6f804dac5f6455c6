from __future__ import annotations

import hashlib
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from trailmark.llm import substring_dedup as sub
from trailmark.llm.queries import QUERIES
from trailmark.session import materialize

SF = "/root/testdata/sf0.001"


def plain(docs, length=50):
    """docs: (doc_id, text), ids None first. (doc_id, n_bytes, n_removed, n_spans, kept) of each."""
    order = lambda d: (d is not None, d or 0)
    first = {}
    for doc, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            first[s] = min(first.get(s, order(doc)), order(doc))
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < order(doc):
                gone[p : p + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone)), kept))
    return out


def rows(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in frame.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = sorted((d, n, m, s, hashlib.sha256(k).hexdigest()) for d, n, m, s, k in plain(docs))
    assert sorted(map(tuple, QUERIES["op10_substring_dedup"](spark, SF).collect())) == expected
    assert any(row[2] for row in expected)


def test_edits_and_hot_passage(spark):
    random.seed(8)
    word = lambda: "".join(random.choice("abé ") for _ in range(random.randint(1, 5)))
    base = [" ".join(word() for _ in range(random.randint(0, 80))) for _ in range(12)]
    passage = " ".join(word() for _ in range(30))
    docs = []
    for i in range(90):
        text = random.choice(base)
        if i % 3 == 0:
            at = random.randint(0, len(text))
            text = text[:at] + random.choice(["#", "", "xyz"]) + text[at + random.randint(0, 3) :]
        docs.append((i, text + passage * (i % 4 == 0) + word()))
    long = "".join(random.choice("abcdefgh") for _ in range(1_300_000))  # longer than a piece
    docs += [(95, long), (96, "x" + long[3:600_000] + "y" + long[600_001:]), (100, "a" * 2000), (101, "b" + "a" * 60), (102, "ab" * 90), (103, "ba" * 40)]
    assert rows(sub.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))) == sorted(plain(docs), key=str)


def test_odd_rows(spark):
    line = "a line that is certainly longer than fifty bytes in all, is it not"
    docs = [(1, None), (2, ""), (3, line), (3, line), (3, line + line), (None, line), (None, "x" + line), (9, "0" * 49), (10, "0" * 49), (11, "é" * 60_000), (12, "é" * 25)]
    frame = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, start string")
    assert rows(sub.remove_repeats(frame)) == sorted(plain(docs), key=str)
    assert sub.remove_repeats(frame.limit(0)).count() == 0


def test_repeated_rows_are_parsed_once(spark):
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefgh ") for _ in range(9))
    passage, other = " ".join(word() for _ in range(12)), " ".join(word() for _ in range(12))
    docs = [(1, passage)] + [(5, "x" + passage + other)] * 40 + [(None, other + "y")] * 40 + [(6, other + passage)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = sub.spans(frame).groupBy("own_id", "text_hash", "start", "size").count()
    assert found.where("count > 1").count() == 0 and found.count() > 0
    assert rows(sub.remove_repeats(frame)) == sorted(plain(docs), key=str)


def test_few_keys_make_a_small_bitmap(spark):
    random.seed(3)
    keys = [random.randint(-(2**63), 2**63 - 1) for _ in range(1000)]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    bitmap = sub._bitmap(frame, "key")
    assert bitmap.nbytes <= 1 << 16
    assert all(sub._is_set(bitmap, key) for key in keys)
    assert frame.where(sub._has(spark.sparkContext.broadcast(bitmap), frame["key"])).count() == len(keys)
    assert sum(sub._is_set(bitmap, random.randint(0, 2**64 - 1)) for _ in range(2000)) < 60
    empty = sub._bitmap(frame.limit(0), "key")
    assert not any(sub._is_set(empty, key) for key in keys)


def test_search_writes_neither_texts_nor_strings(spark, monkeypatch):
    random.seed(12)
    char = lambda n: "".join(random.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    base = [char(3000) for _ in range(30)]
    docs = []
    for i in range(150):
        text = base[i % 30]
        for _ in range(3):  # edits, so that phrases beside them stay open in texts that go apart from these
            at = random.randint(0, len(text))
            text = text[:at] + char(9) + text[at:]
        docs.append((i, text))
    written = []

    def recorded(df, name):
        found = materialize(df, name)
        written.extend(p.stat().st_size for p in Path(found.staged_path).glob("*.parquet"))
        return found

    monkeypatch.setattr(sub, "materialize", recorded)
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(4)
    assert rows(sub.remove_repeats(frame)) == sorted(plain(docs), key=str)
    assert sum(written) < 2.5 * sum(len(text) for _, text in docs)


def test_bitmaps_hold_documents_only(spark, monkeypatch):
    random.seed(13)
    char = lambda n: "".join(random.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passages = [char(2000) for _ in range(10)]
    docs = [(i, char(1000) + passages[i % 10] + char(10)) for i in range(20)]
    keys, bitmap = [], sub._bitmap

    def recorded(frame, column):
        keys.append(frame.count())
        return bitmap(frame, column)

    monkeypatch.setattr(sub, "_bitmap", recorded)  # of phrases and strings, a bitmap of bounded size is full on a large corpus
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(4)
    assert rows(sub.remove_repeats(frame)) == sorted(plain(docs), key=str)
    assert keys and max(keys) <= len(docs)


def test_answers_are_in_the_order_of_the_keys():
    rng = np.random.default_rng(5)
    ids = np.array([-(2**63), 3, 2**62], np.int64)
    keys = [rng.integers(0, 6, 40).astype(np.uint64) for _ in range(3)]
    for more in (None, [rng.integers(0, 2, 40).astype(np.uint64) for _ in range(3)]):
        asked = []
        for i in range(3):
            chunk = sub._Chunk(i, b"", own_id=ids[i:], text=np.zeros(40, np.int32), start=np.zeros(0), size=np.zeros(0))
            found = (np.arange(40), np.arange(40), np.ones(40, np.int64), keys[i] << np.uint64(35), more and more[i])
            asked.append(sub._Asked(chunk, lambda *_, found=found: found, 50))
        dealt = [pa.Table.from_batches([a.dealt(i, 6)]) for i, a in enumerate(asked)]
        buckets = sorted({b for t in dealt for b in t["bucket"].to_pylist()})
        answers = [sub._judged(pa.concat_tables([t.filter(pc.equal(t["bucket"], b)) for t in dealt])) for b in buckets]
        table = pa.concat_tables(answers)
        for i, a in enumerate(asked):
            left, earlier = a.answered(table.filter(pc.equal(table["chunk"], i)), 6)
            for j, key in enumerate(keys[i]):
                if more is None:
                    assert left[j] == (sum(key in k for k in keys) > 1) and not earlier[j]
                else:
                    alike = [o for o in range(3) if ((keys[o] == key) & (more[o] == more[i][j])).any()]
                    several = len({m for o in range(3) for k, m in zip(keys[o], more[o]) if k == key}) > 1
                    assert earlier[j] == (min(alike) < i) and left[j] == (not earlier[j] and several)


def test_gates_keep_all_shared_strings(spark):
    text, other = "".join(random.Random(1).choices("abcdefgh", k=400)), "".join(random.Random(2).choices("abcdefgh", k=400))
    for length in (24, 120):
        pair = [(1, other[:200] + text[:150] + other[200:]), (2, text[:130] + other[:9] + text[130:])]
        frame = spark.createDataFrame(pair, "doc_id long, text string")
        assert rows(sub.remove_repeats(frame, length)) == sorted(plain(pair, length), key=str)


def test_stretches_are_merged_by_text():
    lists = [[(5, 50), (0, 50), (80, 20)], None, [(0, 10), (10, 10)], [], [(3, 7)]]
    lost = pa.array([None if x is None else [{"start": a, "size": b} for a, b in x] for x in lists], pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())])))
    expected = [[(0, 55), (80, 20)], [], [(0, 20)], [], [(3, 7)]]
    assert sub._merged(lost, [100, 8, 20, 0, 10]) == expected
    assert sub._merged(lost.slice(1, 3), [8, 20, 0]) == expected[1:4]
    assert sub._merged(lost.slice(0, 0), []) == []
