from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from trailmark.llm import decontamination as d
from trailmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_shingles(words):
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def plain_best(text, item):
    words, size = plain_words(text), len(plain_words(item))
    target, best = plain_shingles(plain_words(item)), (0.0, None)
    if not words or not size or not target.keys() & plain_shingles(words).keys():
        return best
    n = min(size, len(words))
    for start in range(len(words) - n + 1):
        own = plain_shingles(words[start : start + n])
        shared, total = sum((own & target).values()), sum((own | target).values())
        if shared / total > best[0]:
            best = shared / total, start
    return best


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    expected = {(i, j): best for i, text in docs.items() for j, item in items.items() if (best := plain_best(text, item))[0] >= 0.8}
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in QUERIES["op2_decontamination"](spark, SF).collect()}
    assert got == expected and expected


def test_index_finds_all_within_radius():
    random.seed(2)
    index = d.Index([" ".join(random.choice("abcdefgh") * 3 for _ in range(9)) for _ in range(50)])
    fps = [int(fp) ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 22))) for fp in index.fp for _ in range(30)]
    which, items = index.near(np.array(fps, np.uint64))
    expected = {(i, j) for i, a in enumerate(fps) for j, b in enumerate(index.fp) if (a ^ int(b)).bit_count() <= d.RADIUS}
    assert set(zip(which.tolist(), items.tolist())) == expected


def test_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_ITEMS", 2)
    passage = " ".join(f"w{i}" for i in range(40))
    near = passage.replace("w39", "other")
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "Intro. " + passage.upper() + " end", 0), (3, near, 0), (None, "x " * 50_000 + passage, 0), (5, "two words", 0), (6, "two words more or less", 0)],
        "doc_id long, text string, item_id int",
    )
    items = spark.createDataFrame([(1, passage, "e"), (2, None, "e"), (3, "", "e"), (4, passage, "e"), (None, "Two, words!", "e")], "item_id long, text string, doc_id string")
    found = d.matches(docs, items).collect()
    got = sorted(((r.doc_id, r.item_id, r.start_word, r.n_words, round(r.similarity, 3)) for r in found), key=str)
    same = [(3, 1, 40, 1.0), (3, 0, 40, round(35 / 37, 3)), (None, 50_000, 40, 1.0)]
    assert got == sorted([(doc, item, *rest) for doc, *rest in same for item in (1, 4)] + [(5, None, 0, 2, 1.0)], key=str)
    assert d.matches(docs, items.limit(0)).count() == 0 and d.matches(docs.limit(0), items).count() == 0
