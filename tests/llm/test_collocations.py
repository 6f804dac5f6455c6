from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import connect, differences
from trailmark.llm import collocations, oracles
from trailmark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least, longest=5, top=2000):
    """Rows of the result, phrase by phrase."""
    count, size = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang, text = lang or "und", "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = [w for w in re.split("[ \t]", piece) if w]
            size[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, min(longest, len(words) - i) + 1):
                    count[lang, tuple(words[i : i + m])] += 1
    frequent = {key: a for key, a in count.items() if len(key[1]) >= 2 and a >= least}
    inside = set()
    for (lang, phrase), a in frequent.items():
        for i in range(len(phrase)):
            for j in range(i + 2, len(phrase) + 1):
                if j - i < len(phrase) and a == frequent[lang, phrase[i:j]]:
                    inside.add((lang, phrase[i:j]))
    rows = collections.defaultdict(list)
    for (lang, phrase), a in frequent.items():
        if (lang, phrase) not in inside:
            cuts = [(count[lang, phrase[:k]], count[lang, phrase[k:]]) for k in range(1, len(phrase))]
            score, _, l, r = min((1000 * a * size[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            rows[lang].append((-score, -a, " ".join(phrase).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, size[lang], -score)
        for lang, found in rows.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)
    )


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 4)), min_size=1, max_size=40), st.integers(1, 9))
def test_quicksort_counts_prefixes(rows, least):
    columns = [np.array([row[k] if k < len(row) else -1 for row, _ in rows]) for k in range(5)]
    found = {tuple(rows[i][0][:depth]): n for i, depth, n in collocations.frequent_prefixes(columns, np.array([n for _, n in rows]), least)}
    want = collections.Counter()
    for row, n in rows:
        for depth in range(1, len(row) + 1):
            want[tuple(row[:depth])] += n
    assert found == {key: n for key, n in want.items() if n >= least}


def text_of(seed, words, length):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) + pick.choice(["", "", "", "", ",", ".\n", "\t", "  "]) for _ in range(length))


ROWS = [
    *[("en", text_of(i, ["The", "quick", "fox", "naïve", "É", "a"], 60)) for i in range(40)],
    *[("en", "san FRANCISCO bay area bridge and more; of the of the of the")] * 30,
    *[(None, text_of(i, ["x", "y", "\x00", "\x1f", "z\xa0z"], 40)) for i in range(30)],
    ("und", "x y x y x y"),
    *[("de", None), ("de", ""), ("fr", " \t .,;:!?\r\n"), ("es", "one two")],
    ("en", "long text " * 4000),
]


@pytest.mark.parametrize(("least", "chunk", "sort"), [(5, 12 << 20, 1 << 18), (20, 500, 1 << 18), (5, 900, 50)])
def test_rows(spark, monkeypatch, least, chunk, sort):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(collocations, "SORT_ROWS", sort)
    docs = spark.createDataFrame([(i, *row, "x", 7) for i, row in enumerate(ROWS)], "doc_id long, lang string, text string, phrase string, n int")
    assert rows_of(collocations.mine(docs.repartition(6), least=least)) == brute(ROWS, least)


def test_top_and_longest(spark):
    docs = spark.createDataFrame(ROWS, "lang string, text string")
    assert rows_of(collocations.mine(docs, least=4, longest=3, top=7)) == brute(ROWS, 4, 3, 7)
    assert collocations.mine(docs.limit(0), least=1).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 40])
def test_many_suffixes_of_one_lead(spark, limit):
    # suffixes behind the same leading words, so many that they are routed by more words
    pick = random.Random(5)
    found = collections.Counter(
        ("en", " ".join(["of", "the", *[pick.choice("abcd") for _ in range(pick.randint(1, 3))]])) for _ in range(600)
    )
    found.update({("en", "a b c d e"): 50, ("de", "a b c"): 3})
    parts = [(lang, phrase, half) for (lang, phrase), n in found.items() for half in (n - n // 2, n // 2) if half]
    table = spark.createDataFrame(parts, "lang string, phrase string, n long").repartition(5)
    want = collections.Counter()
    for lang, phrase, n in parts:
        words = phrase.split(" ")
        for m in range(2, len(words) + 1):
            want[lang, " ".join(words[:m])] += n
    got = collocations._long_phrases(table, 20, 5, least_wide=limit).collect()
    assert len(got) == len({(r.lang, r.phrase) for r in got})
    assert {(r.lang, r.phrase): r.n for r in got} == {key: n for key, n in want.items() if n >= 20}


def test_large_numbers_are_exact(spark):
    row = spark.createDataFrame([(9_007_199_254_740_991 // 1000, 10**15, 3 * 10**13, 7 * 10**12 + 1)], "a long, n long, l long, r long")
    a, n, l, r = row.first()
    assert row.select(collocations.score()).first()[0] == 1000 * a * n // (l * r)


def test_query(spark):
    con = connect(SF)
    assert differences(QUERIES["op13_collocations"](spark, SF), con, ORACLES["op13_collocations"]) is None
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert differences(collocations.mine(docs, least=6, top=300), con, oracles.collocated("documents", 6, 5, 300)) is None
