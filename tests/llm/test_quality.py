from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pytest

from trailmark.llm import quality
from trailmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def toy_model():
    random = np.random.default_rng(4)
    n = quality.N_FEATURES
    return quality.Model(random.normal(0, 0.3, n), random.normal(0, 1, (2, 2)), np.zeros(n), np.ones(n))


def test_marginals_equal_enumeration():
    model, lines = toy_model(), ["One line.", "TWO!! LINES", "a | b | c", "One line.", "x"]
    odds = quality.features(lines) @ model.weights
    weights = {
        states: math.exp(sum(o for o, s in zip(odds, states) if s) + sum(model.ties[a, b] for a, b in itertools.pairwise(states)))
        for states in itertools.product((0, 1), repeat=len(lines))
    }
    total = sum(weights.values())
    plain = [sum(w for s, w in weights.items() if s[i]) / total for i in range(len(lines))]
    assert model.line_marginals(lines) == pytest.approx(plain)
    sizes = [len(line) for line in lines]
    assert model.score("\n \n".join(lines)) == pytest.approx(sum(p * n for p, n in zip(plain, sizes)) / sum(sizes))


def test_expectations_equal_single_sequences():
    model = toy_model()
    texts = [["a b c", "D!!"], ["one"], ["x", "y z", "| |", "end."]]
    odds, live = np.zeros((3, 4)), np.zeros((3, 4), bool)
    for i, lines in enumerate(texts):
        odds[i, : len(lines)] = quality.features(lines) @ model.weights
        live[i, : len(lines)] = True
    node, _ = quality._expectations(odds, model.ties, live)
    for i, lines in enumerate(texts):
        assert node[i, : len(lines)] == pytest.approx(model.line_marginals(lines))


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op3_quality"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert row.predicted == (row.score >= 0.3) and 0 <= row.score <= 1
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(tested) > 50 and sum(a == b for a, b in tested) >= 0.97 * len(tested)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "A line.\n" * 20_000, "x"), (3, "A line.\n" * 20_000, "x"), (None, "word " * 50_000, None), (5, "| " * 50, "x")],
        "doc_id long, text string, quality string",
    )
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 6)] + [(3, None, 0), (None, 1, 0), (5, 1, 0)], "doc_id long, quality int, text int")
    scored = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(scored) == 6 and all(0 <= r.score <= 1 for r in scored)
    by = {(r.doc_id, r.text_hash): r.score for r in scored}
    assert len(by) == 5 and len({by[k] for k in by if k[0] in (1, 2)}) == 1
    assert quality.train(docs, labels.limit(0)) is None
    assert quality.score(docs.limit(0), None).count() == 0


def fitted_to(spark, monkeypatch, docs, labels, **bounds):
    """What ``train`` hands to ``fit``: the features and the label of each document."""
    monkeypatch.setattr(quality, "fit", lambda sequences, labels: list(zip(sequences, labels)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    return quality.train(*frames, **bounds)


def test_whole_documents_are_learnt_once_each(spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:4]
    long = "\n".join(["Clean words stand here."] * 50 + ["| junk | !!"] * 50)
    docs = [(ids[0], long)] * 30 + [(ids[1], "One text."), (ids[1], "Another text,\nof two lines.")] + [(ids[2], "A.\nB.\nC."), (ids[3], "D.")]
    found = fitted_to(spark, monkeypatch, docs, [(i, i % 2) for i in ids])
    assert [y for _, y in found] == [i % 2 for i in ids]
    assert found[0][0] == pytest.approx(quality.features(long.split("\n")), abs=1e-5)
    assert len(found[1][0]) == len(fitted_to(spark, monkeypatch, docs[::-1], [(i, 0) for i in ids])[1][0])
    assert sorted(len(x) for x, _ in fitted_to(spark, monkeypatch, docs, [(i, 0) for i in ids], max_lines=6)) in ([1, 1, 3], [1, 2, 3])
    assert len(fitted_to(spark, monkeypatch, [(ids[0], long)], [(ids[0], 1)], max_lines=6)[0][0]) == 100


def test_long_sequences(monkeypatch):
    model, random = toy_model(), np.random.default_rng(6)
    lines = [random.choice(["a b c", "D!!", "x | y", "end."]) for _ in range(300)]
    odds = (quality.features(lines) @ model.weights)[None]
    assert quality._expectations(odds, model.ties, np.ones((1, 300), bool))[0][0] == pytest.approx(model.line_marginals(lines))
    good, bad = quality.features(["Some words of a text."] * 40), quality.features(["| !! |"] * 700)
    fitted = quality.fit([good, bad], [1, 0])
    assert fitted.score("Some words of a text.\n" * 5) > 0.5 > fitted.score("| !! |\n" * 5)
