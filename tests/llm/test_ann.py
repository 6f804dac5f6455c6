from __future__ import annotations

import numpy as np
import pytest

from trailmark.llm import ann
from trailmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(rows, every, k):
    """rows: (id, vector). {query: [(id, score)]} over usable, distinct rows."""
    fine = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for i, v in fine:
        if i % every == 0:
            scored = [(j, float(np.dot(np.array(v), np.array(w)))) for j, w in fine if j != i]
            out[i] = sorted(scored, key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def recall(found, truth):
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return np.mean([len(got.get(q, set()) & {j for j, _ in near}) / max(len(near), 1) for q, near in truth.items()])


def test_query(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = QUERIES["op5_ann"](spark, SF).collect()
    assert recall(found, plain(rows, 20, 20)) >= 0.9
    vectors = dict(rows)
    for r in found:
        assert r.query_id % 20 == 0 and r.vec_id != r.query_id
        assert r.score == pytest.approx(float(np.dot(vectors[r.query_id], vectors[r.vec_id])), abs=1e-12)
    for q in {r.query_id for r in found}:
        own = sorted((r.rank, -r.score, r.vec_id) for r in found if r.query_id == q)
        assert [x[0] for x in own] == list(range(1, 21)) and own == sorted(own, key=lambda x: (x[1], x[2]))


def test_full_visits_are_exact_with_norms_and_copies(spark, monkeypatch):
    random = np.random.default_rng(1)
    monkeypatch.setattr(ann, "BLOCK", 16)
    rows = [(i, (random.normal(size=6) * random.uniform(0.1, 9)).tolist()) for i in range(400)]
    rows += [(1000 + i, [10.0, 20.0, 0.0, 5.0, -10.0, 30.0]) for i in range(120)]  # a hot vector
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, leaf string")
    found = ann.search(frame, ann.F.expr("vec_id % 20 = 0"), 20, target=1.0).collect()
    truth = plain(rows, 20, 20)
    got = {}
    for r in sorted(found, key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(truth)
    exact = [got[q] == [j for j, _ in near] for q, near in truth.items()]
    assert np.mean(exact) > 0.95  # calibration saw a part of the queries only
    assert got[1000] == list(range(1001, 1021)) and got[1100] == list(range(1000, 1020))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (20, [0.0, 0.0]), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]), (None, [1.0, 1.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [1.0, 2.0, 3.0]), (4, [])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    found = sorted(map(tuple, ann.search(frame, ann.F.expr("vec_id % 20 = 0")).collect()))
    assert found == [(100, 1, 1, 0.5), (100, 2, 2, 0.5)]
    assert ann.search(frame.limit(0), ann.F.expr("vec_id % 20 = 0")).count() == 0


def test_thin_regions_get_all_their_neighbours(spark):
    random = np.random.default_rng(1)
    rows = []
    for size, many in ((200, 20), (5, 60)):  # tight clusters, the small ones beside the large ones
        for centre in random.normal(size=(many, 2)):
            rows += [v / np.linalg.norm(v) for v in centre + 0.02 * random.normal(size=(size, 2))]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    found = ann.search(frame, ann.F.expr("vec_id % 5 = 0")).collect()
    counts = np.bincount([r.query_id for r in found], minlength=len(rows))[::5]
    assert set(counts.tolist()) == {20}


@pytest.mark.parametrize("n", [15, 20, 21])
def test_few_vectors_come_back_whole(spark, n):
    random = np.random.default_rng(n)
    rows = [(i, random.normal(size=4).tolist()) for i in range(n)]
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ann.F.expr("vec_id % 5 = 0")).collect()
    counts = np.bincount([r.query_id for r in found], minlength=n)[::5]
    assert set(counts.tolist()) == {min(n - 1, 20)}
