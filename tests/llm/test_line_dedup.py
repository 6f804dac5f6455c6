from __future__ import annotations

import random

import pytest

from checks.compare import connect, differences
from trailmark.llm import line_dedup
from trailmark.llm.queries import ORACLES, QUERIES


def plain(docs, run_lines=4, line_words=6):
    """docs: (doc_id, text) in order. The text left of each."""
    seen_lines, seen_runs, out = set(), set(), []
    for _, text in docs:
        raw = text.split("\n")
        filled = [i for i, line in enumerate(raw) if line.strip()]
        bare = [raw[i].strip() for i in filled]
        gone = set()
        for s in range(len(bare)):
            run = tuple(bare[s : s + run_lines])
            if len(run) == run_lines and run in seen_runs:
                gone |= set(range(s, s + run_lines))
            seen_runs.add(run)
            if bare[s] in seen_lines and len(bare[s].split()) >= line_words:
                gone.add(s)
            seen_lines.add(bare[s])
        lost = {filled[s] for s in gone}
        out.append(("\n".join(line for i, line in enumerate(raw) if i not in lost), len(gone)))
    return out


def test_equals_plain_dedup(spark):
    random.seed(5)
    words = ["a", "b", "c d", "e f g h i j k", " x ", "", "long line of six words here"]
    docs = [(i, "\n".join(random.choice(words) for _ in range(random.randint(0, 14)))) for i in range(150)]
    docs += [(150 + i, "one\ntwo\n\nthree\nfour\nfive\nsix") for i in range(30)]  # a hot run
    docs.append((500, "\n".join(["same"] * 3000)))  # a run that overlaps itself
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(r.text, r.n_removed) for r in sorted(got, key=lambda r: r.doc_id)] == plain(docs)


def test_odd_rows(spark):
    line = "this line has more than six words"
    rows = [(None, line, 1, "p"), (1, None, 2, "p"), (2, "", 3, "p"), (3, line, 4, "p"), (3, line, 4, "p"), (4, "own\n" + line, 5, None), (5, "\n \n", 6, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, place string")
    found = line_dedup.dedup_lines(docs)
    assert found.columns == ["doc_id", "text", "place", "n_lines", "n_removed", "n_runs"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == sorted(
        [(None, line, "p", 1, 0, 0), (1, None, "p", 0, 0, 0), (2, "", "p", 0, 0, 0), *[(3, "", "p", 1, 1, 1)] * 2, (4, "own", None, 2, 1, 1), (5, "\n \n", "p", 0, 0, 0)],
        key=str,
    )
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(QUERIES["op9_line_dedup"](spark, folder), connect(folder), ORACLES["op9_line_dedup"]) is None


def test_repeated_rows_are_parsed_once(spark):
    text = "one line of the text\nanother line of the text"
    docs = spark.createDataFrame([(7, text)] * 50 + [(None, text)] * 50, "doc_id long, text string")
    ranked = line_dedup.repeated_lines(docs)
    assert ranked.groupBy("doc_id").count().orderBy("doc_id").collect() == [(None, 2), (7, 2)]
    assert line_dedup.repeated_lines(docs.where("doc_id = 7")).count() == 0
    got = line_dedup.dedup_lines(docs, 2).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0)] * 50 + [(7, 2)] * 50


@pytest.mark.parametrize("run_lines", [3, 5, 7])
def test_runs_of_any_length(spark, run_lines):
    random.seed(run_lines)
    words = ["a", "b", "c d", " x ", ""]
    docs = [(i, "\n".join(random.choice(words) for _ in range(random.randint(0, 14)))) for i in range(150)]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), run_lines).collect()
    assert [(r.text, r.n_removed) for r in sorted(got, key=lambda r: r.doc_id)] == plain(docs, run_lines)
