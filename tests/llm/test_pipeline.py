from __future__ import annotations

import base64

import public_tokenizers as public
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from trailmark.llm import quality

from .test_decontamination import plain_best
from .test_line_dedup import plain as plain_lines
from .test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert {f"op{n}_" for n in range(1, 14)} == {name[: name.index("_") + 1] for name in entry.queries() if name[:2] == "op" and name[2].isdigit()}


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = sorted((r.doc_id, r.text) for r in docs.collect())
    model = quality.train(docs, labels)
    stages = dict(zip(("quality", "lines", "near", "benchmark", "ids"), (f for _, f in corpus_pipeline.STAGES)))

    def check(name, docs):
        found = stages[name](spark, docs, SF)
        assert found.columns == docs.columns
        rows = found.collect()
        assert sorted((r.doc_id, r.text) for r in rows) == expected
        assert all(r.n_chars == len(r.text) for r in rows)
        return spark.createDataFrame(rows, docs.schema)

    expected = [(i, t) for i, t in expected if model.score(t) >= 0.3]
    docs = check("quality", docs)
    expected = [(i, new) for (i, _), (new, lost) in zip(expected, plain_lines(expected)) if not lost or new.strip()]
    docs = check("lines", docs)
    roots = plain_components([plain_fingerprint(t) for _, t in expected], 4)
    expected = [row for n, row in enumerate(expected) if roots[n] == n]
    docs = check("near", docs)
    expected = [(i, t) for i, t in expected if all(plain_best(t, item)[0] < 0.8 for item in items)]
    docs = check("benchmark", docs)
    with open(public.path(corpus_pipeline.VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = sorted((r.doc_id, r.n_tokens, list(r.token_ids)) for r in stages["ids"](spark, docs, SF).collect())
    assert ids == [(i, len(x), x) for i, x in ((i, library.encode_ordinary(t)) for i, t in expected)]
    assert sorted((r.doc_id, r.n_tokens, list(r.token_ids)) for r in corpus_pipeline.run(spark, SF).collect()) == ids


def test_odd_rows_and_empty_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "Some plain words of a text.", "en", "s", 27), (4, "Some plain words of a text.", "en", "s", 27), (4, "Some plain words of a text.", "en", "s", 27)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema if name != "byte-level bpe" else "doc_id long, n_tokens long, token_ids array<int>")


def test_own_columns_named_like_counts_are_kept(spark):
    rows = [(1, "one line of six words here\nother", "a", True), (2, "one line of six words here\nmore", "b", None), (3, None, None, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string, n_removed boolean")
    found = corpus_pipeline.without_repeated_lines(spark, docs, SF)
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    assert sorted(map(tuple, found.collect()), key=str) == sorted([rows[0], (2, "more", "b", None), rows[2]], key=str)
