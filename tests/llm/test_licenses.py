from __future__ import annotations

import re

import pytest

from checks.compare import connect, differences
from trailmark.llm import license_rules, licenses
from trailmark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain(text, rules):
    """Every rule over the word list, every pair of detections compared."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    line, spans = "".join(f" {w} " for w in words), []
    for rule in rules:
        if rule.keyword in words:
            for m in re.finditer(licenses.spaced(rule.pattern), line):
                start = line[: m.start()].count(" ") // 2
                spans.append((rule, start, start + m.group().count(" ") // 2))
    kept = [
        (r, a, b) for r, a, b in spans
        if not any(
            c <= a and d >= b and (q.priority > r.priority or q.priority == r.priority and (d - c > b - a or d - c == b - a and q.number < r.number))
            for q, c, d in spans
        )
    ]
    base = [(r, a) for r, a, _ in spans if r.base]
    return (
        len(words), len(base), min((a for _, a in base), default=None), max((a for _, a in base), default=None),
        ",".join(sorted({r.label for r, _ in base})), ",".join(sorted({r.label for r, *_ in kept} | {r.label for r, _ in base})),
        max((license_rules.CONFIDENCE[r.priority] for r, *_ in kept), default=0.0),
    )


TEXTS = [
    None, "", "...", "nothing here", "MIT license mit license MIT LICENSE", "Apache License, Version 2.0 and GPLv3",
    "SPDX-License-Identifier: GPL-2.0-or-later", "under the GNU General Public License version 3 or any later version, all rights reserved",
    "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "commit license submit license", "mitlicense mit  \n license",
    "general public license general public license apache license x apache license", "é MIT license ß", "x " * 50_000 + "mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
]


def test_equals_plain_scan(spark):
    rules = license_rules.rules()
    docs = spark.createDataFrame([(i, t, "e") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "e"), (None, TEXTS[5], "e")], "doc_id long, text string, label string")
    got = sorted((tuple(r) for r in licenses.scan(docs).collect()), key=str)
    expected = [(i, *plain(t, rules)) for i, t in enumerate(TEXTS)] + [(4, *plain(TEXTS[4], rules)), (None, *plain(TEXTS[5], rules))]
    assert got == sorted(expected, key=str)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_rules_have_their_keyword():
    rules = license_rules.rules()
    assert len(rules) > 300 and len({r.number for r in rules}) == len(rules)
    for rule in rules:
        assert re.search(rf"\b{rule.keyword}", rule.pattern), rule


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(QUERIES["op1_licenses"](spark, folder), connect(folder), ORACLES["op1_licenses"]) is None


def alternatives(pattern):
    """The patterns without their first group of alternatives, for one choice each; optional parts are left out."""
    pattern = re.sub(r"\(\?:[^()]*\)\?", "", pattern)
    group = re.search(r"\(\?:([^()]*)\)", pattern)
    if not group:
        return [pattern]
    return [x for choice in group[1].split("|") for x in alternatives(pattern[: group.start()] + choice + pattern[group.end() :])]


def test_every_alternative_holds_the_keyword():
    for rule in license_rules.rules():
        for words in alternatives(rule.pattern):
            assert re.search(rf"(?<!\w){rule.keyword}(?![\w?\[])", words), (rule, words)


def test_freebsd(spark):
    texts = ["FreeBSD License", "SPDX-License-Identifier: FreeBSD", "Released under the FreeBSD licence.", "Simplified BSD License"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = license_rules.rules()
    assert sorted(map(tuple, licenses.scan(docs).collect())) == [(i, *plain(t, rules)) for i, t in enumerate(texts)]
    assert all("bsd-2-clause" in plain(t, rules)[5].split(",") for t in texts)
