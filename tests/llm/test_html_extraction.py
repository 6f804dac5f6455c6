from __future__ import annotations

import html
import itertools
import math
import re

import numpy as np
import pytest

from trailmark.llm import html_extraction as h
from trailmark.llm import labelled_pages as composed
from trailmark.llm.labelled_pages import labelled_pages
from trailmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    page = "<nav><ul><li>a b</li></ul></nav><article><h1>t</h1><p>c d e.</p></article>"
    forest = h.Forest([h.parse(page), h.parse("<p>other</p>")])
    random = np.random.default_rng(3)
    weights, ties = random.normal(0, 0.5, h.N_FEATURES), random.normal(0, 1, (2, 2))
    odds, n = forest.x @ weights, len(forest.parent)
    odds[forest.given] = -50
    total, ones = 0.0, np.zeros(n)
    for states in itertools.product((0, 1), repeat=n):
        tied = sum(ties[states[p], s] for p, s in zip(forest.parent, states) if p >= 0)
        weight = math.exp(sum(o for o, s in zip(odds, states) if s) + tied)
        total += weight
        ones += weight * np.array(states)
    assert h.marginals(forest, weights, ties)[0] == pytest.approx(ones / total)


def test_held_out_pages():
    pages = [h.parse(page) for page in labelled_pages(150, seed=77)]
    model = h.default_model()
    forest = h.Forest(pages)
    content = h.marginals(forest, model.weights, model.ties)[0] >= 0.5
    pairs = [(page.label[e], content[at + e]) for page, at in zip(pages, forest.offset) for e, _, _ in page.blocks]
    right = sum(a and b for a, b in pairs)
    assert right >= 0.97 * sum(a for a, _ in pairs) and right >= 0.97 * sum(b for _, b in pairs)


def test_cases():
    page = """<html><body><header><p>Site</p></header><div id="cookie"><p>We use cookies. Accept?</p></div>
    <main><h1>Title &amp; more</h1><p>First <b>bold</b>
    text&nbsp;with a <a href=x>link</a>, and more of it to read.<p>Second paragraph, not closed, has some words in it.
    <script>var x = "<p>no</p>";</script><style>p{}</style><ul><li>One item of the list<li>Another item of it</ul></main>
    <section class="comments"><p>Nice article, I liked reading this one a lot.</p></section>
    <form class="newsletter"><label>Mail</label><input></form><footer>&copy; 2020 Site</footer></body></html>"""
    assert h.default_model().extract([page]) == [
        "Title & more\n\nFirst bold text with a link, and more of it to read.\n\nSecond paragraph, not closed, has some words in it."
        "\n\nOne item of the list\n\nAnother item of it"
    ]


def test_odd_rows(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    long = "<article>" + "<p>Some words of a paragraph, again and again.</p>" * 5000 + "</article>"
    rows = [(1, None, None, 0), (2, "u", "", 0), (3, "u", deep, 0), (3, "u", deep, 0), (None, "u", long, 0), (5, "u", "<p", 0), (6, "u", "</p></div><td>&#x110000;&bogus;", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = h.extract(pages).collect()
    assert len(found) == 7 and found[0].text == found[1].text == ""
    assert found[4].text == "\n\n".join(["Some words of a paragraph, again and again."] * 5000)
    assert h.extract(pages.limit(0)).count() == 0


FIRST = "The first part of the old page tells of the harbour, its boats, and of the people who work there all year."
SECOND = "The second part goes on about the market, where fish, bread and tools are sold, and about the long winter."


def test_loose_text_is_judged():
    model = h.default_model()
    page = f"<html><body><a href=x>Home</a> | <a href=y>News</a><hr>{FIRST}<br><br>{SECOND}<hr>&copy; 1998 Site</body></html>"
    assert model.extract([page]) == [f"{FIRST}\n\n{SECOND}"]
    assert model.extract([f"{FIRST}<p>{SECOND}"]) == [f"{FIRST}\n\n{SECOND}"]
    assert model.extract([FIRST]) == [FIRST]
    pages = [h.parse(page) for page in composed.loose_pages(150, seed=78)]
    forest = h.Forest(pages)
    content = h.marginals(forest, model.weights, model.ties)[0] >= 0.5
    pairs = [(page.label[e], content[at + e]) for page, at in zip(pages, forest.offset) for e, _, _ in page.blocks]
    right = sum(a and b for a, b in pairs)
    assert right >= 0.95 * sum(a for a, _ in pairs) and right >= 0.95 * sum(b for _, b in pairs)


@pytest.mark.parametrize(
    "unseen",
    [
        "<datalist id=d><option value=a><option value=b></datalist>", "<datalist><option value=a>Label<option>Other</datalist>", "<select><option>a<option>b</select>",
        "<noscript><div><p>Please enable it</noscript>", "<noscript><div><p>Please</p></div></noscript>", "<div><svg><g><text>s</text></div>", "<span><svg><path></span>",
        "<div><object><div>o</div></div>", "<a href=x><template><p>t</a>", "<div><select><option>a</div>", "<svg><title>t</title><path/><foreignObject><p>f</p></foreignObject></svg>", "<svg><path>", "<br/><svg/>",
        "<select><option>a<input>", "<template><li>x<li>y<template>z</template>w</template>", "<object><param name=a><p>o</object>",
    ],
)
def test_unseen_elements_end(unseen):
    page = h.parse(f"<body><article><p>{FIRST}</p>{unseen}<p>{SECOND}</p></article>")
    assert [text for _, text, _ in page.blocks] == [FIRST, SECOND]
    assert [page.tag[element] for element, _, _ in page.blocks] == ["p", "p"]
    assert page.tag[page.parent[page.blocks[1][0]]] == "article"


def test_labels_of_pages_are_not_read():
    model = h.default_model()
    page = "<body><div class='ad' data-content={}>Buy now</div><article data-content={}><p>" + FIRST + "</p></article>"
    assert model.extract([page.format("x", "y"), page.format(1, 0), page.format("'[]'", "3.5")]) == [FIRST] * 3


def plain(page):
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.sub(r"<[^>]*>", " ", re.sub(r"</?(h1|p)>", "\0", article)).split("\0")
    return "\n\n".join(text for block in blocks if (text := " ".join(html.unescape(block).split())))


def test_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op4_html"](spark, SF).collect()
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    assert sum(r.text == plain(pages[r.page_id]) for r in rows) >= 0.98 * len(rows)
