"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a variable, content or not. Its own look (tag, class and id words, text and link counts) gives its
potential, and each pair of parent and child has one. Sum-product messages go up from the leaves and down from the root, and
give the exact marginal of every element; the weights are trained on labelled pages by the exact likelihood gradient. The
pages of a batch make one forest, whose levels are computed side by side.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .labelled_pages import labelled_pages, loose_pages

_GROUPS = (
    ("p",), ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("li", "dd", "dt"), ("ul", "ol", "dl", "menu"), ("nav",), ("header", "hgroup"), ("footer", "address"),
    ("aside",), ("form", "fieldset", "legend", "label", "button"), ("article",), ("main",), ("section",), ("div", "center"),
    ("table", "tbody", "thead", "tfoot", "tr", "caption"), ("td", "th"), ("blockquote", "pre"), ("figure", "figcaption", "details", "summary"),
    ("html", "body"), ("ins", "iframe", "dialog"), ("#text",),
)
_GROUP = {tag: i for i, tags in enumerate(_GROUPS) for tag in tags}
#: elements whose text is never shown as text of the page
_UNSEEN = frozenset("script style noscript template title textarea select datalist svg math object canvas audio video".split())
#: tags that end a drawing or formula left open, and the elements in which they don't
_ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span "
    "strong strike sub sup table tt u ul var".split()
)
_HOSTS = frozenset("foreignobject desc title annotation-xml".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OPTIONAL = frozenset("p li dt dd option optgroup tr td th tbody thead tfoot rt rp".split())
_CLOSES = {tag: frozenset(tags.split()) for tag, tags in {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th"}.items()}

#: words of class, id and role by what they hint at
_HINTS = (
    "article content post entry story body main text articlebody prose",
    "nav menu navbar breadcrumb breadcrumbs navigation pagination pager toc",
    "header masthead topbar top banner logo",
    "footer copyright contentinfo legal bottom",
    "ad ads advert advertisement adsbygoogle sponsor sponsored promo promotion",
    "side sidebar widget related recommended complementary teaser more",
    "cookie consent notice alert popup modal gdpr overlay warning",
    "comment comments commentlist disqus reply replies responses discussion",
    "form newsletter subscribe search login signup",
    "share social tags meta byline author date",
)
_HINT = {word: i for i, words in enumerate(_HINTS) for word in words.split()}
_WORD = re.compile(r"[a-z]+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Block elements in document order, and the text blocks with the element each belongs to.

    A run of text that stands in ``body`` or the root itself is an element ``#text`` of its own.
    """

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hints: list[tuple[int, ...]] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # element, text, words in links


class _Builder(HTMLParser):
    def __init__(self, labelled: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.labelled = labelled
        self.open: list[int] = []
        self.unseen: list[str] = []  # the unseen element and what is open in it
        self.inside, self.inline = Counter(), Counter()  # open tags: in the unseen element, and outside it those that are no blocks
        self.mark: str | None = None  # the label of loose text, from a span in it
        self.breaks = 0  # since the last text
        self.text: list[str] = []
        self.links, self.linked = 0, 0
        self._add("html", [])

    def _add(self, tag: str, attrs: list) -> None:
        page, above = self.page, self.open[-1] if self.open else -1
        values = {key: value or "" for key, value in attrs}
        found = " ".join(values.get(key, "") for key in ("class", "id", "role", "itemprop"))
        words = {word.lower() for part in found.split() for word in (*_PARTS.findall(part), part)}
        own = tuple(sorted({_HINT[word] for word in words if word in _HINT}))
        inherited = page.label[above] if above >= 0 else 0
        page.parent.append(above)
        page.tag.append(tag)
        page.hints.append(own)
        page.label.append(int(values.get("data-content") or inherited) if self.labelled else 0)
        self.open.append(len(page.parent) - 1)

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            loose = self._loose()
            if loose:
                self._add("#text", [("data-content", self.mark)] if self.mark else [])
            self.page.blocks.append((self.open[-1], text, self.linked))
            if loose:
                self.open.pop()
        self.text, self.linked, self.breaks, self.mark = [], 0, 0, None

    def _loose(self) -> bool:
        return self.page.tag[self.open[-1]] in ("html", "body")

    def _close(self, depth: int) -> None:
        self._flush()
        del self.open[depth:]

    def _leave(self, depth: int) -> None:
        self.inside.subtract(self.unseen[depth:])
        del self.unseen[depth:]

    def _start_unseen(self, tag: str, empty: bool) -> bool:
        """Whether the tag stays within an unseen element."""
        if tag in _ENDS_FOREIGN and not any(self.inside[name] > 0 for name in _HOSTS):
            for name in ("svg", "math"):
                if self.inside[name] > 0:
                    self._leave(self.unseen.index(name))
        elif self.inside["select"] > 0 and tag in ("input", "textarea", "select"):
            self._leave(len(self.unseen) - 1 - self.unseen[::-1].index("select"))
            if tag == "select":  # stands for the end tag
                return True
        if not self.unseen:
            return False
        if tag not in _VOID and not empty and not (tag in _OPTIONAL and self.unseen[-1] == tag):
            self.unseen.append(tag)
            self.inside[tag] += 1
        return True

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.unseen and self._start_unseen(tag, False):
            return
        if tag in _UNSEEN:
            self.unseen.append(tag)
            self.inside[tag] += 1
            return
        if tag not in _GROUP and tag not in _VOID:
            self.inline[tag] += 1
            if tag == "span" and self.labelled:
                self.mark = dict(attrs).get("data-content") or self.mark
        if tag == "br" or tag == "hr":
            self.text.append(" ")
            self.breaks += 1
            if self._loose() and (tag == "hr" or self.breaks > 1):
                self._flush()
        elif tag == "a":
            self.links += 1
        elif tag in ("html", "body") and len(self.open) == 1 and tag not in self.page.tag[1:]:
            self._flush()
            if tag == "body":
                self._add(tag, attrs)
        elif tag in _GROUP and tag not in ("html", "body"):
            self._flush()
            tags = [self.page.tag[i] for i in self.open[-4:]]
            if tags[-1] == "p":  # blocks end a paragraph that was left open
                self._close(len(self.open) - 1)
            elif tag in _CLOSES and tags[-1] in _CLOSES[tag]:
                self._close(len(self.open) - 1)
            self._add(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.unseen:
            if self.inside[tag] > 0:
                self._leave(len(self.unseen) - 1 - self.unseen[::-1].index(tag))
                return
            if tag not in ("html", "body") and self.inline[tag] == 0 and all(self.page.tag[i] != tag for i in self.open[1:]):
                return
            self._leave(0)  # left open in an element that ends here
        self.inline[tag] = max(self.inline[tag] - 1, 0)
        if tag == "a":
            self.links = max(self.links - 1, 0)
        elif tag in _GROUP and tag not in ("html", "body"):
            for depth in range(len(self.open) - 1, 0, -1):
                if self.page.tag[self.open[depth]] == tag:
                    self._close(depth)
                    self.links = 0
                    break

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in _UNSEEN and not (self.unseen and self._start_unseen(tag, True)):
            self.handle_starttag(tag, attrs)
            if tag not in _VOID:
                self.handle_endtag(tag)
        elif self.unseen and tag in _UNSEEN:
            self._start_unseen(tag, True)

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            self.text.append(data)
            if not data.isspace():
                self.breaks = 0
            if self.links:
                self.linked += len(data.split())


def parse(html: str, labelled: bool = True) -> Page:
    """``data-content`` is read on labelled pages only; elsewhere it is an attribute like any other."""
    builder = _Builder(labelled)
    builder.feed(html)
    builder.close()
    builder._flush()
    return builder.page


N_FEATURES = len(_GROUPS) + len(_HINTS) + 14


class Forest:
    """Pages side by side: parents, features, and the elements of each level."""

    def __init__(self, pages: list[Page]):
        self.offset = np.cumsum([0, *(len(page.parent) for page in pages)])
        parents = [np.array(page.parent, np.int64) for page in pages]
        self.parent = np.concatenate([np.zeros(0, np.int64), *(np.where(p < 0, -1, p + at) for p, at in zip(parents, self.offset))])
        self.label = np.array([x for page in pages for x in page.label], float)
        size = len(self.parent)
        depth = np.zeros(size, np.int64)
        for i, above in enumerate(self.parent.tolist()):
            if above >= 0:
                depth[i] = depth[above] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if size else []
        own = np.zeros((size, 4))  # words, words in links, sentence marks, signs of copyright
        for page, at in zip(pages, self.offset):
            for element, text, linked in page.blocks:
                words = len(text.split())
                marks = text.count(".") + text.count(",") + text.count("?") + text.count(";")
                own[at + element] += (words, min(linked, words), marks, "©" in text or "copyright" in text.lower())
        below = own.copy()
        for level in self.levels[:0:-1]:
            np.add.at(below, self.parent[level], below[level])
        total = np.repeat(below[self.offset[:-1], 0], np.diff(self.offset)) if size else np.zeros(0)
        x = np.zeros((size, N_FEATURES))
        for page, at in zip(pages, self.offset):
            for i, (tag, hints) in enumerate(zip(page.tag, page.hints)):
                x[at + i, _GROUP[tag]] = 1
                for hint in hints:
                    x[at + i, len(_GROUPS) + hint] = 1
        rest = len(_GROUPS) + len(_HINTS)
        many = np.maximum(below[:, 0], 1)
        # the state of what stands in the body says nothing about the body's, so its look counts differently
        top = np.where(self.parent >= 0, x[self.parent, _GROUP["body"]], 0) if size else np.zeros(0)
        x[:, rest:] = np.column_stack(
            [
                np.log1p(own[:, 0]), np.log1p(below[:, 0]), own[:, 0] > 12, below[:, 1] / many, below[:, 1] / many > 0.5, np.minimum(below[:, 2] / many, 0.5),
                below[:, 3] > 0, below[:, 0] / np.maximum(total, 1), below[:, 0] == 0, np.minimum(depth, 12) / 4,
                top, top * np.log1p(own[:, 0]), top * x[:, _GROUP["p"]], np.ones(size),
            ]
        )
        self.x = x
        # a page that has elements is not content as a whole: the state of its root and body is given
        whole = np.flatnonzero(x[:, _GROUP["body"]])
        self.given = whole[np.isin(whole, self.parent)]


def _logsum(a: np.ndarray) -> np.ndarray:
    """Over the last axis, of two."""
    return np.logaddexp(a[..., 0], a[..., 1])


def marginals(forest: Forest, weights: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the content state for each element, and of the states of each parent and child, by messages up and down."""
    size, parent = len(forest.parent), forest.parent
    local = np.zeros((size, 2))
    local[:, 1] = forest.x @ weights
    local[forest.given, 1] = -50
    up = np.zeros((size, 2))  # to the parent
    for level in forest.levels[:0:-1]:
        up[level] = _logsum(local[level][:, None, :] + ties[None])
        np.add.at(local, parent[level], up[level])  # local now holds what all children say
    down, pair = np.zeros((size, 2)), np.zeros((size, 2, 2))
    for level in forest.levels[1:]:
        above = local[parent[level]] + down[parent[level]] - up[level]
        down[level] = _logsum(np.swapaxes(above[:, :, None] + ties[None], 1, 2))
        joint = above[:, :, None] + ties[None] + local[level][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pair[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    belief = local + down
    return np.exp(belief[:, 1] - _logsum(belief)), pair


@dataclass
class Model:
    weights: np.ndarray
    ties: np.ndarray  # parent state, child state

    def extract(self, htmls: list[str]) -> list[str]:
        pages = [parse(html, labelled=False) for html in htmls]
        forest = Forest(pages)
        content = marginals(forest, self.weights, self.ties)[0] >= 0.5 if len(forest.parent) else []
        return ["\n\n".join(text for element, text, _ in page.blocks if content[at + element]) for page, at in zip(pages, forest.offset)]


def fit(htmls: list[str], rounds: int = 160, penalty: float = 2e-4) -> Model:
    """Maximum likelihood on labelled pages by Adam on the exact gradient."""
    forest = Forest([parse(html) for html in htmls])
    theta = np.zeros(N_FEATURES + 4)
    m, v = theta.copy(), theta.copy()
    child = np.flatnonzero(forest.parent >= 0)
    real = np.zeros((2, 2))
    np.add.at(real, (forest.label[forest.parent[child]].astype(int), forest.label[child].astype(int)), 1)
    for step in range(1, rounds + 1):
        node, pair = marginals(forest, theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2))
        gradient = np.concatenate([forest.x.T @ (forest.label - node), (real - pair[child].sum(axis=0)).ravel()])
        gradient = gradient / len(node) - penalty * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:N_FEATURES].copy(), theta[N_FEATURES:].reshape(2, 2).copy())


@functools.cache
def default_model() -> Model:
    return fit(labelled_pages() + loose_pages())


SCHEMA = "page_id long, url string, text string"


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text`` of every row: the blocks of the article, white space collapsed, joined by an empty line.

    Null and empty pages, and pages without an element that counts as content, give an empty text. Broken mark-up is read as
    browsers mostly do; repeated rows come out alike; other columns don't matter. Without a model, the one trained on the
    labelled pages of this package is used.
    """
    model = model or default_model()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = model.extract(batch.column("html").to_pylist())
        return pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return map_batches(rows, run, SCHEMA, 64)
