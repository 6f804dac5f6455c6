"""Labelled pages to train the extractor on, composed by a rule: regions of known kind, in the mark-up that sites use for them.

Labels are carried by an attribute ``data-content`` (1 or 0), which a region's elements inherit and the extractor never sees.
Text that stands in ``body`` itself has it on a span.
"""

from __future__ import annotations

import random

_SYLLABLES = "an be co da el fi ga ho in ka le mo ne or pa qui ra se ti un ver wa xi yo zu".split()

#: opening tags around an article's blocks
_ARTICLES = (
    "<article>", "<article class='post'>", "<main>", "<main id='main'>", "<div class='post-content'>", "<div class='entry-content'>",
    "<div id='content'>", "<section class='story'>", "<div class='article-body'>", "<div itemprop='articleBody'>", "<div role='main'>",
    "<div class='text'>", "<table><tr><td class='content'>", "<div>", "<section>",
)
_MENUS = ("<nav>", "<nav class='menu'>", "<div class='navbar'>", "<div id='menu'>", "<ul class='nav'>", "<div class='breadcrumb'>", "<div role='navigation'>", "<div class='pagination'>")
_HEADERS = ("<header>", "<div id='header'>", "<div class='masthead'>", "<div class='site-header'>", "<div class='topbar'>")
_FOOTERS = ("<footer>", "<div id='footer'>", "<div class='footer'>", "<div class='copyright'>", "<div role='contentinfo'>")
_ADS = ("<div class='ad'>", "<div class='ads'>", "<div class='advert'>", "<div id='banner'>", "<div class='sponsored'>", "<div class='promo'>", "<aside class='ad'>", "<ins class='adsbygoogle'>")
_SIDES = ("<aside>", "<div class='sidebar'>", "<div id='side'>", "<div class='widget'>", "<aside class='related'>", "<div class='related-posts'>", "<div class='recommended'>", "<div role='complementary'>")
_NOTICES = ("<div class='cookie-notice'>", "<div id='cookie'>", "<div class='notice'>", "<div class='alert'>", "<div class='popup'>", "<div class='consent'>", "<div class='modal'>", "<div role='alert'>")
_COMMENTS = ("<section class='comments'>", "<div id='comments'>", "<ol class='commentlist'>", "<div class='comment-list'>", "<div id='disqus_thread'>", "<section id='responses'>", "<div class='replies'>", "<ul class='reader-comments'>")
_FORMS = ("<form>", "<form class='newsletter'>", "<div class='subscribe'>", "<form id='search'>", "<div class='login'>", "<form class='comment-form'>")
_SHARES = ("<div class='share'>", "<ul class='social'>", "<div class='tags'>", "<div class='meta'>", "<div class='byline'>")


def _close(opening: str) -> str:
    return "".join(f"</{tag.split()[0].strip('<>')}>" for tag in reversed(opening.split("><")))


class _Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        draw = self.random
        made = ["".join(draw.choice(_SYLLABLES) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(low, high))]
        for i in range(7, len(made) - 1, draw.randint(7, 13)):
            made[i] += draw.choice([".", ".", ",", ";"])
        return " ".join(made).capitalize() + draw.choice([".", ".", ".", "?", ""])

    def links(self, low: int, high: int) -> str:
        return "".join(f"<li><a href='/x'>{self.words(1, 3)}</a></li>" for _ in range(self.random.randint(low, high)))

    def region(self, opening: str, label: int, inside: str) -> str:
        first, _, rest = opening.partition(">")
        return f"{first} data-content={label}>{rest}{inside}{_close(opening)}"

    def pick(self, kinds: tuple[str, ...], label: int, inside: str, chance: float = 1.0) -> str:
        return self.region(self.random.choice(kinds), label, inside) if self.random.random() < chance else ""

    def article(self) -> str:
        draw, parts = self.random, [f"<h1>{self.words(2, 10)}</h1>"] if self.random.random() < 0.8 else []
        if draw.random() < 0.12:  # hardly any text, and mark-up left open
            return parts[0] * draw.randint(0, len(parts)) + f"<p><b>{self.words(1, 5)}<br>" if parts else f"<p>{self.words(1, 5)}</p>"
        parts.append(self.pick(_SHARES, 0, self.links(1, 4), 0.3))
        for _ in range(draw.randint(1, 12)):
            kind = draw.random()
            if kind < 0.7:
                parts.append(f"<p>{self.words(1, 70)}" + draw.choice(["</p>", "</p>", ""]))
            elif kind < 0.78:
                parts.append(f"<h2>{self.words(2, 6)}</h2>")
            elif kind < 0.84:
                parts.append("<ul>" + "".join(f"<li>{self.words(3, 15)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>")
            elif kind < 0.88:
                parts.append(f"<blockquote><p>{self.words(8, 30)}</p></blockquote>")
            elif kind < 0.92:
                parts.append(f"<figure><img><figcaption>{self.words(3, 9)}</figcaption></figure>")
            elif kind < 0.95:
                parts.append(f"<p><a href='/y'>{self.words(2, 4)}</a> {self.words(10, 40)}</p>")
            else:
                parts.append(self.pick(_ADS + _SIDES, 0, self.words(3, 12)))
        parts.append(self.pick(_SHARES, 0, self.links(2, 4), 0.2))
        return "".join(parts)

    def page(self) -> str:
        draw = self.random
        before = [
            self.pick(_NOTICES, 0, f"<p>{self.words(6, 25)}</p><button>{self.words(1, 2)}</button>", 0.4),
            self.pick(_HEADERS, 0, f"<p>{self.words(1, 5)}</p>", 0.5),
            self.pick(_MENUS, 0, f"<ul>{self.links(2, 9)}</ul>", 0.9),
            self.pick(_ADS, 0, self.words(3, 25), 0.5),
        ]
        draw.shuffle(before)
        said = "".join(f"<li><div><p>{self.words(3, 40)}</p></div></li>" for _ in range(draw.randint(1, 5)))
        after = [
            self.pick(_COMMENTS, 0, f"<h3>{self.words(1, 3)}</h3>{said}", 0.45),
            self.pick(_SIDES, 0, f"<h3>{self.words(1, 3)}</h3><ul>{self.links(2, 6)}</ul><p>{self.words(3, 20)}</p>", 0.5),
            self.pick(_FORMS, 0, f"<label>{self.words(1, 4)}</label><input><p>{self.words(3, 12)}</p>", 0.4),
            self.pick(_ADS, 0, f"<p>{self.words(3, 25)}</p>", 0.3),
        ]
        draw.shuffle(after)
        foot = self.pick(_FOOTERS, 0, f"&copy; {self.words(1, 4)} &middot; " + draw.choice([self.words(2, 15), f"<ul>{self.links(1, 5)}</ul>"]), 0.9)
        article = self.pick(_ARTICLES, 1, self.article())
        side = self.pick(_SIDES, 0, f"<p>{self.words(3, 25)}</p>{self.links(0, 3)}", 0.3)
        middle = draw.choice([article + side, f"<div class='wrapper'>{article}{side}</div>", f"<div id='page'><div>{article}</div>{side}</div>"])
        return f"<html><head><title>x</title></head><body data-content=0>{''.join(before)}{middle}{''.join(after)}{foot}</body></html>"

    def run(self, label: int, text: str) -> str:
        return f"<span data-content={label}>{text}</span>"

    def anchors(self) -> str:
        return " | ".join(f"<a href='/x'>{self.words(1, 3)}</a>" for _ in range(self.random.randint(2, 7)))

    def loose_article(self) -> str:
        """Paragraphs that stand in the body, parted by breaks, rules or paragraph tags left open."""
        draw = self.random
        title = draw.choice(["", f"<h1 data-content=1>{self.words(2, 8)}</h1>", self.run(1, f"<b>{self.words(2, 8)}</b>") + "<br><br>"])
        parts = [self.run(1, self.words(8, 90) + draw.choice(["", "", f"<br>{self.words(3, 20)}"]))]
        for _ in range(draw.randint(0, 8)):
            if draw.random() < 0.3:
                parts.append(f"<p data-content=1>{self.words(5, 90)}" + draw.choice(["</p>", "<hr>"]))
            else:
                link = f"<a href='/y'>{self.words(1, 3)}</a> " if draw.random() < 0.15 else ""
                parts.append(draw.choice(["<br><br>", "<br><br>", "<hr>"]) + self.run(1, link + self.words(3, 90)))
        return title + "".join(parts)

    def loose_page(self) -> str:
        draw, rule = self.random, "<hr>"
        if draw.random() < 0.4:  # an article in mark-up, and stray text beside it
            stray = self.run(0, draw.choice([self.words(1, 6), self.anchors(), f"&copy; {self.words(1, 5)}"]))
            whole, place = self.page(), draw.choice(["<body data-content=0>", "</body>"])
            return whole.replace(place, place + stray if place.startswith("<body") else stray + place)
        before = draw.choice(["", self.run(0, self.anchors()) + rule, self.pick(_MENUS, 0, f"<ul>{self.links(2, 9)}</ul>"), self.pick(_HEADERS, 0, f"<p>{self.words(1, 5)}</p>")])
        last = draw.choice([f"&copy; {self.words(1, 6)}", f"Copyright {self.words(1, 6)}", self.anchors()])
        after = draw.choice(["", rule + self.run(0, last), rule + self.run(0, last), self.pick(_FOOTERS, 0, f"&copy; {self.words(1, 4)}")])
        inside = f"{before}{self.loose_article()}{after}"
        return inside if draw.random() < 0.25 else f"<html><head><title>x</title></head><body data-content=0>{inside}</body></html>"


def loose_pages(count: int = 120, seed: int = 12) -> list[str]:
    """Pages with text that stands in ``body`` itself."""
    return [_Writer(seed * 100_000 + i).loose_page() for i in range(count)]


def labelled_pages(count: int = 300, seed: int = 11) -> list[str]:
    return [_Writer(seed * 100_000 + i).page() for i in range(count)]
