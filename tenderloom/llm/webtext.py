"""Main text of web pages from flat text blocks.

A page is read once into text blocks: runs of text between block-level tags, with their number of words and the
share of words inside links. A decision tree over these numbers of a block and its neighbours, trained on the small
labelled table below, keeps or drops each block. Where words and links leave labelled blocks of both classes
together, the tree may also ask for the zone of the enclosing elements: content, loosely named furniture, furniture
or neither, by element names, roles and the words of class and id.

Only names made of furniture words alone, with words of place or form, are furniture ("ad-slot", "site-header"); one with other words
("related-work") is a loose hint that words and links overrule, and "has-sidebar" names the page around one. Article
and main elements reopen content in loosely named boxes; names of comments and adverts close it even on them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------------------------------
SKIPPED = {"script", "style", "title", "template", "svg", "iframe", "object", "annotation", "annotation-xml"}
FURNITURE = {"nav", "aside", "footer", "header", "form", "button", "select", "textarea", "noscript", "dialog", "menu"}
CONTENT = {"article", "main"}
CONTAINERS = FURNITURE | CONTENT | {"div", "section", "ul", "ol", "dl", "table", "body", "figure", "details", "center", "blockquote", "tr", "td", "th", "li"}
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "dt", "dd", "tr", "caption", "figcaption", "address", "hr", "thead",
                       "tbody", "tfoot", "fieldset", "legend", "option", "summary", "html", "head", "label"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "param", "track"}
FURNITURE_ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
FURNITURE_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "banners", "promo", "promotion", "sponsor",
                   "sponsored", "sidebar", "aside", "menu", "menus", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "foot", "header",
                   "masthead", "topbar", "comment", "comments", "disqus", "reply", "replies", "respond", "cookie", "cookies", "consent", "gdpr", "notice",
                   "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search", "share",
                   "sharing", "social", "related", "recommended", "recommendations", "widget", "widgets", "tags", "pagination", "pager", "copyright",
                   "legal", "toolbar", "disclaimer", "form"}
CONTENT_WORDS = {"content", "article", "post", "entry", "story", "main", "maintext", "body", "text", "prose"}
#: Names that close even an article, words that say what a page has rather than what a box is, and words of place or form.
CLOSING_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsored", "comment", "comments", "reply", "replies"}
STATE_WORDS = {"has", "no", "not", "with", "without", "open", "closed", "enabled", "disabled", "count", "hide", "show"}
FORM_WORDS = {"left", "right", "top", "bottom", "primary", "secondary", "site", "page", "global", "box", "block", "area", "container", "wrapper", "wrap", "section",
              "inner", "outer", "item", "items", "list", "li", "div", "bar", "button", "buttons", "icon", "icons", "link", "links", "slot", "unit", "google",
              "label", "title", "meta", "group", "row", "col", "column", "panel", "user", "reader", "thread", "node", "field", "input", "js", "block", "the"}
#: Labelled blocks: zone (1 content, -1 loosely named furniture, -2 furniture, 0 neither), words and link share of the block, of the one before
#: and of the one after; 1 if it belongs to the main text.
LABELLED = (
    (1, 8, 0.0, 0, 0.0, 60, 0.0, 1), (1, 60, 0.0, 8, 0.0, 45, 0.0, 1), (1, 45, 0.0, 60, 0.0, 3, 0.0, 1), (1, 3, 0.0, 45, 0.0, 80, 0.0, 1),
    (1, 1, 0.0, 3, 0.0, 2, 0.0, 1), (1, 2, 0.0, 120, 0.02, 12, 1.0, 1), (1, 120, 0.05, 1, 0.0, 0, 0.0, 1), (1, 5, 1.0, 90, 0.0, 70, 0.0, 1),
    (1, 25, 0.4, 30, 0.1, 35, 0.0, 1), (1, 15, 0.8, 60, 0.0, 40, 0.1, 1), (1, 300, 0.0, 12, 0.0, 6, 0.3, 1), (1, 10, 0.0, 6, 1.0, 6, 1.0, 1),
    (1, 4, 0.0, 0, 0.0, 0, 0.0, 1), (1, 30, 0.0, 2, 1.0, 9, 0.2, 1), (1, 1, 1.0, 14, 0.0, 50, 0.0, 1), (1, 70, 0.3, 5, 0.0, 22, 0.0, 1),
    (1, 40, 0.7, 30, 0.1, 5, 0.0, 1), (1, 60, 1.0, 20, 0.0, 0, 0.0, 1), (1, 90, 0.6, 4, 0.0, 3, 1.0, 1), (1, 20, 0.5, 0, 0.0, 8, 0.0, 1),
    (-2, 1, 1.0, 0, 0.0, 1, 1.0, 0), (-2, 2, 1.0, 1, 1.0, 1, 1.0, 0), (-2, 12, 0.0, 2, 1.0, 8, 0.0, 0), (-2, 45, 0.0, 12, 0.0, 50, 0.0, 0),
    (-2, 90, 0.0, 70, 0.0, 60, 0.0, 0), (-2, 9, 0.1, 60, 0.0, 0, 0.0, 0), (-2, 25, 0.2, 110, 0.0, 4, 1.0, 0), (-2, 3, 0.0, 1, 1.0, 1, 1.0, 0),
    (-2, 150, 0.02, 90, 0.0, 8, 0.0, 0), (-2, 6, 0.5, 6, 0.5, 6, 0.5, 0), (-2, 18, 0.0, 0, 0.0, 10, 0.0, 0), (-2, 60, 0.1, 55, 0.0, 20, 0.0, 0),
    (-2, 30, 0.0, 30, 0.0, 30, 0.0, 0), (-2, 2, 0.0, 200, 0.0, 0, 0.0, 0), (-2, 5, 0.0, 0, 0.0, 75, 0.0, 0), (-2, 22, 1.0, 40, 0.0, 40, 0.0, 0),
    (0, 70, 0.0, 60, 0.0, 55, 0.0, 1), (0, 40, 0.05, 8, 0.0, 60, 0.0, 1), (0, 25, 0.0, 40, 0.0, 30, 0.0, 1), (0, 18, 0.1, 50, 0.0, 45, 0.1, 1),
    (0, 7, 0.0, 3, 1.0, 80, 0.0, 1), (0, 9, 0.0, 1, 1.0, 55, 0.0, 1), (0, 4, 0.0, 60, 0.0, 70, 0.0, 1), (0, 6, 0.0, 45, 0.0, 38, 0.0, 1),
    (0, 3, 0.0, 90, 0.0, 40, 0.0, 1), (0, 110, 0.2, 2, 1.0, 3, 1.0, 1), (0, 35, 0.0, 60, 0.1, 2, 1.0, 1), (0, 55, 0.0, 1, 1.0, 4, 0.0, 1),
    (0, 20, 0.0, 0, 0.0, 0, 0.0, 1), (0, 16, 0.0, 30, 0.0, 5, 0.0, 1), (0, 12, 0.0, 80, 0.0, 25, 0.0, 1), (0, 5, 0.0, 30, 0.0, 28, 0.0, 1),
    (0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (0, 2, 1.0, 0, 0.0, 2, 1.0, 0), (0, 3, 1.0, 3, 1.0, 9, 0.0, 0), (0, 4, 0.7, 60, 0.0, 3, 0.9, 0),
    (0, 20, 0.9, 50, 0.0, 40, 0.0, 0), (0, 12, 0.8, 8, 0.9, 10, 0.7, 0), (0, 35, 0.6, 4, 1.0, 5, 1.0, 0), (0, 3, 0.0, 1, 1.0, 1, 1.0, 0),
    (0, 2, 0.0, 2, 1.0, 0, 0.0, 0), (0, 6, 0.0, 2, 1.0, 3, 0.0, 0), (0, 4, 0.0, 5, 0.0, 4, 0.0, 0), (0, 8, 0.2, 5, 0.5, 0, 0.0, 0),
    (0, 5, 0.0, 60, 0.0, 0, 0.0, 0), (0, 7, 0.1, 40, 0.0, 3, 1.0, 0), (0, 3, 0.0, 0, 0.0, 2, 1.0, 0), (0, 9, 0.5, 70, 0.0, 6, 0.6, 0),
    (1, 2, 1.0, 3, 1.0, 2, 1.0, 0), (1, 4, 1.0, 4, 1.0, 5, 1.0, 0), (1, 1, 1.0, 2, 1.0, 1, 1.0, 0), (1, 6, 1.0, 5, 0.9, 4, 1.0, 0),
    (1, 3, 0.9, 2, 1.0, 6, 1.0, 0), (1, 5, 1.0, 1, 1.0, 1, 1.0, 0), (1, 7, 1.0, 6, 1.0, 8, 1.0, 0), (1, 9, 1.0, 8, 1.0, 9, 0.9, 0),
    (-1, 80, 0.0, 0, 0.0, 0, 0.0, 1), (-1, 80, 0.0, 7, 0.0, 60, 0.0, 1), (-1, 60, 0.02, 80, 0.0, 45, 0.0, 1), (-1, 45, 0.0, 60, 0.0, 90, 0.0, 1),
    (-1, 120, 0.05, 3, 1.0, 2, 1.0, 1), (-1, 90, 0.1, 50, 0.0, 4, 0.0, 1), (-1, 8, 0.0, 2, 1.0, 80, 0.0, 1), (-1, 5, 0.0, 60, 0.0, 75, 0.0, 1),
    (-1, 50, 0.0, 45, 0.0, 2, 1.0, 1), (-1, 200, 0.0, 0, 0.0, 3, 1.0, 1), (-1, 4, 0.0, 0, 0.0, 80, 0.0, 1), (-1, 70, 0.0, 8, 0.0, 0, 0.0, 1),
    (-1, 1, 1.0, 0, 0.0, 1, 1.0, 0), (-1, 2, 1.0, 2, 1.0, 3, 1.0, 0), (-1, 12, 0.0, 2, 1.0, 8, 0.0, 0), (-1, 9, 0.1, 60, 0.0, 0, 0.0, 0),
    (-1, 25, 0.2, 60, 0.0, 4, 1.0, 0), (-1, 18, 0.0, 0, 0.0, 10, 0.0, 0), (-1, 22, 1.0, 40, 0.0, 40, 0.0, 0), (-1, 40, 0.8, 30, 0.5, 20, 0.6, 0),
    (-1, 3, 0.0, 0, 0.0, 2, 1.0, 0), (-1, 15, 0.0, 12, 0.0, 14, 0.0, 0), (-1, 6, 0.5, 6, 0.5, 6, 0.5, 0), (-1, 4, 0.0, 60, 0.0, 0, 0.0, 0),
    (-2, 25, 0.0, 1, 1.0, 60, 0.0, 0), (-2, 30, 0.0, 70, 0.0, 0, 0.0, 0), (-2, 45, 0.0, 20, 0.0, 0, 0.0, 0), (-2, 8, 0.0, 1, 1.0, 6, 0.0, 0),
    (-2, 8, 0.0, 1, 1.0, 40, 0.0, 0), (-2, 12, 0.0, 1, 1.0, 12, 0.0, 0), (-2, 22, 0.0, 10, 0.0, 2, 1.0, 0), (-2, 60, 0.0, 0, 0.0, 0, 0.0, 0),
    (-2, 70, 0.0, 3, 1.0, 3, 1.0, 0), (-2, 35, 0.0, 2, 1.0, 15, 0.0, 0), (-2, 28, 0.1, 90, 0.0, 3, 0.0, 0), (-2, 90, 0.0, 40, 0.0, 0, 0.0, 0),
    (-2, 120, 0.0, 8, 0.0, 2, 1.0, 0), (-2, 14, 0.0, 25, 0.0, 25, 0.0, 0), (-2, 6, 0.0, 70, 0.0, 70, 0.0, 0), (-2, 40, 0.6, 10, 0.0, 12, 0.0, 0),
    (-2, 24, 0.3, 0, 0.0, 3, 0.0, 0), (-2, 100, 0.3, 30, 0.1, 1, 1.0, 0), (-2, 10, 0.02, 100, 0.0, 100, 0.0, 0), (-2, 3, 0.0, 25, 0.0, 25, 0.0, 0),
    (1, 8, 0.0, 6, 0.0, 12, 0.0, 1), (1, 12, 0.0, 1, 1.0, 20, 0.0, 1), (1, 6, 0.0, 6, 0.0, 90, 0.0, 1), (1, 17, 0.0, 40, 0.0, 0, 0.0, 1),
    (1, 6, 0.0, 90, 0.0, 0, 0.0, 1), (1, 30, 0.0, 5, 0.0, 18, 0.0, 1), (1, 15, 0.1, 15, 0.0, 15, 0.0, 1), (1, 2, 0.0, 2, 0.0, 2, 0.0, 1),
    (1, 21, 0.0, 9, 0.0, 0, 0.0, 1), (1, 19, 0.2, 3, 0.0, 1, 0.0, 1), (1, 90, 0.0, 2, 1.0, 1, 1.0, 1), (1, 45, 0.1, 0, 0.0, 0, 0.0, 1),
    (1, 30, 0.1, 40, 0.0, 5, 1.0, 1), (1, 12, 0.0, 0, 0.0, 3, 1.0, 1), (1, 6, 0.0, 2, 0.0, 1, 1.0, 1), (1, 20, 0.08, 3, 0.0, 8, 1.0, 1),
    (1, 44, 0.3, 50, 0.1, 4, 0.9, 1), (1, 9, 0.2, 70, 0.0, 6, 1.0, 1),
)


def grow(rows: list[tuple], depth: int = 9, text_depth: int = 3, smallest: int = 6):
    """A classification tree by Gini impurity: (feature, threshold, left, right) or a class.

    The upper ``text_depth`` levels ask for words and links only, in parts of at least ``smallest`` rows; below, every
    feature may be asked, the zone (the first one) included.
    """
    classes = [r[-1] for r in rows]
    ones = sum(classes)
    if not depth or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))

    def impurity(part: list[tuple]) -> float:
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    best, least = None, smallest if text_depth else 1
    for f in range(1 if text_depth else 0, len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:]):
            at = (low + high) / 2
            left, right = [r for r in rows if r[f] <= at], [r for r in rows if r[f] > at]
            cost = impurity(left) + impurity(right)
            if min(len(left), len(right)) >= least and (best is None or cost < best[0] - 1e-12):
                best = (cost, f, at, left, right)
    if best is None:
        return grow(rows, depth, 0) if text_depth else int(2 * ones >= len(rows))
    below = max(0, text_depth - 1)
    return best[1], best[2], grow(best[3], depth - 1, below), grow(best[4], depth - 1, below)


def decide(tree, row: tuple) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _named(value: str) -> tuple[bool, bool, bool, bool]:
    """Whether names of a class or id say furniture, closing furniture, loose furniture and content."""
    furniture = closing = loose = content = False
    for name in value.split():
        words = {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name)}
        if words & STATE_WORDS:
            continue
        if words & FURNITURE_WORDS:
            strict = words <= FURNITURE_WORDS | FORM_WORDS | CONTENT_WORDS
            furniture, loose = furniture or strict, loose or not strict
            closing = closing or strict and bool(words & CLOSING_WORDS)
        elif words & CONTENT_WORDS:
            content = True
    return furniture, closing, loose, content


def _hint(tag: str, attrs: list, zone: int) -> int:
    """Zone inside an element, from its own names and the zone around it. Furniture (-2) stays furniture."""
    if zone == -2 or tag in FURNITURE and not (tag == "header" and zone > 0):
        return -2
    if tag in ("html", "body"):
        return zone
    values = {name: value or "" for name, value in attrs}
    role = values.get("role", "").lower()
    if "hidden" in values or values.get("aria-hidden") == "true" or role in FURNITURE_ROLES or re.search(r"display\s*:\s*none", values.get("style", "")):
        return -2
    furniture, closing, loose, content = _named(values.get("class", "") + " " + values.get("id", ""))
    if tag in CONTENT or role in ("main", "article"):
        return -2 if closing else 1
    header = zone > 0 and re.search("header", values.get("class", "") + values.get("id", ""), re.I)
    if furniture and tag != "header" and not header:
        return -2
    if loose and tag != "header" and not header:
        return 0 if zone > 0 else -1
    return 1 if content and zone >= 0 else zone


class _Blocks(HTMLParser):
    """Collects (text, words, linked words, zone) of the blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = []
        self.zone = 0
        self.skipping = ""
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, int, int, int]] = []

    def end_block(self) -> None:
        words = "".join(self.parts).split()
        if words:
            self.blocks.append((" ".join(words), len(words), min(self.linked, len(words)), self.zone))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if self.skipping:
            return
        if tag in SKIPPED:
            self.skipping = tag
            return
        if tag in BLOCKS:
            self.end_block()
            if tag == "body":
                self.links = 0
        elif tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.links = 1
        if tag in CONTAINERS:
            self.stack.append((tag, self.zone))
            self.zone = _hint(tag, attrs, self.zone)
            self.links = 0

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag in SKIPPED:
            if tag in ("br", "hr") and not self.skipping:
                self.parts.append(" ")
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.skipping:
            if tag == self.skipping:
                self.skipping = ""
            return
        if tag == "a":
            self.links = 0
        if tag in BLOCKS:
            self.end_block()
        if tag in CONTAINERS:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    self.zone = self.stack[i][1]
                    del self.stack[i:]
                    break
                if self.stack[i][0] in CONTENT and tag not in ("body", "main", "article"):
                    break  # a stray end tag does not close the article around it

    def handle_data(self, data):
        if not self.skipping:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.split())


def blocks(html: str | None) -> list[tuple[str, int, int, int]]:
    """(text, words, linked words, zone) of a page's text blocks in order."""
    reader = _Blocks()
    reader.feed(html or "")
    reader.close()
    reader.end_block()
    return reader.blocks


def main_text(html: str | None, tree) -> str:
    """The blocks that the tree keeps, joined by one space."""
    found = blocks(html)
    numbers = [(b[1], b[2] / b[1]) for b in found]
    around = [(0, 0.0), *numbers, (0, 0.0)]
    return " ".join(b[0] for i, b in enumerate(found) if decide(tree, (b[3], *around[i + 1], *around[i], *around[i + 2])))


def text_column(html: Column, labelled: tuple = LABELLED) -> Column:
    tree = grow(list(labelled))

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p, tree) for p in pages], dtype=object)

    return text(html)


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row; null or empty html, or a page without main text, gives ''.

    Rows are treated one by one, so repeated ids stay; other columns are ignored.
    """
    return pages.select("page_id", "url", text_column(F.col("html")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
