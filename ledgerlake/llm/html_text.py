"""Main text of HTML pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags.  A block's features are its
word count and link density, those of its two neighbours, whether it is a
copyright line, and what encloses it: an element that by tag, class, id or role is
boilerplate (menu, header, footer, sidebar, notice, advert, form, comments), one
whose names speak for both, or an article.  A CART tree, trained on the small
labelled table of ``labelled_pages``, says which blocks are main text.  Pages whose
markup names nothing are judged by words, links and neighbours alone.

A page is read once from left to right, in time linear in its length, whatever its
markup.  A quote opens a value only after ``=``.  Where a tag or quote never ends,
tags from there on end at their first ``>``, and a ``<`` without one is text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import check_columns
from .labelled_pages import PAGES

# fixed values: HTML element classes
DROPPED = ("script", "style", "template", "noscript", "title", "textarea", "select", "svg", "math", "iframe",
           "object", "canvas", "audio", "video")
#: Dropped elements that may close themselves, and those that stand in a line of text.
FOREIGN = frozenset(("svg", "math"))
FIELDS = frozenset(("textarea", "select"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose end tag may be left out, with those that a new one closes.
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
BOILERPLATE_TAGS = frozenset("nav footer aside form button fieldset dialog menu".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments commentlist "
    "complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus feedback footer "
    "form gdpr legal login masthead menu modal nav navbar navigation newsletter notice notification pager pagination "
    "popup promo promoted promotion recommended related replies reply respond responses search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription tagcloud tags toolbar widget widgets".split())
HEADER_WORDS = frozenset("header topbar".split())
ARTICLE_TAGS = frozenset("article main".split())

CONTENT_WORDS = frozenset("article body content entry main post story text".split())

_OPEN = re.compile(r"<(?=[a-zA-Z!?/])")
_TAG = re.compile(r"""<(/)?([a-zA-Z][^\s/>]*+)((?:[\s/]++|=++|[^\s/>=]++"""
                  r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+)*+)>""")
_LOOSE_TAG = re.compile(r"<(/)?([a-zA-Z][^\s/>]*+)([^>]*+)>")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in DROPPED}
_LEGAL = re.compile(r"(?:©|\(c\)|\bcopyright)\s*(?:©|\(c\))?\s*\d{4}|\ball rights reserved\b", re.I)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[a-z]+")
N_FEATURES = 13
#: The last feature: pages that name their parts and pages that do not have a branch each.
MARKED = N_FEATURES - 1


class Block:
    __slots__ = ("text", "words", "linked", "heading", "item", "bad", "article", "at")

    def __init__(self, text, linked, heading, item, bad, article, at):
        self.text, self.words, self.linked = text, text.count(" ") + 1, linked
        self.heading, self.item, self.bad, self.article, self.at = heading, item, bad, article, at

    @property
    def legal(self) -> bool:
        return _LEGAL.search(self.text) is not None


def _cues(tag: str, attrs: str, in_article: bool) -> tuple[float, bool]:
    """Does the element say that it is boilerplate (1; 0.5 where its names speak for
    content too), and does it say that it is content?"""
    if tag in BOILERPLATE_TAGS or (tag == "header" and not in_article):
        return 1.0, False
    content = tag in ARTICLE_TAGS
    if not attrs or tag in ("html", "body"):
        return 0.0, content
    named = mixed = False
    for name, value in _ATTR.findall(attrs):
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and "true" in value.lower()):
            return 1.0, False
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return 1.0, False
        if name in ("class", "id", "role"):
            for one in value.split():
                words = set(_WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", one).lower()))
                if words & BOILERPLATE_WORDS or (words & HEADER_WORDS and not in_article):
                    named = True
                    mixed |= bool(words & CONTENT_WORDS) or (tag in ARTICLE_TAGS and not words <= BOILERPLATE_WORDS)
                else:
                    content |= bool(words & CONTENT_WORDS)
    if named:
        return (0.5 if mixed or (content and tag not in ARTICLE_TAGS) else 1.0), False
    return 0.0, content


def _pieces(source: str):
    """(text, its place, tag, whether an end tag, attributes) from left to right; the tag is None
    after the last text and for comments, declarations and elements without text."""
    at, tags = 0, _TAG
    last_close = source.rfind(">")
    begin = _OPEN.search(source)
    while begin:
        start = begin.start()
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            yield source[at:start], at, None, False, ""
            at = len(source) if end < 0 else end + 3
        elif start > last_close:
            break
        else:
            m = tags.match(source, start)
            if m is None and tags is _TAG and source[start + 1:start + 2] not in "!?" and _LOOSE_TAG.match(source, start):
                tags = _LOOSE_TAG
                m = tags.match(source, start)
            if m is None:
                yield source[at:start], at, None, False, ""
                at = source.find(">", start) + 1
            else:
                tag, attrs = m[2].lower(), m[3]
                raw = _RAW_END.get(tag) if not m[1] and not (tag in FOREIGN and attrs.endswith("/")) else None
                yield source[at:start], at, tag if raw is None or tag in FIELDS else None, bool(m[1]), attrs
                at = m.end()
                if raw:
                    closed = raw.search(source, at)
                    at = closed.end() if closed else len(source)
        begin = _OPEN.search(source, at)
    yield source[at:], at, None, False, ""


def blocks(page: str | None) -> list[Block]:
    """Text blocks of a page in page order, white space normalised, references decoded."""
    out: list[Block] = []
    stack: list[tuple[str, float, bool, bool]] = []  # tag, boilerplate, article, list item or cell
    opened: Counter = Counter()  # tags in the stack
    text: list[str] = []
    linked: list[str] = []
    heading = False
    link_depth = 0
    first = 0

    def flush():
        nonlocal text, linked
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                _, bad, article, item = stack[-1] if stack else ("", 0.0, False, False)
                n = len(html.unescape("".join(linked)).split()) if linked else 0
                out.append(Block(" ".join(words), min(n, len(words)), heading, item, bad, article, first))
            text, linked = [], []

    def keep(piece: str, at: int):
        nonlocal first
        if not text:
            first = at
        text.append(piece)
        if link_depth:
            linked.append(piece)

    def close_last():
        opened[stack.pop()[0]] -= 1

    for piece, at, tag, is_end, attrs in _pieces(page or ""):
        if piece:
            keep(piece, at)
        if tag is None:
            continue
        if tag == "br" or tag in FIELDS:
            keep(" ", at)
            continue
        if tag in INLINE and not (attrs and tag == "span" and _cues(tag, attrs, True)[0]):
            if tag == "a":
                link_depth = 0 if is_end else 1
                if link_depth == 0:
                    linked.append(" ")
            if not (tag == "span" and is_end and opened["span"]):
                continue
        flush()
        link_depth = 0 if tag != "a" else link_depth
        if tag in HEADINGS:
            heading = not is_end
        elif tag == "p":
            heading = False
        if tag in VOID or tag == "p" or tag in HEADINGS:
            continue
        if is_end:
            if opened[tag]:
                while stack[-1][0] != tag:
                    close_last()
                close_last()
            continue
        if tag in IMPLIED:
            while stack and stack[-1][0] in IMPLIED[tag]:
                close_last()
        _, bad, article, item = stack[-1] if stack else ("", 0.0, False, False)
        cue, content = _cues(tag, attrs, article)
        bad = max(bad, cue)
        stack.append((tag, bad, article or (content and bad < 1), item or tag in IMPLIED))
        opened[tag] += 1
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """Per block: words and link density of it, the last and the next; the last two of
    the page's edges are 0.  Then: long neighbours, heading, list item, boilerplate, article,
    copyright line, and whether any block of the page has a cue."""
    n = len(found)
    own = np.zeros((n + 2, 2))
    own[1:-1, 0] = [b.words for b in found]
    own[1:-1, 1] = [b.linked / b.words for b in found]
    x = np.empty((n, N_FEATURES))
    x[:, 0:2], x[:, 2:4], x[:, 4:6] = own[1:-1], own[:-2], own[2:]
    x[:, 6] = np.maximum(own[:-2, 0] * (1 - own[:-2, 1]), own[2:, 0] * (1 - own[2:, 1]))
    x[:, 7:12] = np.array([(b.heading, b.item, b.bad, b.article, b.legal) for b in found]).reshape(n, 5)
    x[:, MARKED] = x[:, 9:11].any()
    return x


class Tree:
    """Binary classification tree (CART, Gini impurity) as flat arrays.  ``first``: a
    0/1 feature that the root splits by, whatever its impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, leaf: int = 2, first: int | None = None):
        self.axis, self.value, self.left, self.label = [], [], [], []
        todo = [(np.arange(len(y)), 0)]
        self._node(y)
        at = 0
        while at < len(self.axis):
            rows, level = todo[at]
            if level == 0 and first is not None and 0 < x[:, first].sum() < len(y):
                split = first, 0.5
            else:
                split = self._best(x[rows], y[rows], leaf) if level < depth else None
            if split:
                self.axis[at], self.value[at] = split
                self.left[at] = len(self.axis)
                right = x[rows, split[0]] > split[1]
                for part in (rows[~right], rows[right]):
                    self._node(y[part])
                    todo.append((part, level + 1))
            at += 1
        self.axis, self.value = np.array(self.axis), np.array(self.value)
        self.left, self.label = np.array(self.left), np.array(self.label)

    def _node(self, y):
        self.axis.append(0)
        self.value.append(0.0)
        self.left.append(-1)
        self.label.append(int(2 * y.sum() >= len(y)))

    @staticmethod
    def _best(x, y, leaf):
        n, total = len(y), y.sum()
        if total in (0, n):
            return None
        best, split = 2 * total * (n - total) / n - 1e-9, None
        for axis in range(x.shape[1]):
            order = np.argsort(x[:, axis], kind="stable")
            v, c = x[order, axis], np.cumsum(y[order])
            k = np.arange(1, n)
            ok = (v[1:] > v[:-1]) & (k >= leaf) & (n - k >= leaf)
            if not ok.any():
                continue
            k, c = k[ok], c[:-1][ok]
            impurity = 2 * c * (k - c) / k + 2 * (total - c) * (n - k - total + c) / (n - k)
            i = int(np.argmin(impurity))
            if impurity[i] < best:
                best, split = impurity[i], (axis, float((v[1:][ok][i] + v[:-1][ok][i]) / 2))
        return split

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.left[node] >= 0)
            if not len(inner):
                return self.label[node]
            at = node[inner]
            node[inner] = self.left[at] + (x[inner, self.axis[at]] > self.value[at])


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """The labelled table as features and labels."""
    xs, ys = [], []
    for page in PAGES:
        found = blocks("".join(part for part, _ in page))
        ends = np.cumsum([len(part) for part, _ in page])
        xs.append(features(found))
        ys += [page[int(np.searchsorted(ends, b.at, side="right"))][1] for b in found]
    return np.concatenate(xs), np.array(ys, float)


@lru_cache(1)
def block_tree() -> Tree:
    return Tree(*labelled_blocks(), first=MARKED)


def main_text(page: str | None, tree: Tree | None = None) -> str:
    found = blocks(page)
    if not found:
        return ""
    keep = (tree or block_tree()).predict(features(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page: its main text, blocks joined by one
    newline, and its length in code points.  A null or empty page, or one without
    main text, gives the empty text.  Pages without markup are one block.
    Repeated rows are extracted alike; other columns are ignored."""
    check_columns(pages, page_id="any", url="any", html="string")
    tree = block_tree()

    @F.pandas_udf("string")
    def extract(texts: pd.Series) -> pd.Series:
        return pd.Series([main_text(t, tree) for t in texts], dtype=object)

    out = pages.select("page_id", "url", extract("html").alias("text"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
