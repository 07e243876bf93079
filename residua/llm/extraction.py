"""Main text of web pages by text-to-tag ratios.

The events of the standard library's parser are cut into lines, one per block element. A
line's ratio is its characters per tag; lines of menus, forms, adverts and the like, known by
their element or role or the words of its class and id, have ratio 0. The words do not count
on headings, on elements round most of the page, and above its only article or main element; words
that also name parts of an article count only where most of the element's text is of low ratio.
Ratios are smoothed with a
Gaussian kernel and split into two clusters by the threshold half-way between the clusters'
means. The smallest element that holds nearly all text of the upper cluster is the content
region, and its lines, but for the kinds named above, are the main text: short paragraphs of an
article are in it though their own ratio is low.

Defined results: null or empty html, and pages without text, give an empty text. Elements that
are never closed end with their parent. Repeated rows are extracted alike. An empty table
gives no rows. Columns other than ``page_id, url, html`` are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from .tasks import columns_as, map_arrow

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
# Their text is never shown as text.
HIDDEN = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea button title".split())
# What a head can hold; any other element ends a head that was left open.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# Only these, and what is in them, can be closed by the slash of their own tag.
FOREIGN = frozenset(["svg", "math"])
BESIDE = frozenset("nav aside footer form menu dialog".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
BESIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar submenu breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay comment comments commentlist disqus reply replies "
    "respond discussion share sharing social related recommended newsletter subscribe subscription signup login search "
    "pagination pager widget skip copyright disclaimer".split()
)
# Those of the words that articles use for their own parts as well.
WEAK_WORDS = frozenset(
    "advertising sponsor sponsored promo promotion banner menu submenu toolbar notice notices consent notification alert "
    "overlay reply replies respond discussion share sharing social related recommended subscription search widget skip "
    "copyright disclaimer login".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A page has one of these around its content, as a rule.
MAIN = frozenset(["article", "main"])
_SIGMA, _RADIUS = 1.0, 2
# The share of the upper cluster's text that the content region must hold.
REGION_SHARE = 0.8
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")


@dataclass
class Line:
    parts: list[str]
    tags: int
    beside: bool
    path: tuple[int, ...]
    heading: bool
    # Elements around the line that their class or id names as beside; how many of them are
    # above the outermost article or main element, -1 without one.
    named: tuple[int, ...] = ()
    above: int = -1
    # In a first heading, article or main element.
    title: bool = False

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass
class Element:
    tag: str
    number: int
    beside: bool
    hidden: bool
    named: tuple[int, ...] = ()
    above: int = -1


def _beside(tag: str, attrs: list[tuple[str, str | None]], inside_main: bool) -> bool:
    """Whether the element or its role says that it is beside the main text."""
    if tag in BESIDE or (tag == "header" and not inside_main):
        return True
    for name, value in attrs:
        if name == "role" and (value or "").lower() in BESIDE_ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
    return False


def _name_words(tag: str, attrs: list[tuple[str, str | None]]) -> set[str]:
    """The words of its class and id that say so."""
    if tag in ("html", "body", *MAIN, *HEADINGS):
        return set()
    values = [value for name, value in attrs if name in ("class", "id") and value]
    return {word.lower() for value in values for word in _WORD.findall(value)} & BESIDE_WORDS


class _Lines(HTMLParser):
    """Cuts parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Element] = []
        self.tag_of: dict[int, str] = {}
        # Whether the words of a named element are all weak.
        self.weak: dict[int, bool] = {}
        self.pending = 0
        self.count = 0
        self.line: Line | None = None

    def _new_line(self) -> None:
        self.line = None

    def _add(self, text: str) -> None:
        if self.line is None:
            top = self.open[-1] if self.open else None
            self.line = Line(
                [], self.pending, bool(top and top.beside), tuple(e.number for e in self.open if e.tag in BLOCK),
                any(e.tag in HEADINGS for e in self.open[-3:]),
                top.named if top else (), top.above if top else -1, bool(top and top.above >= 0) or any(e.tag == "h1" for e in self.open),
            )
            self.pending = 0
            self.lines.append(self.line)
        self.line.parts.append(text)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tag()
        self._end_head(tag)
        if tag in BLOCK:
            self._new_line()
            if any(e.tag == "p" for e in self.open) and tag != "html":
                self._close("p")
        if tag == "br":
            if self.line is not None:
                self._add(" ")
            return
        if tag in VOID:
            return
        above = self.open[-1] if self.open else None
        self.count += 1
        inside_main = any(e.tag in MAIN for e in self.open)
        named = above.named if above else ()
        names_above = above.above if above else -1
        if names_above < 0 and tag in MAIN:
            names_above = len(named)
        if words := _name_words(tag, attrs):
            named = (*named, self.count)
            self.weak[self.count] = words <= WEAK_WORDS
        self.open.append(Element(
            tag, self.count, bool(above and above.beside) or _beside(tag, attrs, inside_main),
            bool(above and above.hidden) or tag in HIDDEN, named, names_above,
        ))
        self.tag_of[self.count] = tag

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        before = self.count
        self.handle_starttag(tag, attrs)
        if self.count > before and any(e.tag in FOREIGN for e in self.open):
            self.open.pop()

    def _end_head(self, tag: str | None) -> None:
        """Closes an open head before ``body``, and before text or a tag that it cannot hold."""
        if tag == "body" or (self.open and self.open[-1].tag == "head" and tag not in IN_HEAD):
            if any(e.tag == "head" for e in self.open):
                self._close("head")

    def handle_endtag(self, tag: str) -> None:
        self._tag()
        if tag in BLOCK:
            self._new_line()
        self._close(tag)

    def _tag(self) -> None:
        if self.line is None:
            self.pending += 1
        else:
            self.line.tags += 1

    def _close(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            # A paragraph does not reach out of the block that it is in.
            if tag == "p" and self.open[i].tag in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head(None)
        if self.open and self.open[-1].hidden:
            return
        if self.line is None and not data.strip():
            return
        self._add(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; beyond the ends are zeros."""
    kernel = np.exp(-0.5 * (np.arange(-_RADIUS, _RADIUS + 1) / _SIGMA) ** 2)
    return np.convolve(np.pad(ratios, _RADIUS), kernel / kernel.sum(), "valid")


def threshold(values: np.ndarray) -> float:
    """The threshold half-way between the means of the values on its two sides."""
    at = float(values.mean())
    for _ in range(100):
        low, high = values[values <= at], values[values > at]
        if not len(low) or not len(high):
            return at if len(high) else float(values.min())
        new = (low.mean() + high.mean()) / 2
        if abs(new - at) < 1e-9:
            break
        at = float(new)
    return at


def _judge_names(lines: list[Line], weak: dict[int, bool]) -> None:
    """Marks the lines as beside that are in an element so named."""
    sizes = np.array([0 if line.beside else len(line.text) for line in lines], float)
    ratios = sizes / np.array([max(line.tags, 1) for line in lines])
    if not ratios.any():
        return
    high = ratios >= threshold(smoothed(ratios))
    held: dict[int, float] = {}
    titled: set[int] = set()
    for line, n in zip(lines, sizes):
        for k in line.named:
            held[k] = held.get(k, 0) + n
        if line.title and n:
            titled.update(line.named)
    # An element that holds most of the text is a wrapper, unless there is content outside.
    ignored: set[int] = set()
    for k in sorted(k for k, n in held.items() if 2 * n > sizes.sum()):
        free = [i for i, line in enumerate(lines) if sizes[i] and k not in line.named and ignored.issuperset(line.named)]
        title = any(lines[i].title for i in free)
        outside = sum(sizes[i] for i in free if high[i] and not lines[i].heading)
        if not outside or (not title and (k in titled or outside < (1 - REGION_SHARE) * (held[k] + outside))):
            ignored.add(k)
    # Without an article or main element outside of all that is named, those inside count.
    if not any(line.above >= 0 and n and ignored.issuperset(line.named[: line.above]) for line, n in zip(lines, sizes)):
        for line in lines:
            line.named = line.named[max(line.above, 0) :]
    strong = np.array([any(not weak[k] and k not in ignored for k in line.named) for line in lines], bool)
    values = np.where(strong, 0, ratios)
    high = ratios >= threshold(smoothed(values)) if values.any() else np.zeros(len(lines), bool)
    own: dict[int, float] = {}
    dense: dict[int, float] = {}
    for line, n, up in zip(lines, sizes, high):
        for k in line.named:
            own[k] = own.get(k, 0) + n
            dense[k] = dense.get(k, 0) + n * bool(up)
    ignored |= {k for k, n in own.items() if weak[k] and 2 * dense[k] >= n > 0}
    for line in lines:
        line.beside = line.beside or not ignored.issuperset(line.named)


def lines_of(html: str) -> tuple[list[Line], dict[int, str]]:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = [line for line in parser.lines if line.text]
    if any(line.named for line in lines):
        _judge_names(lines, parser.weak)
    return lines, parser.tag_of


def extract(html: str | None) -> str:
    """The main text of a page; blocks are joined by one space."""
    lines, tag_of = lines_of(html or "")
    texts = [line.text for line in lines]
    sizes = np.array([len(t) for t in texts], float)
    ratios = np.array([0.0 if line.beside else n / max(line.tags, 1) for line, n in zip(lines, sizes)])
    if not ratios.any():
        return ""
    smooth = smoothed(ratios)
    # Smoothing lowers lines at the ends of the page; their own ratio may speak for them.
    upper = (np.maximum(smooth, ratios) >= threshold(smooth)) & (ratios > 0)
    total = sizes[upper].sum()
    held: dict[int, float] = {}
    for line, n, up in zip(lines, sizes, upper):
        if up:
            for number in line.path:
                held[number] = held.get(number, 0) + n
    # Of the elements that hold enough the last to begin is the smallest; single blocks of
    # text are no region unless there is nothing else.
    enough = [number for number, n in held.items() if n >= REGION_SHARE * total]
    marked = [number for number in enough if tag_of[number] in MAIN]
    region = max(marked or [n for n in enough if tag_of[n] in ("div", "section", "td", "body", "html")] or enough or [0])
    inside = [i for i, line in enumerate(lines) if not line.beside and (not region or region in line.path)]
    if not marked:
        # No element is named as the content: it reaches from the first line of the upper
        # cluster, and the headings before it, to the last.
        chosen = np.flatnonzero(upper)
        first, last = int(chosen[0]), int(chosen[-1])
        while first and lines[first - 1].heading and not lines[first - 1].beside:
            first -= 1
        inside = [i for i in inside if first <= i <= last]
    return " ".join(texts[i] for i in inside)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; no shuffle."""

    def each(batch):
        texts = [extract(html.as_py()) for html in batch.column("html")]
        yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    rows = columns_as(pages, page_id=("page_id", "bigint"), url=("url", "string"), html=("html", "string"))
    return map_arrow(rows, "page_id bigint, url string, text string, n_chars bigint", each)
