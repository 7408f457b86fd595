"""Main text of web pages: parser events, text-to-tag ratios, smoothing, threshold clusters."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import by_row

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
#: Nothing in these elements is text of the page.
MUTE = frozenset(
    "head script style noscript template svg math iframe object embed canvas audio video select option textarea button".split()
)
#: Elements that hold something beside the article.
BESIDE = frozenset("nav footer aside form dialog menu search".split())
REMARKS = frozenset("comment comments commentlist discussion disqus replies reply respond reviews".split())
#: Words in class, id or role that name what is beside the article.
NAMES = REMARKS | frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice alert popup modal overlay newsletter subscribe signup login sidebar sidenav menu nav navbar "
    "navigation breadcrumb breadcrumbs masthead footer contentinfo complementary share sharing social related "
    "recommended widget search pagination pager toolbar skip disclaimer".split()
)
#: The same outside an article only: an article may have a head line of its own.
HEADS = frozenset("header".split())
ARTICLE = frozenset("article main".split())
#: Standard deviation of the smoothing in lines; the threshold as a share of the mean ratio and, at most, in
#: characters a tag; lines below so many characters are short: their ratio says little.
SIGMA, SHARE, ENOUGH, SHORT = 1.0, 0.2, 20.0, 100
#: An element of an article that a class marks is beside it if its ratio is below this share of the article's,
#: or so much of its text is links.
NAMED_SHARE, LINKED = 0.5, 0.5
#: Share of the page's text from which an element marked by tag or by name is the page rather than beside it.
MOST, WHOLE = 0.5, 0.9
WORD = re.compile(r"[a-z]+")


@dataclass
class Element:
    tag: str
    above: tuple[int, ...]  # numbers of the elements around it
    beside: bool = False  # marks its content as no part of the article
    named: bool = False  # by class, id or role alone
    remarks: bool = False
    hidden: bool = False
    within: bool = False  # named by a class inside an article: its ratio decides
    article: bool = False


@dataclass
class Line:
    """A block of text, with the tags and link characters met in it."""

    inside: tuple[int, ...]
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    text: str = ""


class Lines(HTMLParser):
    """Turns parser events into lines; unclosed and stray tags are allowed for."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", ())]
        self.open = [0]
        self.lines = [Line((0,))]
        self.mute = 0
        self.links = 0

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are of no use here

    def _start_line(self) -> None:
        last = self.lines[-1]
        if last.parts:
            self.lines.append(Line(tuple(self.open)))
        else:
            last.inside = tuple(self.open)

    def _pop(self, depth: int) -> None:
        for number in self.open[depth:]:
            tag = self.elements[number].tag
            self.mute -= tag in MUTE
            self.links -= tag == "a"
        del self.open[depth:]

    def handle_starttag(self, tag: str, attrs) -> None:
        self.lines[-1].tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.lines[-1].parts.append(" ")
            return
        block = tag not in INLINE
        if self.mute and tag == "body":
            self._pop(1)  # a head that was not closed
        if block and not self.mute:
            # a paragraph ends where the next block starts, and with it what is open inside it
            for depth in range(len(self.open) - 1, 0, -1):
                above = self.elements[self.open[depth]].tag
                if above == "p" or above == tag == "li":
                    self._pop(depth)
                    break
                if above not in INLINE and above != "p":
                    break
        values = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
        element = Element(tag, tuple(self.open))
        if values or tag in BESIDE or tag in ARTICLE or tag in HEADS:
            within = any(self.elements[k].article for k in self.open)
            said = f"{values.get('class', '')} {values.get('role', '')}".lower()
            # inside an article only a whole class name counts, not a part of "notice-of-facts"
            words = set(said.split() if within else WORD.findall(said))
            if not within:  # inside, an id alone is an anchor such as "discussion"
                own = set(WORD.findall(values.get("id", "").lower()))
                words |= own & REMARKS if tag in ARTICLE else own
            names = NAMES if within else NAMES | HEADS
            element.remarks = bool(words & REMARKS)
            element.named = tag not in ("html", "body", "main") and bool(words & names)
            element.hidden = "hidden" in values or values.get("aria-hidden") == "true"
            element.beside = tag in BESIDE or element.hidden or (tag in HEADS and not within) or element.named
            by_class = not names.intersection(values.get("role", "").lower().split())
            element.within = within and element.named and by_class and not (element.remarks or element.hidden or tag in BESIDE)
            element.article = (tag in ARTICLE or "main" in words and "role" in values) and not element.named
        self.elements.append(element)
        self.open.append(len(self.elements) - 1)
        self.mute += tag in MUTE
        self.links += tag == "a"
        if block:
            self._start_line()

    def handle_endtag(self, tag: str) -> None:
        self.lines[-1].tags += 1
        for depth in range(len(self.open) - 1, 0, -1):
            above = self.elements[self.open[depth]].tag
            if above == tag:
                self._pop(depth)
                break
            if tag in INLINE and above not in INLINE:
                break  # a stray end of a phrase does not close the block around it
        if tag not in INLINE:
            self._start_line()

    def handle_data(self, data: str) -> None:
        if not self.mute:
            line = self.lines[-1]
            line.parts.append(data)
            if self.links:
                line.linked += len(data.strip())

    def read(self, html: str) -> list[Line]:
        self.feed(html)
        self.close()
        for line in self.lines:
            line.text = " ".join("".join(line.parts).split())
        return [x for x in self.lines if x.text]


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines, with the weights renormalised at the ends."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    whole = np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]
    return np.convolve(values, kernel)[reach : reach + len(values)] / whole


def _acquit(elements: list[Element], lines: list[Line]) -> None:
    """Unmark what only a class marks inside an article, unless its ratio is low or it is mostly links."""
    inside: dict[int, list[Line]] = {}
    rest = []
    for x in lines:
        own = [k for k in x.inside if elements[k].within]
        for k in own:
            inside.setdefault(k, []).append(x)
        if not own and any(elements[k].article for k in x.inside):
            rest.append(x)
    if not inside:
        return
    ratio = lambda some: sum(len(x.text) for x in some) / max(1, sum(x.tags for x in some))
    least = NAMED_SHARE * ratio(rest) if rest else 0.0
    for k, own in inside.items():
        linked = sum(x.linked for x in own) >= LINKED * sum(len(x.text) for x in own)
        elements[k].beside = ratio(own) < least or linked


def _beside(elements: list[Element], lines: list[Line]) -> np.ndarray:
    """Which lines lie in an element beside the article.

    A marked frame that holds an article, such as a form around the page or a
    page "with-sidebar", is no such element, unless an article outside has far
    more text, as with teasers. Without an article outside it, nor is a frame
    with most of the page's text; a form can be that inside an article, too.
    Hidden elements and readers' remarks always are.
    """
    frames = {k for e in elements if e.article for k in e.above}
    marked = [[k for k in x.inside if elements[k].beside] for x in lines]
    depth = np.array([len(m) for m in marked])
    if not depth.any():
        return depth > 0
    inside: dict[int, list[int]] = {}
    for i, m in enumerate(marked):
        for k in m:
            inside.setdefault(k, []).append(i)
    final = {k for k in inside if elements[k].hidden or elements[k].remarks}
    # text that is not a link and may be the page's
    sizes = np.array([0 if final.intersection(m) else max(0, len(x.text) - x.linked) for x, m in zip(lines, marked, strict=True)])
    article = np.array([any(elements[k].article for k in x.inside) for x in lines])
    total = sizes.sum()
    outside = sizes[article & (depth == 0)].sum()  # of articles in no marked frame
    held = {k: sizes[at].sum() for k, at in inside.items() if k not in final}
    for k in sorted(held, key=lambda k: (k not in frames, -held[k], k)):
        e, at = elements[k], np.array(inside[k])
        if k in frames:
            free = e.tag == "form" or 2 * held[k] >= outside
        else:
            free = held[k] > (WHOLE if e.named else MOST) * total and (not outside or e.tag == "form")
        if free:
            depth[at] -= 1
            outside += sizes[at[article[at] & (depth[at] == 0)]].sum()
    return depth > 0


def main_lines(elements: list[Element], lines: list[Line]) -> list[Line]:
    """The lines of the content regions.

    Each line has a ratio of text characters to tags; lines beside the article
    have 0. The ratios are smoothed and lines above a threshold form clusters:
    a share of the mean, but no more than ``ENOUGH`` characters a tag. Where
    article elements hold most of the clusters' text, all of them are the
    container, or else the innermost element around all clusters. The clusters'
    lines in the container are returned, and its short lines, such as heads and
    list items, whose own ratio says little. Outside of article elements, lines
    that are links and little else are left out.
    """
    if not lines:
        return []
    _acquit(elements, lines)
    beside = _beside(elements, lines)
    sizes = np.array([len(x.text) for x in lines], float)
    ratios = np.where(beside, 0.0, sizes / np.array([max(1, x.tags) for x in lines]))
    if not ratios.any():
        return []
    level = smoothed(ratios)
    article = np.array([any(elements[e].article for e in x.inside) for x in lines])
    links = ~article & np.array([x.linked >= 0.8 * len(x.text) for x in lines])
    region = level >= min(SHARE * level.mean(), ENOUGH)
    above = region & ~beside & ~links
    if not above.any():
        above = ~beside & ~links
    if not above.any():
        return []
    kept = ~beside & (region | (sizes < SHORT))
    if 2 * sizes[above & article].sum() >= sizes[above].sum():
        return [lines[k] for k in np.flatnonzero(article & kept)]
    around = set.intersection(*(set(lines[k].inside) for k in np.flatnonzero(above)))
    container = max(around)
    return [lines[k] for k in np.flatnonzero(kept & ~links) if container in lines[k].inside]


def extract(html: str | None) -> str:
    """The main text of a page, its blocks joined by one space; empty where there is none."""
    parser = Lines()
    lines = parser.read(html or "")
    return " ".join(x.text for x in main_lines(parser.elements, lines))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages(page_id, url, html)``.

    NULL and empty pages have an empty text; text outside of any element is
    extracted like a page of one block. Repeated rows give repeated rows; extra
    columns are not read.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.mapInArrow(by_row(lambda i, url, html: (i, url, extract(html)), schema), "page_id bigint, url string, text string")
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
