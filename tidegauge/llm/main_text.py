"""Main text of web pages: parser events, text-to-tag ratios, smoothing, clustering."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrow import map_texts

#: Elements whose content is never main text.
SKIPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select "
    "textarea iframe object svg math canvas audio video dialog menu".split()
)
#: Words in a class, id or role that mark a part beside the main text.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment "
    "comments cookie cookies consent disclaimer disqus footer header masthead menu modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo promotion related "
    "reply replies share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: Elements that begin and end a line.
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption "
    "figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Elements that hold a whole article.
CONTAINERS = frozenset(["article", "main"])
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that a start tag ends, whose end tag HTML lets one omit, and what it doesn't look beyond.
CLOSES = (
    {tag: (frozenset(["p"]), frozenset("td th table caption button".split())) for tag in (
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 "
        "h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul"
    ).split()}
    | {"li": (frozenset(["li", "p"]), frozenset("ul ol menu table".split()))}
    | {tag: (frozenset(["dt", "dd", "p"]), frozenset(["dl", "table"])) for tag in ("dt", "dd")}
    | {tag: (frozenset(["td", "th"]), frozenset(["tr", "table"])) for tag in ("td", "th")}
    | {"tr": (frozenset(["tr"]), frozenset("tbody thead tfoot table".split()))}
    | {
        tag: (frozenset("tbody thead tfoot caption".split()), frozenset(["table"]))
        for tag in ("tbody", "thead", "tfoot")
    }
)
#: What an end tag other than those of tables doesn't look beyond, and what may be in a head.
CELLS = frozenset("td th caption table".split())
TABLES = CELLS | frozenset("tr tbody thead tfoot body html".split())
IN_HEAD = frozenset(
    "base basefont bgsound link meta noscript script style template title".split()
)
#: Standard deviation of the smoothing in lines; the share of the mean that a line of content
#: reaches; the lines below it in a row that stay in the text even if they are links.
SIGMA = 1.5
SHARE = 0.5
GAP = 3
_WORD = re.compile(r"[a-z]+")
#: A character number of more digits than Python reads.
_LONG_NUMBER = re.compile(r"&#[0-9]{4000,};?")


@dataclass
class Line:
    text: str
    tags: int
    linked: int  # characters within links
    container: int  # 0: outside of any
    sides: tuple[int, ...]  # elements around it that may be beside the main text


class PageLines(HTMLParser):
    """Lines of a page as its parser events stream by."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self._parts: list[str] = []
        self._tags = self._linked = 0
        self._in_link = False
        self._open: list[str] = []  # blocks and what is skipped or may be
        self._counts: Counter[str] = Counter()  # of the open ones
        self._skip: int | None = None  # place of the skipped element among the open ones
        self._sides: list[tuple[int, int]] = []  # places and numbers of elements perhaps beside
        self._side_count = 0
        self._holders: set[int] = set()  # those of them that hold or are a container
        self._containers: list[int] = []
        self._seen = 0

    def finish(self) -> list[Line]:
        self.close()
        self._line()
        return self.main_lines()

    def _line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            container = self._containers[0] if self._containers else 0
            sides = tuple(number for _, number in self._sides)
            self.lines.append(Line(text, self._tags, self._linked, container, sides))
        self._tags = self._linked = 0
        self._in_link = False  # a link that is never closed ends with its line
        self._parts.clear()

    def _close(self, size: int) -> None:
        """End all but so many of the open elements."""
        self._counts.subtract(self._open[size:])
        del self._open[size:]
        if self._skip is not None and self._skip >= size:
            self._skip = None
        while self._sides and self._sides[-1][0] >= size:
            self._line()
            self._tags = 1
            self._sides.pop()

    def handle_starttag(self, tag, attrs):
        ends, beyond = CLOSES.get(tag, ((), ()))
        if any(self._counts[e] for e in ends):
            size = len(self._open)
            for at in range(len(self._open) - 1, -1, -1):
                if self._open[at] in beyond:
                    break
                if self._open[at] in ends:
                    size = at
            self._close(size)
        if self._skip is not None:
            skipped = self._open[self._skip]
            if (tag == "body" and skipped == "title") or (skipped == "head" and tag not in IN_HEAD):
                self._close(self._skip)  # a head that was never closed
            else:
                if tag in BLOCKS or tag == skipped:
                    self._push(tag)
                return
        side = _beside(attrs) if tag not in VOID and tag != "body" else 0
        if tag in SKIPPED or side == 2:
            self._line()
            self._skip = len(self._open)
            self._push(tag)
        elif tag in BLOCKS or side:
            self._line()
            if side:
                self._side_count += 1
                self._sides.append((len(self._open), self._side_count))
            self._push(tag)
            if tag in CONTAINERS:
                self._seen += 1
                self._containers.append(self._seen)
                self._holders.update(number for _, number in self._sides)
        elif any(self._open[at] == tag for at, _ in self._sides):
            self._push(tag)
        self._tags += 1
        if tag == "a":
            self._in_link = True

    def _push(self, tag: str) -> None:
        if tag not in VOID:
            self._open.append(tag)
            self._counts[tag] += 1

    def handle_startendtag(self, tag, attrs):
        if self._skip is None:
            self._tags += 1
            if tag in BLOCKS:
                self._line()

    def handle_endtag(self, tag):
        skip, inside = self._skip, self._skip is not None
        for at in range(len(self._open) - 1, -1, -1) if self._counts[tag] else ():
            if self._open[at] == tag:
                if tag in BLOCKS and not inside:
                    self._line()
                self._close(at)
                inside = inside and at >= skip  # or the end of an element around the skipped one
                break
            if self._open[at] in CELLS and tag not in TABLES:
                break
        if inside:
            return
        self._tags += 1
        if tag == "a":
            self._in_link = False
        if tag in BLOCKS:
            self._line()
            if tag in CONTAINERS and self._containers:
                self._containers.pop()

    def handle_data(self, data):
        if self._skip is None:
            self._parts.append(data)
            if self._in_link:
                self._linked += len(data)

    def parse_marked_section(self, i, report=1):
        """Step over ``<![...>`` like a comment, as HTML does, whatever it holds."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def main_lines(self) -> list[Line]:
        """The lines but those of elements beside that hold no container and not most of the text."""
        total = sum(len(x.text) for x in self.lines)
        held: dict[int, int] = {}
        for line in self.lines:
            for side in line.sides:
                held[side] = held.get(side, 0) + len(line.text)
        beside = {k for k, v in held.items() if 2 * v <= total and k not in self._holders}
        return [x for x in self.lines if beside.isdisjoint(x.sides)]


def _beside(attrs) -> int:
    """2 if attributes say that an element is hidden or beside the main text, 1 if perhaps.

    A side word decides as a whole class, id or role; as a part of one, as in ``has-sidebar``, it
    may name what the element is beside of.
    """
    found = 0
    for name, value in attrs:
        if name in ("hidden",) or (name == "aria-hidden" and value == "true"):
            return 2
        if name in ("class", "id", "role") and value:
            if not SIDE_WORDS.isdisjoint(value.lower().split()):
                return 2
            if not SIDE_WORDS.isdisjoint(_WORD.findall(value.lower())):
                found = 1
    return found


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines, normalised at the ends."""
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def main_text(page: str | None) -> str:
    """The lines of the content regions, joined by one space; empty if there are none.

    Lines count their characters per tag. Where the smoothed ratio reaches a share of the page's
    mean, a line is of the content cluster. If any such lines lie in article or main elements, the
    text is that of all elements that hold some; otherwise it reaches from the first to the last
    line of the cluster. More than ``GAP`` lines in a row outside of the cluster, most of whose
    characters are links, are left out: a menu within the text. Other lists and headings stay.
    """
    if not page:
        return ""
    cut_off = page.rfind("<")
    if cut_off > page.rfind(">") and re.match(r"<[A-Za-z/!?]|<$", page[cut_off : cut_off + 2]):
        page = page[:cut_off]  # the page ends within a tag
    parser = PageLines()
    parser.feed(_LONG_NUMBER.sub("\ufffd", page))
    lines = parser.finish()
    if not lines:
        return ""
    sizes = np.array([len(x.text) for x in lines], float)
    ratio = smoothed(sizes / np.maximum(1, [x.tags for x in lines]))
    content = ratio >= SHARE * ratio.mean()
    at = np.flatnonzero(content)
    holders = {lines[i].container for i in at.tolist()} - {0}
    if holders:
        chosen = [i for i, x in enumerate(lines) if x.container in holders]
    else:
        chosen = range(int(at[0]), int(at[-1]) + 1)
    kept: list[Line] = []
    for in_cluster, run in groupby(chosen, key=lambda i: bool(content[i])):
        some = [lines[i] for i in run]
        menu = 2 * sum(x.linked for x in some) > sum(len(x.text) for x in some)
        if in_cluster or len(some) <= GAP or not menu:
            kept += some
    return " ".join(x.text for x in kept)


def extract_main_text(
    frame: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """The kept columns and ``text``, the main text of the whole page; one row for each row.

    Null, empty and text-free pages give an empty text; a page that ends anywhere, even within a
    tag, gives what came before. Repeated rows each give their row; other columns are left
    behind, whatever their names.
    """
    at = len(keep)
    names = list(keep)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out = {name: batch.column(i) for i, name in enumerate(names)}
            return out | {"text": list(map(main_text, batch.column(at).to_pylist()))}

        return work

    kinds = [f"`{n}` {frame.schema[n].dataType.simpleString()}" for n in keep]
    schema = ", ".join([*kinds, "text string"])
    pages = frame.select(*keep, F.col(html_column).alias("_page"))
    return map_texts(pages, "_page", make, schema)
