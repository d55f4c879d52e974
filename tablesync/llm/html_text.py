"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block of text; scripts, styles and comments go with it. Text inside furniture
(menus, forms, footers, adverts, reader comments, by element or by class and id) is marked, and left out once the whole
page is read, but only where the furniture is no wrapper of the article: an element that holds most of the text of
the article elements, or, on a page without such, most of the page's text without links, is none. Each remaining line has its text length without link text; summed over sliding windows of lines, these
lengths surge where the article begins and dive where it ends. The run of lines between surge and dive
with the most text is the core; it is widened to the container element that holds all of it, so
short lines at the edges (a headline, a last sentence) stay, and lines mostly of links are left out
where that container is the whole page.

Defined results: a null or empty html, or one without text, gives "" and 0; a page whose text outside links is all inside
furniture is read as if it had none; unclosed or cut markup is
read to its end, in time and memory that grow with its length however deep its elements lie in one another; repeated rows and null ids are rows like any other; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3  # lines summed
THRESHOLD = 40  # characters a window needs for a surge

# Elements by their part in a page.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp", "svg", "math"}
NEVER = {"head", "button", "select", "option", "object", "canvas", "audio", "video", "map"}
PARTS = {"nav", "footer", "aside", "menu", "dialog"}
HEAD = {"base", "html", "link", "meta"}  # do not end the head
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
BOXES = {"html", "body", "div", "main", "article", "section", "td", "center", "table", "tbody", "tr", "header"}
WIDGETS = (
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside "
    "footer foot header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login search form share sharing social "
    "comment comments commentlist respond disqus reply replies discussion related recommended widget pagination pager toolbar legal copyright skip hidden"
).split()
# Furniture that may hold more text than a short article, and words before one that say the element is not it.
DECLARED = set("cookie cookies consent gdpr dialog alertdialog menu navigation complementary contentinfo comment comments commentlist respond disqus reply replies discussion".split())
ABOUT = {"no", "non", "not", "with", "without", "has", "is", "hide", "show"}
WRAPPER, OWN, HARD = 1, 2, 3

_MARKUP = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*)([^>=]*(?:=(?:\s*\"[^\"]*(?:\"|\Z)|\s*'[^']*(?:'|\Z))?[^>=]*)*)(?:>|\Z)|<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")


def furniture(tag: str, attributes: str, in_article: bool) -> int:
    """0 for article text, else ``WRAPPER`` (may be around the article), ``OWN`` (says what it is) or ``HARD`` (never text)."""
    if tag in NEVER:
        return HARD
    if tag in PARTS:
        return OWN
    kind = WRAPPER if tag == "form" or tag == "header" and not in_article else 0
    if not attributes or tag in ("html", "body", "article", "main"):
        return kind
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return OWN
        if name == "role" and value in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "form"):
            kind = max(kind, OWN if value in DECLARED else WRAPPER)
        if name in ("class", "id"):
            for words in map(_WORDS.split, value.split()):
                if words[0] not in ABOUT and any(w in WIDGETS for w in words):
                    kind = max(kind, OWN if words[0] in DECLARED else WRAPPER)
    return kind


@dataclass
class Line:
    text: str
    links: int  # characters inside links
    box: int  # the innermost container element around it


@dataclass
class Part:
    raw: str
    links: int
    mark: int  # the innermost furniture around it
    article: bool  # inside an article or main element

    @property
    def plain(self) -> int:
        return len(self.raw.strip()) - self.links


class _Nest:
    """Elements that lie in one another, numbered as they open: 0 is the page. Each knows only what it lies in, so that
    deep nesting costs no more than flat."""

    def __init__(self):
        self.above, self.depth, self.now = [0], [0], 0

    def open(self) -> int:
        self.above.append(self.now)
        self.depth.append(self.depth[self.now] + 1)
        self.now = len(self.above) - 1
        return self.now

    def close(self) -> None:
        self.now = self.above[self.now]

    def sums(self, own: list[int]) -> list[int]:
        """Of each element, ``own`` of itself and of all inside it."""
        total = list(own)
        for n in range(len(total) - 1, 0, -1):
            total[self.above[n]] += total[n]
        return total

    def inside(self, good: list[bool]) -> list[bool]:
        """Whether an element and all around it are ``good``."""
        out = [True] * len(good)
        for n in range(1, len(good)):
            out[n] = good[n] and out[self.above[n]]
        return out

    def common(self, numbers: list[int]) -> int:
        """The innermost element that holds all of them."""
        held = self.sums(_counts(numbers, len(self.above)))
        return max((n for n, k in enumerate(held) if k == len(numbers)), key=lambda n: self.depth[n])

    def within(self, box: int) -> list[bool]:
        """Whether each element is ``box`` or lies in it."""
        out = [n == box for n in range(len(self.above))]
        for n in range(1, len(out)):
            out[n] = out[n] or out[self.above[n]]
        return out


class _Reader:
    """Lines of a page from its markup, as parts with marks."""

    def __init__(self):
        self.lines: list[tuple[list[Part], int]] = []
        self.parts: list[Part] = []
        self.open: list[tuple[str, int, bool]] = []  # tag, kind of furniture, whether it counts as article
        self.where: dict[str, list[int]] = {}  # the places in ``open`` of each tag
        self.blocks: list[int] = []  # and of all that are not inline
        self.boxes, self.marks = _Nest(), _Nest()
        self.box_at: list[int] = []  # places in ``open`` of the containers
        self.kinds: list[int] = [0]  # of the marks
        self.mains: list[int] = []  # marks around a main element
        self.around: list[int] = []  # marks around an outermost article element
        self.articles = self.skipped = self.linked = 0  # how many article elements, elements without text, and links are open

    def text(self, raw: str) -> None:
        if raw and not self.skipped:
            self.parts.append(Part(raw, len(raw.strip()) if self.linked else 0, self.marks.now, self.articles > 0))

    def cut(self) -> None:
        if self.parts:
            self.lines.append((self.parts, self.boxes.now))
            self.parts = []

    def kept(self, free: list[bool]) -> list[Line]:
        """The lines without the furniture that is not ``free``."""
        out, shown = [], self.marks.inside(free)
        for parts, box in self.lines:
            parts = [x for x in parts if shown[x.mark]]
            text = " ".join(html.unescape("".join(x.raw for x in parts)).split())
            if text:
                out.append(Line(text, sum(x.links for x in parts), box))
        return out

    def held(self, weigh) -> list[int]:
        """What all parts inside each mark weigh; that of the page is the total."""
        own = [0] * len(self.kinds)
        for parts, _ in self.lines:
            for x in parts:
                own[x.mark] += weigh(x)
        return self.marks.sums(own)

    def wrappers(self) -> list[bool]:
        """The furniture that is around the article and so is none."""
        held, of_article = self.held(lambda x: x.plain), self.held(lambda x: x.plain * x.article)
        total, article = held[0], of_article[0]
        around, mains = (self.marks.sums(_counts(marks, len(self.kinds))) for marks in (self.around, self.mains))
        free = [True] * len(self.kinds)
        for n, kind in enumerate(self.kinds[1:], 1):
            most, most_article = 2 * held[n] > total, 2 * of_article[n] > article
            free[n] = kind == WRAPPER and (most_article or most and 4 * article < total) or kind == OWN and around[n] > 0 and most_article and most or mains[n] > 0
        return free

    def result(self) -> list[Line]:
        if len(self.kinds) == 1:
            return self.kept([True])
        free = self.wrappers()
        lines, shown = self.kept(free), self.marks.inside(free)
        held = self.held(lambda x: x.plain)
        if held[0] and not _surges(lines) and not any(x.article and x.plain and shown[x.mark] for parts, _ in self.lines for x in parts):
            # no article outside the furniture
            lines = self.kept([f or 2 * h > held[0] and h > 10 * THRESHOLD for f, h in zip(free, held, strict=True)])
            if not any(len(x.text) > x.links for x in lines):
                lines = self.kept([True] * len(free))
        return lines

    def close(self, at: int) -> None:
        while len(self.open) > at:
            tag, kind, article = self.open.pop()
            self.where[tag].pop()
            if tag not in INLINE:
                self.blocks.pop()
            if tag in BOXES:
                self.box_at.pop()
                self.boxes.close()
            if kind in (WRAPPER, OWN):
                self.marks.close()
            self.skipped -= kind == HARD
            self.articles -= article
            self.linked -= tag == "a"

    def start(self, tag: str, attributes: str) -> None:
        block = tag not in INLINE
        if self.open and self.open[-1][0] == "head" and tag not in HEAD:  # its end may be left out
            self.close(len(self.open) - 1)
        if block:
            self.cut()
            paragraph = self.where.get("p")
            if paragraph and (not self.box_at or paragraph[-1] > self.box_at[-1]):  # a block ends an open paragraph
                self.close(paragraph[-1])
        elif tag == "br":
            self.text(" ")
        if tag in VOID or attributes.rstrip().endswith("/"):
            return
        kind = furniture(tag, attributes, self.articles > 0)
        if kind and not block:
            self.text(" ")
        if kind in (WRAPPER, OWN):
            self.marks.open()
            self.kinds.append(kind)
        article = tag == "main" or tag == "article" and furniture("div", attributes, True) != OWN
        if article:
            if not self.articles:
                self.around.append(self.marks.now)
            if tag == "main":
                self.mains.append(self.marks.now)
            self.articles += 1
        self.where.setdefault(tag, []).append(len(self.open))
        if block:
            self.blocks.append(len(self.open))
        if tag in BOXES:
            self.box_at.append(len(self.open))
            self.boxes.open()
        self.open.append((tag, kind, article))
        self.skipped += kind == HARD
        self.linked += tag == "a"

    def end(self, tag: str) -> None:
        block, places = tag not in INLINE, self.where.get(tag)
        # an inline end does not close a block
        if places and (block or not self.blocks or places[-1] > self.blocks[-1]):
            if block:
                self.cut()
            self.close(places[-1])
        elif block:
            self.cut()


def _counts(numbers: list[int], n: int) -> list[int]:
    out = [0] * n
    for k in numbers:
        out[k] += 1
    return out


def page_lines(page: str) -> tuple[list[Line], _Nest]:
    """Text lines of a page, without its furniture, and its containers."""
    reader, at = _Reader(), 0
    low = None
    while match := _MARKUP.search(page, at):
        reader.text(page[at : match.start()])
        at = match.end()
        slash, tag, attributes = match.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            reader.end(tag)
        elif tag in RAW and not attributes.rstrip().endswith("/"):
            low = page.lower() if low is None else low
            if len(low) != len(page):  # a letter whose lower case is longer
                low = re.sub(r"[A-Z]", lambda m: m[0].lower(), page)
            end = low.find("</" + tag, at)
            at = len(page) if end < 0 else end
            if end >= 0:
                close = page.find(">", end)
                at = len(page) if close < 0 else close + 1
        else:
            reader.start(tag, attributes)
    if at < len(page):
        rest = page[at:]
        reader.text(rest[: rest.rfind("<")] if re.search(r"<[/a-zA-Z!][^>]*\Z", rest) else rest)
    reader.cut()
    return reader.result(), reader.boxes


def _surges(lines: list[Line]) -> bool:
    plain = [max(0, len(x.text) - x.links) for x in lines]
    return any(sum(plain[k : k + WINDOW]) > THRESHOLD for k in range(len(plain)))


def core_run(lengths: np.ndarray) -> tuple[int, int]:
    """(first, end) of the run of lines between a surge and a dive of the window sums that has the most text."""
    n = len(lengths)
    sums = np.convolve(lengths, np.ones(WINDOW), "full")[WINDOW - 1 :]  # of a line and those after it
    if sums.max(initial=0) <= THRESHOLD:
        return (0, n) if lengths.sum() else (0, 0)
    runs, at = [], 0
    while at < n:
        if sums[at] > THRESHOLD and lengths[at] > 0:
            end = at
            while end < n and sums[end] > 0:  # the dive: a window without text
                end += 1
            runs.append((int(lengths[at:end].sum()), -at, end))
            at = end
        at += 1
    total, begin, end = max(runs, default=(0, 0, n))
    return -begin, end


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in order, parted by two line feeds."""
    lines, boxes = page_lines(page) if page else ([], None)
    if not lines:
        return ""
    plain = np.array([max(0, len(x.text) - x.links) for x in lines])
    first, end = core_run(plain)
    core = lines[first:end]
    if not core:
        return ""
    shared = boxes.common([x.box for x in core])
    if boxes.depth[shared] <= 2:  # html and body: nothing but the page holds the core
        inside = [x for k, x in enumerate(lines) if first <= k < end or 2 * x.links < len(x.text) and x.box == core[0].box]
    else:
        within = boxes.within(shared)
        inside = [x for x in lines if within[x.box]]
    return "\n\n".join(x.text for x in inside)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; one pass, no shuffle."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
