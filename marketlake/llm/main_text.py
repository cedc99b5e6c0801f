"""Main text of web pages by the distribution of text over lines.

Markup is stripped first: every block-level tag ends a line, a boundary of a
container (``div``, ``section``, ``article`` and such) also leaves blank lines, as
many as a window is long, and what stands in elements that are never the article
(menus, footers, sidebars, forms, scripts; by tag, role, or a word of class or id)
leaves no line at all. A line's length is the number of its characters outside
links. Sums of these lengths over sliding windows of lines form hills. The surge
point is the first line of the first hill whose top reaches the threshold, the dive
point is the end of the last such hill, and the text between them is kept whole,
short lines included, as are headings right before the surge point.

The lines that take part are those of one element: of the ``article`` or ``main``
with the highest hill, all of whose hills count; on a page that marks none, of the
smallest container that holds more than half of the page's text outside links. There
a hill counts from ``HILL_CHARS`` characters or half of the highest on.

A page is handled by itself, so work is linear in its length but for deep nesting.

Defined results: a null or empty page, or one without text, has an empty text.
Repeated rows and null addresses pass through. Character references are decoded as
HTML5 says; references cut off (``&am``) stay as they are. Tags that never close are
closed by what they stand in, a comment or script that never ends runs to the end of
the page, a ``<`` that opens no tag is text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices

#: Lines in a window, and characters of a window that make a hill count where no element marks the article.
WINDOW, HILL_CHARS = 3, 86

# Elements and words of HTML.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
NEVER = RAW | frozenset("nav footer aside form button select input object embed svg canvas audio video map menu dialog head".split())
CONTAINERS = frozenset("html body main article section div center header footer aside nav form fieldset table td th details dialog".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote address figure figcaption hr caption thead tbody tfoot tr summary hgroup legend option optgroup search menu".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted sidebar sidebars aside nav navbar navigation menu menus breadcrumb breadcrumbs footer footers"
    " cookie cookies consent gdpr notice notices alert popup popups modal overlay newsletter subscribe subscription signup login comment comments disqus reply replies respond"
    " share sharing social related recommended recommendations widget widgets toolbar pagination pager skip search form"
    " commentlist guestbook adsbygoogle adbox adslot adunit topnav sidenav mainnav mainmenu topmenu sitefooter pagefooter colophon paywall disclaimer".split()
)
HEADS = frozenset("header masthead banner topbar siteheader pageheader".split())
#: Words that take the meaning from HEADS, and from MARKS.
OF_ARTICLE, NOT_ITSELF = frozenset("article post entry content story title".split()), frozenset("has with no without".split())
IN_HEAD = frozenset("title base link meta style script noscript template head".split())
#: An open tag of the key closes these without a tag of their own, up to the nearest container or list.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = frozenset("ul ol dl table select".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
_HEADING = re.compile("h[1-6]$")


def never(tag: str, attributes: str, in_article: bool, strict: bool = True) -> bool:
    """Whether an element with these attributes can't hold the article's text. strict: by its words too, or if it is a form."""
    if tag in NEVER and (strict or tag != "form") or tag == "header" and not in_article:
        return True
    if not strict or not attributes or "=" not in attributes or tag in ("html", "body", "main"):
        return False
    found = {name.lower(): unescape(a or b or c) for name, a, b, c in _ATTRIBUTE.findall(attributes)}
    if found.get("role", "").lower() in ROLES:
        return True
    words = {w.lower() for w in _NAME.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    if words & NOT_ITSELF:
        return False
    return bool(words & MARKS or words & HEADS and not words & OF_ARTICLE and not in_article and tag != "article")


class Page:
    """Lines of a page: text, characters outside links, and the elements that hold them."""

    def __init__(self, html: str, strict: bool = True):
        self.strict, self.lost = strict, False  # lost: an article or main stands in what is stripped
        self.lines: list[str] = []
        self.weights: list[int] = []
        self.holders: list[int] = []
        self.gaps: list[bool] = []
        self.heads: list[bool] = []  # whether the line is a heading
        #: Elements by number: parent's number, and whether it is an article or main.
        self.parents, self.articles = [-1], [False]
        self.stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # tag, number of the holder, stripped, inside an article
        self.standing: dict[str, int] = {}  # elements of the stack by tag
        self.parts: list[str] = []
        self.weight = self.links = 0
        self.gap = True
        self.read(html)

    def read(self, html: str) -> None:
        at, raw, size = 0, "", len(html)
        while at < size:
            if raw:
                end = re.compile(f"</{raw}(?=[\\s/>]|$)", re.I).search(html, at)
                at, raw = end.start() if end else size, ""
                continue
            m = _TOKEN.search(html, at)
            self.text(html[at : m.start() if m else size])
            if not m:
                break
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if m[1]:
                    self.close(tag)
                else:
                    self.open(tag, m[3])
                    raw = tag if tag in RAW and not m[3].endswith("/") else ""
        self.end_line()

    def text(self, piece: str) -> None:
        if piece and not self.stack[-1][2]:
            self.parts.append(piece)
            if not self.links:
                self.weight += len(piece)

    def end_line(self) -> None:
        if not self.parts:
            return
        line = _SPACE.sub(" ", unescape("".join(self.parts))).strip()
        if line:
            self.lines.append(line)
            self.weights.append(min(self.weight, len(line)))
            self.holders.append(self.stack[-1][1])
            self.gaps.append(self.gap)
            self.heads.append(bool(_HEADING.match(self.stack[-1][0])))
            self.gap = False
        self.parts, self.weight = [], 0

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag == "a":
            self.links = 1
            if attributes and not self.stack[-1][2] and never(tag, attributes, self.stack[-1][3], self.strict):
                self.push(tag, self.stack[-1][1], True, self.stack[-1][3])
            return
        if self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self.drop(len(self.stack) - 1)
        if tag in BLOCKS:
            self.end_line()
            self.links = 0
            self.leave({"p"})
            if tag in CLOSES:
                self.leave(CLOSES[tag])
            if tag in CONTAINERS:
                self.gap = True
        if tag in VOID:
            return
        _, holder, stripped, inside = self.stack[-1]
        out = stripped or never(tag, attributes, inside, self.strict)
        if tag in BLOCKS or tag in RAW or out != stripped:
            article = tag in ("article", "main") or 'role="main"' in attributes.lower()
            self.lost |= article and out
            if tag in CONTAINERS:
                self.parents.append(holder)
                self.articles.append(article and not out)
                holder = len(self.parents) - 1
            self.push(tag, holder, out, inside or article)

    def push(self, tag: str, holder: int, out: bool, inside: bool) -> None:
        self.stack.append((tag, holder, out, inside))
        self.standing[tag] = self.standing.get(tag, 0) + 1

    def drop(self, k: int) -> None:
        """Ends the stack's elements from the k-th on."""
        for tag, *_ in self.stack[k:]:
            self.standing[tag] -= 1
        del self.stack[k:]

    def leave(self, tags: set[str]) -> None:
        """Closes the innermost of these elements, if no container or list stands between."""
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k][0]
            if tag in tags:
                self.drop(k)
                return
            if tag in LISTS or tag in CONTAINERS:
                return

    def close(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        if tag in BLOCKS:
            self.end_line()
            if tag in CONTAINERS:
                self.gap = True
        for k in range(len(self.stack) - 1, 0, -1) if self.standing.get(tag) else ():
            held = self.stack[k][0]
            if held == tag:
                self.drop(k)
                return
            if tag not in CONTAINERS and held in CONTAINERS:
                return

    def hills(self, some: list[int]) -> list[tuple[int, int, int]]:
        """Hills of the window sums over the lines ``some`` and the blank lines between containers: first line, last line, top."""
        cuts = [k for k in range(1, len(some)) if self.gaps[some[k]] or some[k] != some[k - 1] + 1]
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(some)], strict=True):
            upto = np.concatenate([[0], np.cumsum([self.weights[i] for i in some[a:b]])])
            k = np.arange(len(upto) - 1 + WINDOW - 1)  # windows that reach into the hill from either side
            sums = upto[np.minimum(k + 1, len(upto) - 1)] - upto[np.maximum(k + 1 - WINDOW, 0)]
            out.append((some[a], some[b - 1], int(sums.max())))
        return out

    def chosen(self) -> tuple[list[int], bool]:
        """Numbers of the lines that take part, and whether an element marks them as the article."""
        everything = list(range(len(self.lines)))
        held: dict[int, int] = {}
        outer = [-1] * len(self.parents)  # outermost article or main around each element; parents come first
        for k in range(1, len(outer)):
            outer[k] = outer[self.parents[k]] if outer[self.parents[k]] >= 0 or not self.articles[k] else k
        articles: dict[int, list[int]] = {}
        for i in everything:
            if (top := outer[self.holders[i]]) >= 0:
                articles.setdefault(top, []).append(i)
        if articles:
            return max(articles.values(), key=lambda x: (max(top for *_, top in self.hills(x)), -x[0])), True
        for i in everything:
            held[self.holders[i]] = held.get(self.holders[i], 0) + self.weights[i]
        # Containers are numbered after their parents, so sums pass upwards from the last one.
        total = [held.get(k, 0) for k in range(len(self.parents))]
        for k in range(len(total) - 1, 0, -1):
            total[self.parents[k]] += total[k]
        smallest = max((k for k in range(len(total)) if 2 * total[k] > total[0]), default=0)
        inside = [False] * len(total)
        for k in range(len(total)):
            inside[k] = k == smallest or (k > smallest and inside[self.parents[k]])
        return [i for i in everything if inside[self.holders[i]]], False

    def main(self) -> list[str]:
        """Lines from the surge point to the dive point."""
        if not self.lines:
            return []
        some, marked = self.chosen()
        hills = self.hills(some)
        least = 0 if marked else min(HILL_CHARS, max(top for *_, top in hills) / 2)
        high = [h for h in hills if h[2] >= least]
        surge = some.index(high[0][0])
        while surge and self.heads[some[surge - 1]]:
            surge -= 1
        return [self.lines[i] for i in some[surge:] if i <= high[-1][1]]


def extract(html: str | None) -> str:
    """Main text of a page, its blocks two line ends apart."""
    if not html:
        return ""
    page = Page(html)
    if not page.lines and page.lost:  # the whole page is a form, or in an element named after its sidebar
        page = Page(html, strict=False)
    return "\n\n".join(page.main())


def extract_main_text(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``df`` without the pages, with their main ``text``; a column of that name is replaced."""
    kept = [f for f in df.schema.fields if f.name not in (html, text)]
    schema = T.StructType([*kept, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            found = pa.array(map(extract, batch.column(html).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), found], names=schema.names)

    return df.select(*(f.name for f in kept), html).mapInArrow(run, schema)
