"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events; block tags cut it into
lines. A line's ratio is the number of its characters outside links per tag in
it; lines inside elements that never hold the article (menus, headers,
footers, sidebars, notices, adverts, forms, reader comments: by element, or by
the words of class, id and role) have ratio zero. A word or a form excludes no
element that holds the article or main element (of several, those under the
fewest such words), and a word none that holds most of the page's text and, if
the page has article or main elements, one of them (comments excepted). Inside
the article, headings are never left out for a word, blocks only if the whole
class, id or role names a part that is no text (``ad-slot``, ``comments``), and
for a word among others (``share-note``) only if most of the block's characters
stand in links. If that leaves no line, the words and forms don't count, and then only hidden
elements are left out. The ratios are smoothed with
a Gaussian and cut at their standard deviation; the lines above are the
content cluster. The content region is the innermost element that holds all
lines of the cluster (those of links alone don't count) and all article and
main elements with text; lists, tables, quotations and sections are no regions.
All its lines that are not inside excluded elements are the text: short
paragraphs of an article fall under the threshold but stand in its region.

Special cases: null, empty and white-space pages give the empty text, and so
do pages whose excluded elements hold links only; broken, unclosed and cut-off
markup is read as the parser reads it, and a silent element without its end
tag ends at the first block in it or with its parent; repeated rows each get their own
result; an empty table gives an empty result; only the kept columns and the
page are read. A page is handled whole, one at a time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_text

SIGMA = 1.0

#: Fixed lists of HTML elements: whose text is never shown as text, that never hold the article,
#: that hold others, and that only end a line.
SILENT = frozenset("script style noscript template iframe object svg canvas title select textarea button option "
                   "datalist audio video map math".split())
BOILERPLATE = frozenset("nav footer aside form dialog menu".split())
CONTAINERS = frozenset("html body div section article main header nav footer aside form dialog menu ul ol dl table tbody "
                       "thead tfoot tr td th blockquote figure fieldset details center".split())
#: Containers inside a text, which are no region of their own.
FLOW = frozenset("section ul ol dl table tbody thead tfoot tr td th blockquote figure".split())
LINES = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre br hr address caption figcaption summary legend "
                               "hgroup label".split())
#: Elements without an end, and those of them that a head may hold.
VOID = frozenset("br hr img input meta link base area col embed param source track wbr".split())
HEAD = frozenset(("meta", "link", "base"))

#: Words of class, id and role that mark what is not the article: whole words, and beginnings of words.
MARK_WORDS = frozenset("ad ads adv nav menu aside footer header banner cookie cookies notice alert popup modal social "
                       "share sharing related search login signup breadcrumb breadcrumbs pagination pager toolbar "
                       "copyright toc widget reply replies respond skip navigation complementary contentinfo "
                       "legal disclaimer privacy".split())
#: Words that stand beside marks in the name of such a part.
PART_WORDS = frozenset("area bar block body box button buttons column container content cta form group holder icon icons "
                       "inner item items left link links list module outer panel post posts right row section slot space "
                       "tags text title top bottom unit wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
MARK_STARTS = ("advert", "sponsor", "promo", "sidebar", "navbar", "comment", "disqus", "newsletter", "subscri", "consent",
               "gdpr", "recommend", "navig", "footer", "masthead")
#: Of those, the beginnings of words that mark readers' own texts.
READERS = ("comment", "disqus", "repl", "respond")
#: Words with such a beginning that mark nothing.
OTHER_WORDS = ("commentar", "commentat", "replac", "replic")
#: Of the marks, what an article may have inside it as its own head.
OWN_HEAD = frozenset(("header",))

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def marks(attrs: list[tuple[str, str | None]]) -> tuple[set[str], set[str]]:
    """The mark words of an element, and those of them that are its whole name or mark readers' texts."""
    found, telling = set(), set()
    for name, value in attrs:
        if name not in ("class", "id", "role") or not value:
            continue
        for token in value.split():
            words = [w.lower() for w in _WORDS.findall(token)]
            own = {w for w in words if w in MARK_WORDS or w.startswith(MARK_STARTS) and not w.startswith(OTHER_WORDS)}
            found |= own
            if all(w in own or w in PART_WORDS for w in words):
                telling |= own
            else:
                telling |= {w for w in own if w.startswith(READERS)}
    return found, telling


def hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(n == "hidden" or n == "aria-hidden" and v == "true" or n == "style" and v and _HIDDEN.search(v)
               for n, v in attrs)


class Events(HTMLParser):
    """A page's events, and for each silent element the event that its silence ends before.

    That is its own end tag or, where that is missing, the first block inside
    it or else the end of its parent. Silence without its own end tag hides no
    block.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events: list[tuple] = []
        self.ends: dict[int, int] = {}
        #: Open blocks and silent elements: tag, event, first block inside.
        self.open: list[list] = []
        self.names: Counter = Counter()

    def handle_starttag(self, tag, attrs):
        here = len(self.events)
        self.events.append((tag, attrs))
        if tag in VOID or not (tag in LINES or tag in SILENT):
            return
        if self.open and (self.open[-1][0] == tag == "option" or tag in LINES and self.open[-1][0] == "p"):
            self.leave(len(self.open) - 1, here)
        if tag in LINES:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] not in SILENT or self.open[k][2] is not None:
                    break
                self.open[k][2] = here
        self.open.append([tag, here, None])
        self.names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        if tag not in SILENT:
            self.events.append((tag, attrs))
            if tag in CONTAINERS:
                self.events.append((tag,))

    def handle_endtag(self, tag):
        here = len(self.events)
        self.events.append((tag,))
        if self.names[tag]:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    own = self.open[k][1] if tag in SILENT else None
                    self.leave(k, here)
                    if own is not None:
                        self.ends[own] = here + 1
                    break
                if self.open[k][0] in CONTAINERS and tag not in CONTAINERS and tag not in SILENT:
                    break

    def handle_data(self, data):
        self.events.append((None, data))

    def unknown_decl(self, data):
        """Marked sections are no text."""

    def leave(self, k: int, here: int) -> None:
        """Elements from the ``k``-th open one end before event ``here``."""
        for tag, at, block in self.open[k:]:
            self.names[tag] -= 1
            if tag in SILENT:
                self.ends[at] = here if block is None else block
        del self.open[k:]

    def close(self):
        super().close()
        self.leave(0, len(self.events))


class Lines:
    """A page as lines: text, characters outside links, tags, container, why dropped; and the containers' parents.

    Why a container or line is left out: MARK by a word (or a form, which may
    hold the whole page), PART by its element, HIDDEN by its style; 0 if it
    isn't. SOFT ones, in the article, are left out if they are mostly links.
    """

    SOFT, MARK, PART, HIDDEN = 0.5, 1, 2, 3

    def __init__(self):
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.parent, self.name, self.why, self.readers = [-1], ["html"], [0], [False]
        self.inside = [False]  # whether an article or main element holds it (or it is one)
        self.open: list[int] = [0]
        self.names: Counter = Counter()
        self.head = False
        self.links = 0
        self.parts: list[str] = []
        self.chars = self.tags = 0
        self.dropped = 0

    def read(self, page: Events) -> None:
        at = 0
        while at < len(page.events):
            event = page.events[at]
            if event[0] is None:
                self.data(event[1])
            elif len(event) == 1:
                self.end(event[0])
            elif event[0] in SILENT and at in page.ends:
                at = page.ends[at]
                continue
            else:
                self.start(*event)
            at += 1
        self.end_line()

    def end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.chars, self.tags, self.open[-1], self.dropped))
        self.parts, self.chars, self.tags, self.dropped = [], 0, 0, 0

    def start(self, tag, attrs):
        if tag == "head" or self.head and tag in HEAD:
            self.head = True
            return
        self.head = False
        if tag in LINES:
            self.end_line()
        self.tags += 1
        if tag == "a":
            self.links = 1
        at = self.open[-1]
        inside = self.inside[at]
        if tag in LINES and tag not in CONTAINERS:
            found, _ = marks(attrs)
            found = found - OWN_HEAD
            self.dropped = (self.HIDDEN if hidden(attrs) else 0 if not found or inside and tag in HEADINGS else
                            self.SOFT if inside else self.MARK)
        elif tag in CONTAINERS and tag != "html":
            words, telling = marks(attrs)
            found = words - OWN_HEAD if inside else words
            why = (self.HIDDEN if hidden(attrs) else
                   self.PART if tag in BOILERPLATE and tag != "form" or tag == "header" and not inside else
                   self.MARK if tag == "form" else
                   0 if not found or tag in ("body", "main") else
                   self.SOFT if inside and not telling - OWN_HEAD else self.MARK)
            self.parent.append(at)
            self.name.append(tag)
            self.why.append(why)
            self.readers.append(any(w.startswith(READERS) for w in words))
            self.inside.append(inside or tag in ("article", "main"))
            self.open.append(len(self.name) - 1)
            self.names[tag] += 1

    def end(self, tag):
        if tag == "head":
            self.head = False
            return
        if tag in LINES:
            self.end_line()
        if tag == "a":
            self.links = 0
        if tag not in ("html", "body") and self.names[tag]:
            for k in range(len(self.open) - 1, 0, -1):
                self.names[self.name[self.open[k]]] -= 1
                if self.name[self.open[k]] == tag:
                    del self.open[k:]
                    break

    def data(self, data):
        self.parts.append(data)
        if not self.links:
            self.chars += len(data) - data.count(" ")

    def below(self, own: np.ndarray) -> np.ndarray:
        """Sums over each container and all in it."""
        own = own.copy()
        for k in range(len(own) - 1, 0, -1):  # a container comes after its parent
            own[self.parent[k]] += own[k]
        return own

    def out(self, least: int) -> np.ndarray:
        """Which containers are left out for reason ``least`` or a stronger one, with all below them."""
        found = np.array(self.why) >= least
        for k in range(1, len(found)):
            found[k] |= found[self.parent[k]]
        return found

    def excused(self) -> None:
        """Take the marks off containers that hold the article or most of the page's text."""
        hard, n = self.out(self.PART), len(self.name)
        chars = np.zeros(n)
        for _, c, _, at, dropped in self.lines:
            if not hard[at] and dropped < self.PART:
                chars[at] += c
        chars = self.below(chars)
        depth = np.zeros(n, int)  # marks on the way to a container
        for k in range(n):
            depth[k] = (self.why[k] == self.MARK) + (depth[self.parent[k]] if k else 0)
        articles = [k for k in range(n) if self.name[k] in ("article", "main") and chars[k] > 0]
        least = min((depth[k] for k in articles), default=0)
        some, held = np.zeros(n), np.zeros(n)
        some[articles] = 1
        held[[k for k in articles if depth[k] == least]] = 1
        some, held = self.below(some), self.below(held)
        for k in range(n):
            most = chars[k] > chars[0] / 2 and self.name[k] != "form"
            if self.why[k] == self.MARK and (held[k] or most and (not articles or some[k] and not self.readers[k])):
                self.why[k] = 0
        if not articles:
            self.lines = [x[:4] + (0,) if x[4] == self.MARK and x[1] > chars[0] / 2 else x for x in self.lines]


def smooth(x: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    radius = math.ceil(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def content(page: Lines, least: int) -> str | None:
    """The text of a page without what is left out for reason ``least`` or a stronger one; None if nothing is shown."""
    excluded = page.out(least)
    lines = [x for x in page.lines if x[4] < least]
    # soft ones that are mostly links
    linked, outside, every = [2 * x[1] < len(x[0]) - x[0].count(" ") for x in lines], np.zeros(len(page.name)), np.zeros(len(page.name))
    for x in lines:
        outside[x[3]] += x[1]
        every[x[3]] += len(x[0]) - x[0].count(" ")
    outside, every = page.below(outside), page.below(every)
    for k in range(1, len(page.name)):
        excluded[k] |= excluded[page.parent[k]] or page.why[k] == page.SOFT and 2 * outside[k] < every[k]
    shown = np.array([not excluded[x[3]] and not (x[4] == page.SOFT and at_links) for x, at_links in zip(lines, linked)], bool)
    if not any(x[1] or least == page.MARK for x, s in zip(lines, shown) if s):
        return None
    chars = np.array([x[1] for x in lines], float) * shown
    ratio = smooth(chars / np.maximum([x[2] for x in lines], 1))
    cluster = (ratio >= min(ratio.std(), ratio[shown].max())) & shown
    # what the region holds: the cluster's lines with text outside links, and the articles with such text
    anchor = cluster & (chars > 0) if chars.any() else cluster
    own, text = np.zeros(len(page.name)), np.zeros(len(page.name))
    for k in np.flatnonzero(shown):
        own[lines[k][3]] += anchor[k]
        text[lines[k][3]] += chars[k]
    text = page.below(text)
    own += [n in ("article", "main") and t > 0 and not out for n, t, out in zip(page.name, text, excluded)]
    own = page.below(own)
    region = max(np.flatnonzero(own == own[0]).tolist())  # the innermost, as a container comes after its parent
    while page.name[region] in FLOW:
        region = page.parent[region]
    inside = np.zeros(len(page.name), bool)
    inside[region] = True
    for k in range(region + 1, len(page.name)):
        inside[k] = inside[page.parent[k]]
    return " ".join([x[0] for x, s in zip(lines, shown) if s and inside[x[3]]])


def closed(html: str) -> str:
    """The page without comment marks that no mark ends, and with the signs < that no > follows as text:
    the parser would look for their ends again and again."""
    ends = html.rfind("-->") + 1 or html.rfind("--!>") + 1
    html = html[:ends] + html[ends:].replace("<!--", "")
    ends = html.rfind(">") + 1
    return html[:ends] + html[ends:].replace("<", "&lt;")


def main_text(html: str | None) -> str:
    """The article's text of a page, blocks joined by one space."""
    if not html or not html.strip():
        return ""
    events = Events()
    # a marked section's content is no text; the parser stops at kinds that it doesn't know
    events.feed(closed(html.replace("<![", "<!x[")))
    events.close()
    page = Lines()
    page.read(events)
    page.excused()
    for least in (page.MARK, page.PART, page.HIDDEN):
        text = content(page, least)
        if text is not None:
            return text
    return ""


def extract(pages: DataFrame, keep: tuple = ("page_id", "url"), html: str = "html") -> DataFrame:
    """The ``keep`` columns, text and n_chars of each page."""

    def make():
        def of(htmls):
            return {"text": pa.array([main_text(h) for h in htmls], pa.string())}

        return of

    got = by_text(pages, make, "text string", [c for c in keep if c not in ("text", "n_chars")], html)
    return got.withColumn("n_chars", F.length("text").cast("long"))
