"""Operator 12: the main text of web pages.

One pass over the events of the standard library's parser turns a page into
*lines*: the text between two block boundaries, with the number of tags since
the line before, the share of link text and the container that holds it. No
tree is built. Then, per page:

1. the text-to-tag ratio of every line, smoothed along the page by a Gaussian;
2. the lines whose smoothed ratio reaches the ratios' standard deviation form
   the content cluster, the others the boilerplate cluster;
3. the content cluster's characters choose the region: the ``article`` elements
   that hold them, else ``main``, else the deepest container with most of them;
4. the text is every line of the region, however short, except those inside
   menus, headers and footers of the page, sidebars, notices, adverts, forms,
   scripts, styles and reader comments (by element, role, class or id).

Results that are defined here: a null or empty page, or one without main
text, gives the empty text; markup that is cut off at the page's end is
dropped (a text before it stays); declarations that are no HTML count as
comments; white space is what ``str.split`` takes for it; ``br`` is white
space inside its block. Repeated rows give repeated results. All other
columns of the input stay as they are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from immolens.llm.memory import give_back

SIGMA = 1.0                    # of the smoothing, in lines
RADIUS = 2                     # lines on each side that it covers
ARTICLE_SHARE = 0.25           # an article counts beside the largest one from this share of its text
REGION_SHARE = 0.3             # articles that hold less of the content cluster are teasers
DESCEND_SHARE = 0.8            # a container is left for the one inside it that holds as much

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript head title iframe object svg math canvas audio video".split())
BOILERPLATE = frozenset("nav footer aside form button select textarea dialog menu fieldset datalist".split())
CONTAINERS = frozenset("""html body main article section div header hgroup center ul ol dl table thead tbody tfoot
    tr td th blockquote figure details""".split())
BREAKS = frozenset("""p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption caption summary address hr legend option
    optgroup""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Words in a class or id that name boilerplate.
HINTS = frozenset("""ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo
    promotion menu nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar rail widget widgets toolbar
    topbar masthead header footer banner cookie cookies consent gdpr notice notices notification notifications alert
    disclaimer popup modal overlay newsletter subscribe subscription signup login share sharing social related
    recommended recommendations copyright search form""".split())
COMMENT_HINTS = frozenset("comment comments commentlist commentary respond replies disqus".split())

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_hint_cache: dict[str, int] = {}
PLAIN, SOFT, HARD = 0, 1, 2     # kinds of containers: text, boilerplate unless it holds the article, boilerplate


def _hint(name: str) -> int:
    """What a class or id says about its element."""
    known = _hint_cache.get(name)
    if known is None:
        found = {w.lower() for w in _WORD.findall(name)}
        known = HARD if found & COMMENT_HINTS else SOFT if found & HINTS else PLAIN
        if len(_hint_cache) < 100_000:
            _hint_cache[name] = known
    return known


class _PageLines(HTMLParser):
    """Collects lines and containers from parser events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # containers, in the order of their start tags; those inside container c are c + 1 .. last[c]
        self.tags, self.kinds, self.parents, self.last = ["#page"], [PLAIN], [-1], [0]
        self.stack = [0]
        self.opened = Counter()         # tags on the stack
        # lines
        self.texts, self.line_tags, self.links, self.homes, self.headings = [], [], [], [], []
        self.pieces, self.tag_count, self.link_chars, self.unseen = [], 0, 0, 0
        self.in_link = self.in_heading = self.paragraph = False

    # ------------------------------------------------------------- lines
    def _end_line(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            self.pieces = []
            if text:
                self.texts.append(text)
                self.line_tags.append(self.tag_count)
                self.links.append(min(self.link_chars, len(text)))
                self.homes.append(self.stack[-1])
                self.headings.append(self.in_heading)
                self.tag_count = 0
        self.link_chars = 0

    # -------------------------------------------------------- containers
    def _open(self, tag: str, kind: int) -> None:
        self.parents.append(self.stack[-1])
        self.stack.append(len(self.tags))
        self.last.append(len(self.tags))
        self.tags.append(tag)
        self.kinds.append(kind)
        self.opened[tag] += 1
        self.unseen += tag in UNSEEN

    def _close(self) -> str:
        c = self.stack.pop()
        tag = self.tags[c]
        self.last[c] = len(self.tags) - 1
        self.opened[tag] -= 1
        self.unseen -= tag in UNSEEN
        return tag

    def handle_starttag(self, tag, attrs):
        self.tag_count += 1
        if tag in VOID:
            if tag == "br":
                self.pieces.append(" ")
            elif tag == "hr":
                self._end_line()
            return
        if tag not in UNSEEN and self.opened["head"]:
            while self._close() != "head":           # the body begins
                pass
        block = tag in CONTAINERS or tag in BOILERPLATE or tag in UNSEEN or tag in BREAKS
        if block:
            self._end_line()
            if self.tags[self.stack[-1]] == "p":     # a marked paragraph ends where the next block begins
                self._close()
        kind = self._kind(tag, attrs)
        if tag == "a":
            self.in_link = True
        elif block:
            self.in_heading = tag in HEADINGS
        if (block and tag not in BREAKS) or kind != PLAIN or self.opened[tag]:
            if kind != PLAIN and not block:
                self._end_line()
            self._open(tag, kind)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)             # "/>" means nothing in HTML

    def handle_endtag(self, tag):
        self.tag_count += 1
        if tag == "a":
            self.in_link = False
        if tag in CONTAINERS or tag in BOILERPLATE or tag in UNSEEN or tag in BREAKS:
            self._end_line()
            self.in_heading = False
        if self.opened[tag]:
            self._end_line()
            while self._close() != tag:
                pass

    def _kind(self, tag: str, attrs) -> int:
        if tag in UNSEEN:
            return HARD
        inside_article = self.opened["article"] or self.opened["main"]
        kind = PLAIN
        if tag in BOILERPLATE:
            kind = SOFT if tag == "form" else HARD
        elif tag == "header" and not inside_article:
            kind = SOFT
        for name, value in attrs:
            if name in ("class", "id"):
                if value and tag not in ("html", "body", "main"):
                    hint = _hint(value)
                    if tag == "header" and inside_article and hint == SOFT:
                        hint = PLAIN                 # an article's own head
                    kind = max(kind, hint)
            elif name == "role":
                if (value or "").lower() in ROLES and tag not in ("html", "body", "main"):
                    kind = max(kind, SOFT)
            elif name == "hidden":
                kind = HARD
        return kind

    # -------------------------------------------------------------- text
    def handle_data(self, data):
        if not self.unseen:
            self.pieces.append(data)
            if self.in_link:
                self.link_chars += len(data.strip())

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def finish(self) -> None:
        """The end of the page: what is left is a text, or markup that was
        cut off."""
        if self.rawdata and not self.rawdata.startswith("<") and not self.cdata_elem:
            self.handle_data(unescape(self.rawdata))
        self._end_line()
        while self.stack:
            self._close()


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    weights = np.convolve(np.ones(len(ratios)), kernel)[RADIUS:RADIUS + len(ratios)]
    return np.convolve(ratios, kernel)[RADIUS:RADIUS + len(ratios)] / weights


def content_cluster(chars: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines have a smoothed text-to-tag ratio of at least the ratios'
    standard deviation."""
    smooth = _smoothed(chars / np.maximum(tags, 1))
    return smooth >= smooth.std()


def page_text(html: str | None) -> str:
    """The main text of one page, blocks joined by line feeds."""
    if not html:
        return ""
    page = _PageLines()
    page.feed(html)
    page.finish()
    if not page.texts:
        return ""
    count = len(page.tags)
    # A container is boilerplate by itself or by what holds it. Soft ones that hold the article (an element, or
    # the page's main heading) are not.
    shut = [False] * count                           # inside boilerplate, or inside another article
    holds = []
    for c in range(1, count):
        parent = page.parents[c]
        shut[c] = shut[parent] or page.kinds[parent] == HARD or page.tags[parent] == "article"
        if page.tags[c] in ("article", "main") and page.kinds[c] == PLAIN and not shut[c]:
            holds.append(c)
    first_h1 = next((h for h, heading in zip(page.homes, page.headings) if heading), None) if not holds else None
    dropped = np.zeros(count, dtype=bool)
    for c in range(1, count):
        kind = page.kinds[c]
        if kind == SOFT:
            a = bisect_left(holds, c)
            keeps = a < len(holds) and holds[a] <= page.last[c]
            if not keeps and first_h1 is not None:
                keeps = c <= first_h1 <= page.last[c] and page.tags[c] != "header"
            kind = PLAIN if keeps else HARD
        dropped[c] = kind == HARD or dropped[page.parents[c]]

    homes = np.array(page.homes)
    chars = np.array([len(t) for t in page.texts], dtype=np.float64)
    links = np.array(page.links, dtype=np.float64)
    kept = ~dropped[homes]
    if not kept.any():
        return ""
    content = content_cluster(chars, np.array(page.line_tags, dtype=np.float64)) & kept & (links < 0.5 * chars)
    if not content.any():
        content = kept
    region, whole = _region(page, homes, np.where(content, chars, 0.0), dropped)
    chosen = region & kept
    if not whole:
        chosen &= _trimmed(page, chosen, content, links >= 0.9 * chars)
    return "\n".join(page.texts[i] for i in np.flatnonzero(chosen).tolist())


def _region(page: _PageLines, homes: np.ndarray, mass: np.ndarray, dropped: np.ndarray) -> tuple[np.ndarray, bool]:
    """The lines of the region that the content cluster chooses, and whether
    it is an element that stands for the article."""
    per_home = np.bincount(homes, weights=mass, minlength=len(page.tags))
    upto = np.concatenate([[0.0], np.cumsum(per_home)])
    last = np.array(page.last)
    held = upto[last + 1] - upto[:-1]                # content characters inside each container

    def lines_of(containers) -> np.ndarray:
        inside = np.zeros(len(homes), dtype=bool)
        for c in containers:
            inside |= (homes >= c) & (homes <= last[c])
        return inside

    def outermost(tag: str) -> list[int]:
        found, end = [], -1
        for c in range(1, len(page.tags)):
            if page.tags[c] == tag and c > end and not dropped[c]:
                found.append(c)
                end = last[c]
        return found

    articles = outermost("article")
    best = max((held[c] for c in articles), default=0.0)
    articles = [c for c in articles if held[c] >= ARTICLE_SHARE * best]
    if best > 0 and sum(held[c] for c in articles) >= REGION_SHARE * held[0]:
        return lines_of(articles), True
    mains = [c for c in outermost("main") if held[c] > 0]
    if mains:
        return lines_of(mains), True
    children: dict[int, list[int]] = {}
    for d in range(1, len(page.tags)):
        children.setdefault(page.parents[d], []).append(d)
    c = 0
    while True:
        inner = [d for d in children.get(c, ()) if 0 < held[d] >= DESCEND_SHARE * held[c]]
        if not inner:
            return lines_of([c]), False
        c = inner[0]


def _trimmed(page: _PageLines, chosen: np.ndarray, content: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """Without an element that stands for the article: lists of links go, and
    so do the lines before and after the content cluster that are no headings
    right before it."""
    keep = chosen & ~(linked & np.array([page.tags[h] in ("ul", "ol", "dl", "table", "tr", "td") for h in page.homes]))
    seeds = np.flatnonzero(content & keep)
    if not len(seeds):
        return keep
    first = int(seeds[0])
    while first > 0 and chosen[first - 1] and page.headings[first - 1]:
        first -= 1
    keep[:first] = False
    keep[int(seeds[-1]) + 1:] &= ~linked[int(seeds[-1]) + 1:]
    return keep


def _texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    try:
        for batch in batches:
            yield pa.array([page_text(html.as_py()) for html in batch], pa.string())
    finally:
        give_back()


def main_text(html: Column | str) -> Column:
    """The main text of a column of pages (a string, never null)."""
    return F.arrow_udf(_texts, "string")(html)


def with_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``pages`` with the main text and its number of code points; columns of
    those names are replaced, all others stay."""
    found = pages.withColumn(text_col, main_text(F.col(f"`{html_col}`")))
    return found.withColumn(chars_col, F.length(F.col(f"`{text_col}`")).cast("long"))
