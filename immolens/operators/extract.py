"""Listing links of raw HTML pages -> Silver rows.

Parsing HTML is the one step built-in SQL functions cannot express, so it
runs as a ``mapInArrow`` over the page table: each Python worker receives
Arrow batches of pages and emits one row per listing link. There is no
shuffle; pages stay where the scan put them. Everything after the parse
(cleaning, filters) is JVM-side column expressions.

The events of the standard library's ``html.parser`` are read in one pass
with a stack of open elements, no tree is built: void elements are never opened, an end tag closes the
nearest open element of that name (unmatched end tags are ignored) and
elements still open at the end are closed there. The visible text of an
element (description, details) leaves out comments and the strings of
``script``, ``style``, ``template``, ``rt`` and ``rp``; the price search
looks at every string node in document order, comments included.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from immolens.functions import clean_text

# Elements that never have content or an end tag, elements without
# visible text, the links' path and the currency sign.
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
NON_TEXT_ELEMENTS = frozenset({"script", "style", "template", "rt", "rp"})
DEFAULT_HREF_PREFIX = "/immobilier/"
EURO = "€"

# The parser runs in Python workers. Shipping this module's code by value
# with each task means workers do not need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Plain start tags (every value in double quotes) and end tags, as the standard parser reads them.
_PLAIN_TAG = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?:\s+[a-zA-Z][-a-zA-Z0-9]*="[^"<>]*")*)\s*>')
_PLAIN_ATTRIBUTE = re.compile(r'([a-zA-Z][-a-zA-Z0-9]*)="([^"]*)"')
_PLAIN_LINK = re.compile(r'a href="([^"<>]*)"(?: title="([^"<>]*)")?')     # the commonest form, without < and >
_END_TAG = re.compile(r"</([a-zA-Z][-.a-zA-Z0-9:_]*)\s*>")


class _Open:
    """An open element: where its strings begin. One that holds a listing
    link's fields keeps them when it ends."""
    __slots__ = ("tag", "order", "text_at", "string_at", "article", "fields", "wanted")

    def __init__(self, tag, order, text_at, string_at, article):
        self.tag, self.order, self.text_at, self.string_at = tag, order, text_at, string_at
        self.article = self if tag == "article" else article
        self.fields, self.wanted = None, False


class _LinkEvents(HTMLParser):
    """Listing links from parser events, without a tree.

    Strings go to flat lists as they come; an open element is the place where
    its strings begin. Registers hold what a container is asked for in the end:
    the strings with a euro sign, the paragraphs, and which strings lie inside
    an element without visible text."""

    def __init__(self, wanted):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted                    # href -> does the link count
        root = _Open("#root", 0, 0, 0, None)
        self.open = [root]
        self.open_count: dict[str, int] = {}    # open elements per tag name
        self.elements = 0
        self.run: list[str] = []                # a run of text arrives in parts
        self.texts: list[str] = []              # stripped strings that may be visible
        self.inside: list[int] = []             # per text: its innermost element without visible text (0: none)
        self.silent = [0]                       # open elements without visible text
        self.hidden = 0                         # texts inside one
        self.strings = 0
        self.euro_at: list[int] = []            # numbers of the strings with a euro sign
        self.euros: list[str] = []
        self.p_orders: list[int] = []           # paragraphs in order of their start tags
        self.p_spans: list[list[int]] = []
        self.p_place: dict[int, int] = {}       # of the open ones
        self.links: list[tuple] = []            # (attributes, container)

    # ------------------------------------------------------------ strings
    def _string(self, text: str, visible: bool) -> None:
        if EURO in text:
            self.euro_at.append(self.strings)
            self.euros.append(text)
        self.strings += 1
        if visible:
            text = text.strip()
            if text:
                self.texts.append(text)
                self.inside.append(self.silent[-1])
                self.hidden += self.silent[-1] > 0

    def _end_text(self) -> None:
        if self.run:
            run, self.run = self.run, []
            self._string(run[0] if len(run) == 1 else "".join(run), True)

    def handle_data(self, data):
        self.run.append(data)

    def handle_comment(self, data):
        self._end_text()
        self._string(data, False)

    def handle_decl(self, decl):
        self._end_text()

    def handle_pi(self, data):
        self._end_text()

    def unknown_decl(self, data):
        self._end_text()
        if data.upper().startswith("CDATA["):   # <![CDATA[...]]> content counts as text
            self._string(data[6:], True)

    # ----------------------------------------------------------- elements
    def _begin(self, tag, attrs) -> None:
        if self.run:
            self._end_text()
        self.elements += 1
        if tag == "a" and self.wanted(attrs):
            parent = self.open[-1]
            container = parent.article or parent
            container.wanted = True
            self.links.append((attrs, container))
        elif tag == "p":
            self.p_place[self.elements] = len(self.p_spans)
            self.p_orders.append(self.elements)
            self.p_spans.append([len(self.texts), len(self.texts)])

    def handle_starttag(self, tag, attrs):
        self._begin(tag, attrs)
        if tag not in VOID_ELEMENTS:
            self.open.append(_Open(tag, self.elements, len(self.texts), self.strings, self.open[-1].article))
            self.open_count[tag] = self.open_count.get(tag, 0) + 1
            if tag in NON_TEXT_ELEMENTS:
                self.silent.append(self.elements)

    def handle_startendtag(self, tag, attrs):
        self._begin(tag, attrs)

    def handle_endtag(self, tag):
        # An end tag with no open element of its name is ignored at once;
        # otherwise everything up to that element is closed, so the total work
        # stays linear in the page size.
        if self.run:
            self._end_text()
        if not self.open_count.get(tag):
            return
        while self._end().tag != tag:
            pass

    def _end(self) -> _Open:
        e = self.open.pop()
        if e.order:
            self.open_count[e.tag] -= 1
        if e.tag in NON_TEXT_ELEMENTS:
            self.silent.pop()
        elif e.tag == "p":
            self.p_spans[self.p_place.pop(e.order)][1] = len(self.texts)
        if e.wanted:
            try:
                e.fields = self._fields(e)
            except Exception as exc:                        # X8: its links are skipped, the page goes on
                e.fields = exc
        return e

    def _fields(self, e: _Open) -> tuple[str | None, str | None, str]:
        """Price, description and details of a container that ends here."""
        i = bisect_left(self.euro_at, e.string_at)
        price = self.euros[i] if i < len(self.euros) else None
        k = bisect_right(self.p_orders, e.order)
        first_p = self._text(self.p_orders[k], *self.p_spans[k]) if k < len(self.p_orders) else None
        return price, first_p, self._text(e.order, e.text_at, len(self.texts))

    def _text(self, order: int, start: int, end: int) -> str:
        """The visible strings of an element: not those inside an element
        without visible text that lies in it."""
        if not self.hidden:
            return " ".join(self.texts[start:end])
        return " ".join(t for t, inner in zip(self.texts[start:end], self.inside[start:end]) if inner <= order)

    def close(self):
        super().close()
        self._end_text()
        while self.open:
            self._end()

    # ------------------------------------ short ways for the commonest tags
    def parse_starttag(self, i):
        plain = _PLAIN_TAG.match(self.rawdata, i)
        if plain is None:
            return super().parse_starttag(i)
        tag, attrs = plain[1].lower(), ()
        if tag == "a" and plain[2]:             # attributes are only read on links
            attrs = [(k.lower(), unescape(v) if "&" in v else v) for k, v in _PLAIN_ATTRIBUTE.findall(plain[2])]
        self.handle_starttag(tag, attrs)
        if tag in self.CDATA_CONTENT_ELEMENTS:
            self.set_cdata_mode(tag)
        return plain.end()

    def parse_endtag(self, i):
        end = _END_TAG.match(self.rawdata, i) if self.cdata_elem is None else None
        if end is None:
            return super().parse_endtag(i)
        self.handle_endtag(end[1].lower())
        self.clear_cdata_mode()
        return end.end()


# Elements whose content the standard parser reads otherwise, or that hide text: pages with one take the events.
_SPECIAL_ELEMENTS = NON_TEXT_ELEMENTS | {"xmp", "iframe", "noembed", "noframes", "noscript", "textarea", "title", "plaintext"}
_KNOWN_TAGS = 4096              # distinct tags without attributes that are remembered
_tags: dict[str, tuple[str, bool] | None] = {}


def _tag_of(text: str) -> tuple[str, bool] | None:
    """(name, does it end an element) of what stands between < and >; None
    unless it is a plain tag of no special element."""
    known = _tags.get(text)
    if known is None:
        plain = _END_TAG.fullmatch(f"<{text}>") if text[:1] == "/" else _PLAIN_TAG.fullmatch(f"<{text}>")
        if plain is None or plain[1].lower() in _SPECIAL_ELEMENTS:
            return None
        known = (plain[1].lower(), text[0] == "/")
        if len(_tags) < _KNOWN_TAGS and len(text) < 32:
            _tags[text] = known
    return known


class _PlainPage(_LinkEvents):
    """What ``_fields`` reads of a page of plain tags, which is never fed."""

    def __init__(self):
        self.texts, self.euro_at, self.euros, self.p_orders, self.p_spans = [], [], [], [], []
        self.hidden = 0


def _plain_links(html: str, href_prefix: str) -> list[tuple] | None:
    """((href, title), fields) of the links of a page of plain tags and text
    alone, as ``_LinkEvents`` finds them; None for any other page. The markup
    is cut at its tags in one go, which takes a small part of the time."""
    page, links = _PlainPage(), []
    texts, euro_at, euros, p_orders, p_spans = page.texts, page.euro_at, page.euros, page.p_orders, page.p_spans
    strings = elements = 0
    # an open element: tag, order, first text, first string, article, its links, place among the paragraphs
    root = ("#root", 0, 0, 0, None, [], -1)
    opened, open_count = [root], {}
    tags = _tags

    def end(e) -> None:
        if e[6] >= 0:
            p_spans[e[6]][1] = len(texts)
        if e[5]:
            try:
                fields = page._fields(_Open(e[0], e[1], e[2], e[3], None))
            except Exception as exc:                        # X8, as in ``_LinkEvents._end``
                fields = exc
            for place in e[5]:
                links[place] = (links[place], fields)

    pieces = html.split("<")
    text = pieces[0]
    for n in range(1, len(pieces) + 1):
        if text:
            if "&" in text:
                text = unescape(text)
            if EURO in text:
                euro_at.append(strings)
                euros.append(text)
            strings += 1
            text = text.strip()
            if text:
                texts.append(text)
        if n == len(pieces):
            break
        inner, closed, text = pieces[n].partition(">")
        link = None
        found = tags.get(inner)
        if found is None:
            link = _PLAIN_LINK.fullmatch(inner)
            found = ("a", False) if link else _tag_of(inner)
        if not closed or found is None:
            return None
        tag, ends = found
        if ends:
            if open_count.get(tag):
                while True:
                    e = opened.pop()
                    open_count[e[0]] -= 1
                    end(e)
                    if e[0] == tag:
                        break
            continue
        elements += 1
        parent = opened[-1]
        article = parent[4]
        if tag == "a":
            if link:
                href, title = link.groups()
            else:
                attrs = {k.lower(): v for k, v in _PLAIN_ATTRIBUTE.findall(inner)}
                href, title = attrs.get("href"), attrs.get("title")
            if href and "&" in href:
                href = unescape(href)
            if href is not None and href.startswith(href_prefix):
                (article or parent)[5].append(len(links))
                links.append((href, unescape(title) if title and "&" in title else title))
        place = -1
        if tag == "p":
            place = len(p_spans)
            p_orders.append(elements)
            p_spans.append([len(texts), len(texts)])
        if tag not in VOID_ELEMENTS:
            e = [tag, elements, len(texts), strings, article, [], place]
            if tag == "article":
                e[4] = e
            opened.append(e)
            open_count[tag] = open_count.get(tag, 0) + 1
    while opened:
        end(opened.pop())
    return links


def parse_listing_links(html: str | None, href_prefix: str = DEFAULT_HREF_PREFIX,
                        require_title: bool = True) -> list[dict]:
    """Raw (uncleaned) fields of every listing link of one page, page order.

    A link counts when its ``href`` starts with ``href_prefix`` and both
    ``href`` and (unless ``require_title`` is False) ``title`` are non-empty.
    Its container is the nearest ``<article>`` ancestor, else its parent.
    A link whose fields cannot be read gets an ``error`` text instead (X8)
    and the page goes on; markup that the parser rejects gives one row with
    position 0 and the error. The page is read once, by parser events; links
    that share a container share its fields.
    """
    if not html:
        return []

    plain = _plain_links(html, href_prefix)
    if plain is not None:
        return [_failed(position, href, fields) if isinstance(fields, Exception) else
                {"position": position, "href": href, "title": title, "price": fields[0],
                 "description": fields[1], "details": fields[2], "error": None}
                for position, ((href, title), fields) in enumerate(plain, 1)
                if href and (title or not require_title)]

    def listed(attrs) -> bool:
        href = dict(attrs).get("href")
        return href is not None and href.startswith(href_prefix)

    page = _LinkEvents(listed)
    try:
        page.feed(html)
        page.close()
    except Exception as exc:
        return [_failed(0, None, exc)]
    rows = []
    for position, (attrs, container) in enumerate(page.links, 1):
        attrs = dict(attrs)
        href, title = attrs["href"], attrs.get("title")
        if href and (title or not require_title):
            if isinstance(container.fields, Exception):
                rows.append(_failed(position, href, container.fields))
                continue
            price, description, details = container.fields
            rows.append({"position": position, "href": href, "title": title, "price": price,
                         "description": description, "details": details, "error": None})
    return rows


def _failed(position: int, href: str | None, exc: Exception) -> dict:
    return {"position": position, "href": href, "title": None, "price": None,
            "description": None, "details": None, "error": repr(exc)}


LINK_FIELDS = [
    T.StructField("position", T.IntegerType()),
    T.StructField("href", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("error", T.StringType()),
]


def page_links(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = (),
               href_prefix: str = DEFAULT_HREF_PREFIX, require_title: bool = True,
               end_pattern: str | None = None) -> DataFrame:
    """One row per listing link with raw text fields (not cleaned).

    ``keep`` columns of the page row are carried to each of its links. With
    ``end_pattern`` there is one more row per page, and a column ``ends``:
    null on a link's row, else whether the page shows the pattern. So the
    cut-off needs no second look at the pages.
    """
    keep = list(keep)
    in_schema = pages.select(*keep, html_col).schema
    fields = LINK_FIELDS + ([T.StructField("ends", T.BooleanType())] if end_pattern else [])
    out_schema = T.StructType([in_schema[c] for c in keep] + fields)
    arrow_schema = to_arrow_schema(out_schema)
    arrow_fields = [arrow_schema.field(f.name) for f in fields]
    shows_end = re.compile(end_pattern).search if end_pattern else None

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page_index, links = [], []
            for i, html in enumerate(batch.column(html_col).to_pylist()):
                found = parse_listing_links(html, href_prefix, require_title)
                if shows_end:
                    found = [*found, {"ends": shows_end(html or "") is not None}]
                page_index += [i] * len(found)
                links += found
            # taking rows of the input keeps its column types, even when empty
            taken = batch.select(keep).take(pa.array(page_index, type=pa.int64()))
            columns = {c: taken.column(c) for c in keep}
            for f in arrow_fields:
                columns[f.name] = pa.array([link.get(f.name) for link in links], type=f.type)
            yield pa.RecordBatch.from_pydict(columns, schema=arrow_schema)

    return pages.select(*keep, html_col).mapInArrow(parse_batches, out_schema)


def extract_listings(pages: DataFrame, origin, html_col: str = "html",
                     source_col: str = "source_file", keep: Sequence[str] = (),
                     href_prefix: str = DEFAULT_HREF_PREFIX,
                     require_title: bool = True) -> DataFrame:
    """Pages -> Silver rows (title, details, price, description, url,
    source_file, position) plus ``keep`` columns.

    ``origin`` (site scheme and host) is a string or a Column; the absolute
    URL is origin + href (X3). Text fields are cleaned (X9), rows without
    title or url dropped (X10) and rows with neither price nor description
    dropped (X11). Links that failed to parse are dropped here; read them
    with ``page_links`` to inspect the ``error`` column.
    """
    origin_col = origin if not isinstance(origin, str) else F.lit(origin)
    carried = [c for c in keep if c != source_col]
    links = page_links(pages.withColumn("_origin", origin_col), html_col,
                       keep=[*carried, source_col, "_origin"], href_prefix=href_prefix,
                       require_title=require_title)
    return listings_of(links, F.col("_origin"), source_col, carried, require_title)


def listings_of(links: DataFrame, origin: Column, source_col: str = "source_file",
                carried: Sequence[str] = (), require_title: bool = True) -> DataFrame:
    """Silver rows of parsed links."""
    def given(c: str) -> Column:
        """Whether a cleaned text is not null, told from the raw one."""
        return F.col(c).isNotNull() & (F.col(c) != "")

    wanted = F.col("error").isNull() & origin.isNotNull() & F.col("href").isNotNull() & (given("price") | given("description"))
    if require_title:
        wanted = wanted & given("title")
    return (links.where(wanted)
              .select(
                  *carried,
                  clean_text("title").alias("title"),
                  clean_text("details").alias("details"),
                  clean_text("price").alias("price"),
                  clean_text("description").alias("description"),
                  F.concat(origin, F.col("href")).alias("url"),
                  F.col(source_col).alias("source_file"),
                  F.col("position").cast("long").alias("position")))
