"""Main text of web pages by the distribution of line blocks.

Markup is stripped to lines: a line is the text between two block tags, and
what stands in an element that is no article by its kind, role or class
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
reader comments) becomes a line without text.  Characters outside links are
summed over windows of ``WINDOW`` lines.  A surge point is where such a sum
leaves zero on its way to at least ``SURGE`` of the page's highest, a dive
point where it is back at zero; the lines between the two are the article.

A page that marks an ``article`` (else a ``main``) needs no height to tell it
from the rest: lines outside count nothing, and every rise inside is a surge.
Of several marked articles the one with most text is taken.  On a page without
marks, short lines at the edges that end no sentence and are no headings go.

One page is one row and one pass over its characters; rows never meet, so
there is no shuffle, and a task holds one Arrow batch of pages.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.llm.common import batch, prepare

WINDOW = 3  # lines
SURGE = 0.25  # of the highest window sum of a page without a marked article
EDGE = 80  # characters: a longer line at an edge is text whatever it ends with

INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math
meter nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
# Elements that hold no article.
ASIDE = frozenset("""head nav header footer aside form script style noscript template svg button select textarea
title iframe object canvas dialog menu audio video noembed noframes""".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
# Words of a class or id that say the same.
WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription share sharing social sidebar
menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments disqus respond related
recommended login signup search pagination pager toolbar skip banner""".split())
TITLES = frozenset("h1 h2 h3 h4 h5 h6".split())
# Start tags that end an open paragraph are all block tags; these end their like.
ALIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"""=[ \t\r\n]{0,16}(["'])|>""")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|style|itemprop|aria-hidden)(?:\s{0,16}=\s{0,16}(?:"([^"]*)"|'([^']*)'|([^\s>"']*)))?""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_ENDS = re.compile(r"""[.!?…。！？:;]["'”’»)\]]*$""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class _Tags:
    """End of each tag; a quotation mark that is never closed is no quotation mark."""

    def __init__(self, page: str) -> None:
        self.page, self.unclosed = page, set()

    def end(self, at: int) -> int:
        """Position of the ``>`` of the tag whose attributes begin at ``at``; -1: the page ends before."""
        end = self.page.find(">", at)
        if end <= at or '"' not in (source := self.page[at:end]) and "'" not in source:
            return end
        while stop := _STOP.search(self.page, at):
            mark = stop.group(1)
            if mark is None:
                return stop.start()
            close = -1 if mark in self.unclosed else self.page.find(mark, stop.end())
            if close < 0:
                self.unclosed.add(mark)
            at = stop.end() if close < 0 else close + 1
        return -1


def _attributes(source: str) -> dict[str, str]:
    return {name.lower(): double or single or bare for name, double, single, bare in _ATTRIBUTE.findall(source)}


def _named(value: str) -> bool:
    """Whether a class or id says that its element holds no article."""
    for name in value.lower().split():
        parts = _PARTS.split(name)
        if parts[0] not in ("has", "with", "no", "is", "without") and not WORDS.isdisjoint(parts):
            return True
    return False


def _is_aside(name: str, attributes: dict[str, str], inside: bool) -> bool:
    """inside: in an article, where a header holds the article's own title."""
    if name in ASIDE:
        return not (name == "header" and inside)
    if not attributes:
        return False
    if name in ("html", "body", "main") or name in TITLES:
        return False
    value = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if name == "article":
        return not {"comment", "comments"}.isdisjoint(_PARTS.split(value.lower()))
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attributes.get("style", "").lower().replace(" ", ""):
        return True
    if attributes.get("role", "").lower() in ROLES:
        return True
    if inside and {"header"} == WORDS.intersection(_PARTS.split(value.lower())):
        return False
    return _named(value)


def lines_of(page: str) -> list[tuple[str, int, int, int, bool]]:
    """(text, characters outside links, article, main, heading) of each line of a page.

    ``article`` and ``main`` number the marked element that a line stands in,
    from 1 on; 0 is outside.  A line inside an element that is no article has
    no text.
    """
    lines: list[tuple[str, int, int, int, bool]] = []
    parts: list[str] = []
    linked = 0
    stack: list[tuple[str, bool, int]] = []  # name, is an aside, the mark it opened: 1 article, 2 main
    opened: Counter[str] = Counter()
    asides = links = headings = 0
    marks, within = [0, 0, 0], [0, 0, 0]  # numbers given so far; depth of the open ones
    tags = _Tags(page)

    def close_line() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split()) if parts else ""
        lines.append((text, max(0, len(text) - linked),
                      marks[1] if within[1] else 0, marks[2] if within[2] else 0, headings > 0))
        parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal asides, links, headings
        name, aside, mark = stack.pop()
        opened[name] -= 1
        asides -= aside
        links -= name == "a"
        headings -= name in TITLES
        within[mark] -= mark > 0

    def text(piece: str) -> None:
        nonlocal linked
        if not asides:
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if links:
                linked += len(piece.strip())

    at, n = 0, len(page)
    while at < n:
        tag = page.find("<", at)
        if tag < 0:
            text(page[at:])
            break
        if tag > at:
            text(page[at:tag])
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = n if end < 0 else end + 3
            continue
        if page[tag + 1:tag + 2] in ("!", "?"):
            end = page.find(">", tag)
            at = n if end < 0 else end + 1
            continue
        closing = page.startswith("</", tag)
        found = _NAME.match(page, tag + 1 + closing)
        if not found:
            text("<")
            at = tag + 1
            continue
        name = found.group().lower()
        end = tags.end(found.end())
        if end < 0:  # the page was cut inside a tag
            break
        at = end + 1
        if name not in INLINE:
            close_line()
        if closing:
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name not in INLINE and opened["p"]:
            k = len(stack) - 1
            while k >= 0 and stack[k][0] in INLINE:
                k -= 1
            if stack[k][0] == "p":
                while len(stack) > k:
                    pop()
        if name in ALIKE and stack and stack[-1][0] in ALIKE[name]:
            pop()
        source = page[found.end():end]
        if name in VOID:
            if name in ("img", "wbr"):
                continue
        else:
            attributes = _attributes(source) if source.strip() else {}
            aside = _is_aside(name, attributes, within[1] + within[2] > 0)
            mark = 0
            if not asides and not aside:
                mark = (1 if name == "article" or attributes.get("itemprop", "").lower() == "articlebody"
                        else 2 if name == "main" or attributes.get("role", "").lower() == "main" else 0)
            if mark:
                marks[mark] += within[mark] == 0
                within[mark] += 1
            if name in RAW:
                stop = _RAW_END[name].search(page, at)
                at = stop.start() if stop else n
            stack.append((name, aside, mark))
            opened[name] += 1
            asides += aside
            links += name == "a"
            headings += name in TITLES
    close_line()
    return lines


def _marked(lines: list, k: int) -> int:
    """The number of the marked element with most text; 0: none is marked."""
    held: Counter[int] = Counter()
    for line in lines:
        if line[k]:
            held[line[k]] += line[1]
    return min(held, key=lambda m: (-held[m], m)) if sum(held.values()) else 0


def main_text(page: str | None) -> str:
    """The article of a page, white space as one space; empty: the page has none."""
    if not page:
        return ""
    lines = lines_of(page)
    marked = False
    for k in (2, 3):
        if number := _marked(lines, k):
            lines = [line for line in lines if line[k] == number]
            marked = True
            break
    weights = np.array([w for _, w, *_ in lines], np.int64)
    if not weights.any():
        return ""
    total = np.concatenate([[0], np.cumsum(weights), np.full(WINDOW, weights.sum())])
    sums = total[WINDOW:WINDOW + len(weights)] - total[:len(weights)]  # of the window that begins at each line
    risen = np.concatenate([[False], sums > 0, [False]])
    surges, dives = np.flatnonzero(risen[1:] & ~risen[:-1]), np.flatnonzero(~risen[1:] & risen[:-1])
    least = 1 if marked else SURGE * sums.max()
    kept = [line for a, z in zip(surges, dives) if sums[a:z].max() >= least
            for line in (lines[a:z] if marked else _inner(lines[a:z]))]
    return " ".join(line[0] for line in kept if line[0])


def _inner(lines: list) -> list:
    """Without the short lines at the edges that end no sentence and are no headings."""

    def is_edge(line: tuple, heading_counts: bool) -> bool:
        text, weight, _, _, heading = line
        if heading and heading_counts:
            return False
        return 2 * weight < len(text) or not text or text[0] == "©" or len(text) < EDGE and not _ENDS.search(text)

    a, z = 0, len(lines)
    while a < z and is_edge(lines[a], True):
        a += 1
    while z > a and is_edge(lines[z - 1], False):
        z -= 1
    return lines[a:z]


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page and its code points.

    A null, empty or text-free page has the empty text; a null page_id or url
    stays null.  Rows that repeat give a row each; pages of any length are
    read whole.  Other columns, whatever their names, are left behind.  An
    empty table gives no rows.
    """
    prepare(pages.sparkSession)
    wanted = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                          F.col(page).cast("string").alias("html"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            yield batch({"page_id": record.column(0), "url": record.column(1),
                         "text": [main_text(h) for h in record.column(2).to_pylist()]}, _OUT)

    found = wanted.mapInArrow(emit, "page_id long, url string, text string")
    return found.select("*", F.length("text").cast("long").alias("n_chars"))


# The pages of the given tables mark their article and hold no other
# boilerplate inside it, so that their text is what the mark encloses.
QUERY_SQL = """
WITH body AS (
    SELECT page_id, url, coalesce(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '') AS t FROM pages),
bare AS (
    SELECT page_id, url, regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM body),
said AS (
    SELECT page_id, url, regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS t FROM bare)
SELECT page_id, url, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS text,
       length(trim(regexp_replace(t, '\\s+', ' ', 'g'))) AS n_chars
FROM said
"""
