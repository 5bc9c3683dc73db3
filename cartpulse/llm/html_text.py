"""Main text of web pages by differencing with the nearest page of the same host.

Pages are sorted by host and URL path, so that a page's neighbours are the pages with
the nearest URLs, and a host with very many pages lies in many partitions. The pages at
both ends of a partition also go to the partition next to it, so that the partitioning
changes no result. A page's text lines are aligned with those of its nearer neighbour by
a longest common subsequence, and lines that both share are deleted as furniture of the
site.

Two things differencing cannot tell are settled by the markup: menus and notices that
differ from page to page go by their elements and class names, and lines inside an
article stay even if the neighbour repeats the article. Where articles hold little of a
page's text, as with teasers beside a story, differencing decides.
"""

from __future__ import annotations

import bisect
import html as entities
import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.bpe import STEP_BYTES
from cartpulse.llm.frames import pieces

# HTML elements by their role.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "title",
       "xmp", "noembed", "noframes", "object", "canvas", "audio", "video"}
FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu",
             "fieldset", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s",
          "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "wbr"}
# Names in class, id and role that mark furniture of a site, and what may
# stand beside them in a compound such as cookie-notice or related-posts.
MARKS = {"ad", "ads", "advert", "advertisement", "adverts", "alert", "banner", "breadcrumb",
         "breadcrumbs", "comment", "comments", "complementary", "contentinfo", "consent",
         "cookie", "cookies", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar",
         "navigation", "newsletter", "notice", "popup", "promo", "recommended", "related",
         "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored", "subscribe",
         "toolbar", "widget"}
BESIDE = {"area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container",
          "content", "count", "form", "global", "inner", "item", "items", "left", "link", "links",
          "list", "main", "outer", "overlay", "page", "panel", "post", "posts", "primary", "right",
          "secondary", "section", "site", "slot", "thread", "top", "unit", "wrap", "wrapper"}
# Beginnings of names of reader comments, after an optional owner.
_COMMENTS = re.compile(r"(?:(?:user|reader|blog|post|article|page)[-_]?)?"
                       r"(?:comments?|repl(?:y|ies)|discussions?|disqus)(?![a-z0-9])")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)(?![\w-])")
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Share of a page's lines beyond which the neighbour may be a near copy of it, so that the
#: page's other neighbour is asked as well.
COPY = 0.8
#: Times its articles' text that a page has outside them if they are but teasers.
TEASER = 4
#: Places of a line from which its row of bits is held instead of built at each use.
_FREQUENT = 64


class Line(NamedTuple):
    text: str
    article: bool   # inside an article or main element
    furniture: bool


def _mark(attributes: str) -> str:
    """What attributes say of an element: hidden, marked (as furniture), or nothing.

    A name counts as a whole: every part of a compound must be a mark or stand beside one.
    """
    found = ""
    for attribute in _ATTRIBUTE.finditer(attributes or ""):
        name, value = attribute[1].lower(), (attribute[2] or "").strip("\"'").lower()
        if name == "hidden" or name == "style" and _UNSEEN.search(value):
            return "hidden"
        if name in ("class", "id", "role"):
            for token in value.split():
                parts = set(re.split(r"[-_]+", token))
                if _COMMENTS.match(token) or parts & MARKS and parts <= MARKS | BESIDE:
                    found = "marked"
    return found


def lines(page: str) -> list[Line]:
    """The blocks of text of a page in order, white space within each made one space."""
    found: list[Line] = []
    held: list[str] = []
    inside: list[tuple[str, str]] = []   # open elements that matter: (name, role)
    low = page.lower() if any(c in page for c in ("<", "&")) else ""

    def placed() -> tuple[bool, bool]:
        """Whether this place is an article's, and whether it is furniture. An article in an
        element that only its name or a form marks is not furniture for that; in an
        article's own header, headings stay."""
        article = heading = False
        for name, its in reversed(inside):
            heading |= name in _HEADING
            if its in ("hidden", "furniture") or its == "marked" and not article \
                    or its == "header" and not heading:
                return article, True
            article |= its == "article"
        return article, False

    def close_block() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            found.append(Line(text, *placed()))

    at = 0
    while at < len(page):
        tag = _TAG.search(page, at)
        if tag is None:
            held.append(page[at:])
            break
        held.append(page[at:tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue   # comment or declaration
        if name not in INLINE:
            close_block()
        if tag[1]:
            for k in range(len(inside) - 1, -1, -1):
                if inside[k][0] == name:
                    close_block()
                    del inside[k:]
                    break
            continue
        if name in RAW:
            end = low.find(f"</{name}", at)
            if end >= 0:
                at = end
            continue
        if name in VOID or tag[3].endswith("/"):
            continue
        mark = "" if name in ("html", "body") else _mark(tag[3])
        if name in FURNITURE and mark != "hidden":
            in_article = any(r == "article" for _, r in inside)
            mark = "marked" if name in ("form", "fieldset") else \
                "header" if name == "header" and in_article else "furniture"
        if mark:
            if low.find(f"</{name}", at) >= 0:   # else it would swallow the page
                close_block()
                inside.append((name, mark))
        elif name in ("article", "main"):
            inside.append((name, "article"))
        elif name in _HEADING or any(name == n for n, _ in inside):
            inside.append((name, ""))
    close_block()
    return found


def common(a: list[str], b: list[str]) -> set[int]:
    """The places in ``a`` of a longest common subsequence with ``b``.

    Equal heads and tails and lines of one side only are settled first. Of the rest, each
    line of ``a`` updates one row of bits, one for each line of ``b``; few rows are held,
    and those between are made again on the way back.
    """
    most = min(len(a), len(b))
    head = next((i for i in range(most) if a[i] != b[i]), most)
    tail = next((i for i in range(most - head) if a[-1 - i] != b[-1 - i]), most - head)
    shared = {*range(head), *range(len(a) - tail, len(a))}
    mine, its = set(a[head:len(a) - tail]), set(b[head:len(b) - tail])
    one = [i for i in range(head, len(a) - tail) if a[i] in its]
    two = [line for line in b[head:len(b) - tail] if line in mine]
    places: dict[str, list[int]] = {}
    for j, line in enumerate(two):
        places.setdefault(line, []).append(j)

    def bits(found: list[int]) -> int:
        made = bytearray(found[-1] // 8 + 1)
        for j in found:
            made[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(made, "little")

    frequent = {x: bits(found) for x, found in places.items() if len(found) >= _FREQUENT}
    full = (1 << len(two)) - 1

    def after(row: int, line: str) -> int:
        hits = row & (frequent[line] if line in frequent else bits(places[line]))
        return ((row + hits) | (row - hits)) & full

    step = max(1, math.isqrt(len(one)))
    held, row = [], full
    for n, i in enumerate(one):
        if n % step == 0:
            held.append(row)
        row = after(row, a[i])
    # zeros among the low j bits of row i: the length for i lines and j lines
    left = full
    for k in range(len(held) - 1, -1, -1):
        part = one[k * step:(k + 1) * step]
        rows = [held[k]]
        for i in part:
            rows.append(after(rows[-1], a[i]))
        for n in range(len(part) - 1, -1, -1):
            here, before = ~rows[n + 1] & left, ~rows[n] & left
            if here.bit_count() > before.bit_count():
                shared.add(part[n])
                left = (1 << here.bit_length() - 1) - 1
    return shared


def _segments(path: str) -> list[str]:
    return [s for s in path.split("/") if s]


def nearness(a: str, b: str) -> int:
    """Leading path segments that two URLs share."""
    count = 0
    for x, y in zip(_segments(a), _segments(b)):
        if x != y:
            break
        count += 1
    return count


def _texts(page: list[Line]) -> list[str]:
    return [x.text for x in page if not x.furniture]


def main_text(page: list[Line], neighbour: list[Line] | None,
              other: list[Line] | None = None) -> str:
    """The page's text without furniture and without lines it shares with the neighbour.

    A page equal to its neighbour keeps its text. If over ``COPY`` of it is shared, the
    neighbour may be a near copy or the site's template may be long: then only what
    ``other``, the neighbour on the other side, shares as well is deleted. Without one whose
    text differs, all shared lines go unless that is the whole page. Lines of an article are
    never deleted. Articles are the text, unless over ``TEASER`` times as much is left
    outside them; then that counts as well.
    """
    kept = [x for x in page if not x.furniture]
    inner = sum(len(x.text) for x in kept if x.article)
    outer = sum(len(x.text) for x in kept if not x.article)
    if neighbour and outer > TEASER * inner:
        mine = [x.text for x in kept]
        if mine != _texts(neighbour):
            shared = common(mine, [x.text for x in neighbour])
            if len(shared) >= COPY * len(kept):
                if other and mine != _texts(other):
                    shared &= common(mine, [x.text for x in other])
                elif len(shared) == len(kept):
                    shared = set()
            kept = [x for i, x in enumerate(kept) if x.article or i not in shared]
            outer = sum(len(x.text) for x in kept if not x.article)
    return "\n".join(x.text for x in kept if x.article or outer > TEASER * inner)


def _emitted(rows: list[tuple]) -> pa.RecordBatch:
    ids, urls, texts = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
         pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages one after the other, each with its nearer neighbour."""
    def read() -> Iterator[tuple]:
        for batch in batches:
            for part in pieces(batch, "html", STEP_BYTES):
                for row in zip(*(part.column(c).to_pylist()
                                 for c in ("page_id", "url", "host", "path", "visit", "html"))):
                    yield *row[:5], lines(row[5] or "")

    def done(before, page, after) -> tuple:
        near = [(nearness(page[3], x[3]), x[5]) for x in (before, after)
                if x is not None and page[2] and x[2] == page[2]]
        near.sort(key=lambda x: -x[0])
        return page[0], page[1], main_text(page[5], *([x[1] for x in near] or [None]))

    before = page = None
    rows, held = [], 0
    for after in read():
        if page is not None and not page[4]:
            rows.append(done(before, page, after))
            held += len(rows[-1][2])
            if held > STEP_BYTES or len(rows) >= 10_000:
                yield _emitted(rows)
                rows, held = [], 0
        before, page = page, after
    if page is not None and not page[4]:
        rows.append(done(before, page, None))
    if rows:
        yield _emitted(rows)


def _sortable(host: str, path: str, page_id: int | None) -> tuple:
    """A key that Python orders as Spark does: by code points, null first."""
    return host, path, page_id is not None, page_id or 0


def _places(ends: list[tuple[tuple, tuple]]):
    """For each page the partition it lies in and then those that it visits: a first page
    the one before, a last page the one after. ``ends`` holds both keys of each."""
    firsts = [first for first, _ in ends]

    def run(host: pa.Array, path: pa.Array, page_id: pa.Array) -> pa.Array:
        found = []
        for key in map(_sortable, host.to_pylist(), path.to_pylist(), page_id.to_pylist()):
            at = bisect.bisect_right(firsts, key) - 1
            place = [at]
            if at > 0 and key == ends[at][0]:
                place.append(at - 1)
            if at + 1 < len(ends) and key == ends[at][1]:
                place.append(at + 1)
            found.append(place)
        return pa.array(found, pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null html is empty and gives an empty text. Pages without a host in their URL have
    no neighbour. Repeated rows give repeated results; other columns play no part; an
    empty table gives no rows.
    """
    url = F.col("url").cast("string")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.col("html"),
        F.coalesce(F.lower(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)), F.lit(""))
        .alias("host"),
        F.coalesce(F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1), F.lit(""))
        .alias("path"))
    order = ["host", "path", "page_id"]
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The ranges come from the keys alone: two keys for each of ``parts`` partitions.
    key = F.struct(*order)
    ends = (rows.select(*order).repartitionByRange(parts, *order)
            .groupBy(F.spark_partition_id().alias("part"))
            .agg(F.min(key).alias("first"), F.max(key).alias("last")).collect())
    ends = sorted((_sortable(*r.first), _sortable(*r.last)) for r in ends)
    placed = rows.select("*", F.posexplode(_places(ends)(*order)).alias("visit", "part"))
    return (placed.repartitionById(parts, F.col("part"))
            .sortWithinPartitions(*order, "visit")
            .mapInArrow(_run, "page_id long, url string, text string, n_chars long"))
