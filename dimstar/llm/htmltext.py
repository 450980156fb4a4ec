"""Main text of HTML pages: structure, and differences to the page of the nearest URL.

Pages are dealt out in the order of host and path, so each task holds runs of
neighbours.  Pages of equal lines (copies) count as one.  A page is paired
with the neighbour on the same host whose path begins alike the longest, of
those whose lines differ; the lines of both are aligned by their longest
common subsequence, and lines they share are the site's, not the page's.

Lines are blocks of the page, each with what its markup says about it:

* inside ``article`` or ``main``, and nothing else against it: body;
* inside menus, footers, side bars, forms, adverts, comments and the like
  (by element, or by a word of class, id or role): furniture;
* neither: unmarked.

A word of a longer class name (``nav-open``) may speak of the layout instead:
``html`` and ``body`` are never furniture, an ``article`` or ``main`` only by
a whole name, and one inside a marked element is the body of a page that has
no other.

The difference deletes the shared lines of every page, but for body lines: a
paragraph quoted on many pages of a host is shared and yet the page's own.  Of
what is left, a page with body lines has these as its text, any other its
unmarked lines; marked furniture that the nearest page lacks (an advert, say)
goes by its mark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.llm.common import reachable
from dimstar.llm.urlfilter import host_and_path

# Elements of HTML by what they do.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "select", "head"}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FURNITURE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "label", "fieldset"}
BODY = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table",
    "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
# Words of a class, an id or a role that mark furniture.
MARKS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "legal",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo",
    "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget", "widgets",
}

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S,
)
NAMED = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORDS = re.compile(r"[a-z]+")
# A name with one of these tells of what is elsewhere on the page.
LAYOUT = {"has", "no", "with", "without"}

INSIDE = {"body", "within", "deep"}  # an article; one inside an element marked by a word, or by a whole name

Line = tuple[str, str]  # text, and "body", "furniture" or "unmarked"


def _marked(name: str, attributes: str, whole: bool = False) -> bool:
    """Whether a class, id or role marks an element as furniture, by a word of it or (``whole``) as a whole."""
    if name in {"html", "body"}:
        return False
    tokens = [t for v in NAMED.findall(attributes) for t in v.lower().strip("\"'").split()]
    if whole or name in BODY:
        return not MARKS.isdisjoint(tokens)
    return any(not MARKS.isdisjoint(w) and LAYOUT.isdisjoint(w) for w in map(WORDS.findall, tokens))


def lines(html: str | None) -> list[Line]:
    """The blocks of a page with text, in page order, white space tidied."""
    html = html or ""
    out: list[Line] = []
    parts: list[tuple[str, str]] = []  # pieces of the open block, each with its kind
    endless: set[str] = set()  # raw elements of which no end follows
    stack: list[tuple[str, str]] = []  # open elements, and the kind of what is inside
    at, kind = 0, "unmarked"
    strict = 0  # depth of the outermost open element that a whole name marks, 0 without one

    def flush() -> None:
        """The block's own text, and what stood in furniture inside it as a line apart."""
        for inside in (False, True):
            own = [p for p in parts if (p[1] == "furniture") is inside]
            text = " ".join(unescape("".join(t for t, _ in own)).split())
            if text:
                out.append((text, next(k for t, k in own if t.strip())))
        parts.clear()

    lower = None
    found = MARKUP.search(html)
    while found:
        parts.append((html[at : found.start()], kind))
        at = found.end()
        closing, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if name:
            name = name.lower()
            if name in RAW and not closing and not attributes.endswith("/"):
                lower = lower or html.lower()
                end = -1
                if name not in endless:
                    ends = ("</head", "<body") if name == "head" else ("</" + name,)
                    end = next((i for i in (lower.find(e, at) for e in ends) if i >= 0), -1)
                    if end < 0:
                        endless.add(name)
                # Without an end, an element that only holds text ends with the page; others are ignored.
                if end >= 0:
                    at = end
                elif name in {"script", "style", "textarea"}:
                    at = len(html)
            elif name == "br":
                parts.append((" ", kind))
            elif name not in EMPTY:
                if name in BLOCKS:
                    flush()
                if not closing:
                    inner = kind
                    if name in BODY and not _marked(name, attributes):
                        within = any(k in INSIDE for _, k in stack)
                        # An article ends menus and the like that were left open, but not comments on an article.
                        if kind == "furniture" and stack and not within and any(n in FURNITURE or n == "header" for n, _ in stack):
                            stack.clear()
                            inner, strict = "unmarked", 0
                        if inner == "furniture":
                            inner = inner if within else "deep" if strict else "within"
                        elif inner == "unmarked":
                            inner = "body"
                    elif name in FURNITURE or _marked(name, attributes) or (name == "header" and kind not in INSIDE):
                        inner = "furniture"
                    if not attributes.endswith("/"):
                        stack.append((name, inner))
                        kind = inner
                        if not strict and _marked(name, attributes, whole=True):
                            strict = len(stack)
                else:
                    depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
                    if depth >= 0:
                        del stack[depth:]
                        strict = strict if strict <= depth else 0
                        kind = stack[-1][1] if stack else "unmarked"
        found = MARKUP.search(html, at)
    parts.append((html[at:], kind))
    flush()
    kinds = {k for _, k in out}
    # An article inside a marked element: the body of a page without another; where a whole name marks it, of one without any other text.
    body = {"body"} if "body" in kinds else {"within"} if "within" in kinds else set() if "unmarked" in kinds else {"deep"}
    return [(t, "body" if k in body else "furniture" if k in INSIDE else k) for t, k in out]


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    n, m, low = len(a), len(b), 0
    while low < n and low < m and a[low] == b[low]:
        low += 1
    high = 0
    while high < n - low and high < m - low and a[n - 1 - high] == b[m - 1 - high]:
        high += 1
    kept = {*range(low), *range(n - high, n)}
    both = set(a[low : n - high]) & set(b[low : m - high])
    at = [i for i in range(low, n - high) if a[i] in both]
    right = [x for x in b[low : m - high] if x in both]
    return kept | {at[i] for i in _align([a[i] for i in at], right)}


def _rows(a: list[str], b: list[str]) -> list[int]:
    """Bit rows of the alignment: zeros among the low j bits of row i count the LCS of a[:i] and b[:j]."""
    where: dict[str, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        u = row & where.get(x, 0)
        row = (row + u | row - u) & full
        rows.append(row)
    return rows


def _align(a: list[str], b: list[str], most: int = 1 << 27) -> list[int]:
    """Positions in ``a`` of an LCS; halves ``a`` where the bit rows would take too much memory."""
    if not a or not b:
        return []

    def count(row: int, j: int) -> int:
        return j - (row & ((1 << j) - 1)).bit_count()

    if len(a) * len(b) <= most or len(a) == 1:
        rows, out, i, j = _rows(a, b), [], len(a), len(b)
        while i and j:
            if a[i - 1] == b[j - 1]:
                out.append(i - 1)
                i, j = i - 1, j - 1
            elif count(rows[i - 1], j) == count(rows[i], j):
                i -= 1
            else:
                j -= 1
        return out[::-1]
    half = len(a) // 2

    def scores(x: list[str], y: list[str]) -> list[int]:
        row, out = 0, [0]
        for row in _last(x, y):
            pass
        for j in range(len(y)):
            out.append(out[-1] + (1 - (row >> j & 1)))
        return out

    left, right = scores(a[:half], b), scores(a[half:][::-1], b[::-1])[::-1]
    cut = max(range(len(b) + 1), key=lambda j: left[j] + right[j])
    return [*_align(a[:half], b[:cut], most), *(half + i for i in _align(a[half:], b[cut:], most))]


def _last(a: list[str], b: list[str]) -> Iterator[int]:
    """The bit rows one after another, without keeping them."""
    where: dict[str, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    yield row
    for x in a:
        u = row & where.get(x, 0)
        row = (row + u | row - u) & full
        yield row


def main_text(page: list[Line], other: list[Line] | None) -> tuple[str, int]:
    """The main text of a page, given its nearest page; and how many shared lines the difference deleted."""
    shared = common_lines([t for t, _ in page], [t for t, _ in other]) if other else set()
    left = [(t, kind) for i, (t, kind) in enumerate(page) if kind == "body" or i not in shared]
    wanted = "body" if any(kind == "body" for _, kind in left) else "unmarked"
    return "\n\n".join(t for t, kind in left if kind == wanted), len(page) - len(left)


@dataclass
class _Group:
    """Neighbouring pages of equal lines on one host: their rows and paths, and the lines once."""

    host: str
    lines: list[Line]
    rows: list[tuple[tuple, str]]


def _alike(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _groups(pages: Iterator[tuple[tuple, str, str, list[Line]]]) -> Iterator[_Group]:
    held: _Group | None = None
    for row, host, path, page in pages:
        if held is not None and held.host == host and held.lines == page:
            held.rows.append((row, path))
            continue
        if held is not None:
            yield held
        held = _Group(host, page, [(row, path)])
    if held is not None:
        yield held


def _extract(pages: Iterator[tuple[tuple, str, str, list[Line]]]) -> Iterator[tuple]:
    """Texts of pages in order of host and path; three groups of copies are held at a time."""

    def texts(before: _Group | None, group: _Group, after: _Group | None) -> Iterator[tuple]:
        if before is not None and not before.host == group.host != "":
            before = None
        if after is not None and not after.host == group.host != "":
            after = None
        made: dict[bool, tuple[str, int]] = {}
        for row, path in group.rows:
            # Of two equally near the one before counts.
            later = after is not None and (before is None or _alike(after.rows[0][1], path) > _alike(before.rows[-1][1], path))
            if later not in made:
                near = after if later else before
                made[later] = main_text(group.lines, near and near.lines)
            yield (*row, *made[later])

    before = group = None
    for after in _groups(pages):
        if group is not None:
            yield from texts(before, group, after)
        before, group = group, after
    if group is not None:
        yield from texts(before, group, None)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row: key, url, text, n_chars, n_shared.

    text: the main text, blocks joined by an empty line; empty if there is
    none (NULL or empty html).  n_chars: its code points.  n_shared: the
    lines deleted because the nearest page has them too.  A page with an
    empty host (NULL or malformed URL), or without a neighbour of its host
    and of other lines in its task's run, has no nearest page; of two
    equally near the one before counts.  Copies of a page have the same
    text.  Very long pages are read whole; an empty table gives an empty
    result; other columns are not read.
    """
    reachable(pages.sparkSession)
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias("k"), F.col(f"`{url}`").alias("u"), F.col(f"`{html}`").alias("h"), host.alias("host"), path.alias("path"))
    kind = rows.schema["k"].dataType
    # The hash of the page breaks up a URL that has very many rows.
    order = ["host", "path", "u", "k", F.xxhash64("h")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple[tuple, str, str, list[Line]]]:
            for batch in batches:
                for i in range(batch.num_rows):
                    k, u, h, on, at = (batch.column(c)[i].as_py() for c in range(5))
                    yield (k, u), on, at, lines(h)

        def send(part: list[tuple]) -> pa.RecordBatch:
            k, u, text, n = zip(*part)
            return pa.RecordBatch.from_arrays(
                [pa.array(k, types[0]), pa.array(u, pa.string()), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array(n, pa.int64())],
                ["k", "u", "text", "n_chars", "n_shared"],
            )

        part, size = [], 0
        for row in _extract(read()):
            part.append(row)
            size += len(row[2])
            if len(part) >= 2000 or size > 1 << 23:
                yield send(part)
                part, size = [], 0
        if part:
            yield send(part)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(kind)]
    made = dealt.mapInArrow(run, f"k {kind.simpleString()}, u string, text string, n_chars long, n_shared long")
    return made.withColumnsRenamed({"k": key, "u": url})
