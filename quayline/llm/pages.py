"""Main text of web pages by differencing pages with near URLs.

A page becomes text lines, one per block element. Pages of a host are ordered
by path, and each is paired with the nearest page before and the nearest one
after it that is no copy of it; a run of copies, however long, is passed over.
Copies are pages whose lines outside of named zones are the same. The longest
common subsequence with the partner whose path shares the longer prefix is what
the site puts on every page, and shared lines are deleted. If nothing is left so,
the other partner decides; a page that is part of both is kept as it is.

Lines in an ``article`` or ``main`` element stay whatever the partners have: one
article under several URLs and a passage that articles quote are no template.

Navigation, adverts, forms, comments and the like differ from page to page, so no
pair of pages shows them: lines in elements of that kind go in any case, and
so do those whose class, id or role is such a name as a whole, alone or with words
of place and shape (``site-header``, ``left-nav``, but not ``has-sidebar``).

Pages are dealt out by ranges of (host, path, id), of bounded bytes and as even
as rows are, so a host with a third of all pages is no hot spot. A range also
gets the nearest page on either side, and the nearest that is no copy of that one,
so that every page has the partners that it would have in one range.

Null html is empty and gives empty text, null URLs form a host ``''`` of their
own. Repeated rows are copies of one page. Very long pages are taken whole, one at
a time. Extra columns are ignored and may have any name. An empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import tasks_for
from quayline.llm.url_filter import host, path
from quayline.session import configure, staged

#: Elements without text of the page; plain fixed values.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "select", "textarea", "button", "head", "title"}
#: Elements that frame a page; plain fixed values.
FRAME = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
#: Elements inside a line of text; plain fixed values.
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Elements that have no end tag; plain fixed values.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words that name what is not the article; plain fixed values.
NAMED = {
    "ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertisements", "advertising", "banner", "banners", "breadcrumb", "breadcrumbs",
    "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "dialog", "disqus", "footer", "header", "login",
    "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "promos", "promotion",
    "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "sidenav", "signup", "social", "sponsor",
    "sponsored", "sponsors", "subscribe", "subscription", "toolbar", "topbar", "topnav", "widget", "widgets",
}
#: Words of place, shape and number that may stand beside such a name; plain fixed values.
BESIDE = {
    "area", "articles", "bar", "block", "bottom", "box", "bubble", "button", "buttons", "col", "column", "container", "fixed", "form", "global", "group", "icons", "in",
    "inline", "inner", "item", "items", "large", "left", "links", "list", "main", "media", "mobile", "module", "outer", "overlay", "page", "pane", "panel", "policy",
    "post", "posts", "primary", "right", "row", "secondary", "section", "side", "site", "slot", "small", "space", "sticky", "stories", "thread", "tools", "top",
    "unit", "user", "wrap", "wrapper",
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|title|iframe)\b[^>]*>.*?(?:</\1\s*>|$)|"
    r"<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[-_\d]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
# Bytes of html in a range; small tables are not cut into ranges of fewer pages than RANGE_PAGES.
RANGE_BYTES = 128 << 20
RANGE_PAGES = 500
ARTICLE, FRAMED, OPEN = "a", "f", "o"


def is_named(attributes: str) -> bool:
    """Whether a class, an id or the role names what is not the article."""
    for m in _ATTRIBUTE.finditer(attributes):
        for token in " ".join(filter(None, m.groups()[1:])).split():
            parts = {p.lower() for p in _PARTS.split(token) if p}
            if parts & NAMED and parts <= NAMED | BESIDE:
                return True
    return False


def lines_of(page: str) -> list[tuple[str, str]]:
    """The page's text lines in order, each with its zone."""
    stack: list[tuple[str, str]] = []
    zone, out, piece, at = OPEN, [], [], 0

    def flush():
        text = " ".join(html.unescape("".join(piece)).split())
        piece.clear()
        if text:
            out.append((text, zone))

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece.append(page[at : m.start()])
        at = m.end()
        name = m.group(3)
        if not name:
            continue
        name = name.lower()
        if m.group(2):
            if name not in INLINE:
                flush()
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                # An end tag also closes what was left open inside.
                if any(n not in INLINE for n, _ in stack[depth:]):
                    flush()
                zone = stack[depth][1]
                del stack[depth:]
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            zone = stack.pop()[1]
        before = zone
        if zone != FRAMED:
            given = m.group(4)
            if name in FRAME or name in SILENT:
                zone = FRAMED
            elif given and name not in ("html", "body", "main") and (is_named(given) or _HIDDEN.search(given)):
                zone = FRAMED
            elif name in ("article", "main"):
                zone = ARTICLE
        stack.append((name, before))
    if at < len(page):
        piece.append(page[at:])
    flush()
    return out


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` on a longest common subsequence with ``b``."""
    shared: set[int] = set()
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        shared.add(lo)
        lo += 1
    ha, hb = len(a), len(b)
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha, hb = ha - 1, hb - 1
        shared.add(ha)
    # Lines the other page lacks can't be part of it; the rest is aligned over matching places only.
    where: dict[str, list[int]] = {}
    for j in range(lo, hb):
        where.setdefault(b[j], []).append(j)
    tails: list[int] = []
    nodes: list[tuple[int, int]] = []
    back: list[int] = []
    ends: list[int] = []
    for i in range(lo, ha):
        for j in reversed(where.get(a[i], ())):
            k = bisect.bisect_left(tails, j)
            back.append(ends[k - 1] if k else -1)
            nodes.append((i, j))
            if k == len(tails):
                tails.append(j)
                ends.append(len(nodes) - 1)
            else:
                tails[k], ends[k] = j, len(nodes) - 1
    at = ends[-1] if ends else -1
    while at >= 0:
        shared.add(nodes[at][0])
        at = back[at]
    return shared


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def main_text(page: dict, partners: list[dict]) -> str:
    """The page's lines outside of named zones, without those that its partners show to be the site's."""
    lines = page["lines"]
    own = [t for t, _ in lines]
    near = sorted((p for p in partners if p["host"] == page["host"]), key=lambda p: -_prefix(p["path"], page["path"]))
    for partner in near:
        shared = common_lines(own, [t for t, _ in partner["lines"]])
        rest = [t for i, (t, zone) in enumerate(lines) if zone == ARTICLE or i not in shared]
        if rest:
            return " ".join(rest)
    return " ".join(own)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            row["lines"] = [x for x in lines_of(row.pop("html") or "") if x[1] != FRAMED]
            yield row


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range, host, path and id. Copies that follow each other are held as one page and their names."""

    def result(rows):
        kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
        return pa.RecordBatch.from_pylist(rows, kind)

    out, before, run = [], None, None

    def close(following):
        partners = [p for p in (before, following) if p is not None and p["range"] == run["range"] and p["host"] == run["host"]]
        texts: dict[bool, str] = {}
        for name, url, path_ in run["members"]:
            # All copies have the same lines, only which partner is nearer can differ.
            reach = [_prefix(p["path"], path_) for p in partners]
            first = len(reach) < 2 or reach[0] >= reach[1]
            if first not in texts:
                texts[first] = main_text({**run, "path": path_}, partners)
            out.append({"page_id": name, "url": url, "text": texts[first]})

    for page in _pages(batches):
        member = [] if page["ghost"] else [(page["page_id"], page["url"], page["path"])]
        if run is not None and all(run[c] == page[c] for c in ("range", "host", "lines")):
            run["members"] += member
            run["path"] = page["path"]
            continue
        if run is not None:
            close({**page, "members": []})
        before, run = run, {**page, "members": member}
        if len(out) >= 500:
            yield result(out)
            out.clear()
    if run is not None:
        close(None)
    yield result(out)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two copies have in common, instead of the html."""
    for batch in batches:
        sizes, found = [], []
        for text in batch.column("html"):
            page = text.as_py() or ""
            sizes.append(len(page.encode()))
            lines = [x for x in lines_of(page) if x[1] != FRAMED]
            found.append(xxhash.xxh3_128_digest("\0".join(zone + t for t, zone in lines).encode()))
        kept = [batch.column(c) for c in ("host", "path", "page_id", "html_key")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], ["host", "path", "page_id", "html_key", "size", "copy_key"])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition: its first and last page, and on each side the nearest page that is no copy of that one."""
    first = second = last = other = None
    for batch in batches:
        for row in batch.to_pylist():
            mark = (row["host"], row["copy_key"])
            if first is None:
                first, last = row, row
                continue
            if second is None and mark != (first["host"], first["copy_key"]):
                second = row
            if mark != (last["host"], last["copy_key"]):
                other = last
            last = row
    rows = [{**row, "side": side} for side, row in enumerate((first, second, other, last)) if row is not None]
    kind = pa.schema([(c, t) for c, t in (("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("html_key", pa.int64()), ("copy_key", pa.binary()), ("side", pa.int32()))])
    yield pa.RecordBatch.from_pylist(rows, kind)


def _place(row) -> tuple:
    """The order of pages: nulls come first."""
    number, key = row["page_id"], row["html_key"]
    return row["host"], row["path"], number is not None, number or 0, key


def _beside(edges: list) -> tuple[list[tuple], dict[tuple, list[int]]]:
    """First place of each range, and which other ranges a page at an edge also goes to."""
    ranges: list[dict[int, dict]] = []
    for row in sorted(edges, key=lambda r: (_place(r), r["side"])):
        # A range of one run of copies has sides 0 and 3 alone; every range begins with its side 0.
        if row["side"] == 0:
            ranges.append({})
        ranges[-1][row["side"]] = row
    to: dict[tuple, list[int]] = {}
    mark = lambda r: (r["host"], r["copy_key"])
    for step, near, next_ in ((-1, 3, 2), (1, 0, 1)):
        # From each range's edge on, the nearest page that is no copy of the one at the edge.
        beyond: list[dict | None] = [None] * len(ranges)
        for at in range(len(ranges))[::-step]:
            here, b = ranges[at], at + step
            beyond[at] = here.get(next_)
            if next_ not in here and 0 <= b < len(ranges):
                beyond[at] = beyond[b] if mark(ranges[b][near]) == mark(here[near]) else ranges[b][near]
            own = at - step
            if 0 <= own < len(ranges):
                for row in filter(None, (here[near], beyond[at])):
                    to.setdefault(_place(row), []).append(own)
    return [_place(r[0]) for r in ranges], to


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(page_id, url, text)`` for every row of ``pages``."""
    spark = configure(pages.sparkSession)
    u = F.col(url).cast("string")
    html_key = F.xxhash64(F.col(page).cast("string")).alias("html_key")
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), u.alias("url"), host(u).alias("host"), path(u).alias("path"), html_key, F.col(page).cast("string").alias("html")
    )
    order = ["host", "path", "page_id", "html_key"]
    kind = "host string, path string, page_id bigint, html_key bigint"
    keys = staged(spark, rows.select(*order, "html").mapInArrow(_keys, kind + ", size bigint, copy_key binary"), "pages")
    total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n = max(1, min(tasks_for(spark), total[0] // RANGE_PAGES), -(-total[1] // RANGE_BYTES))
    dealt = keys.drop("size").repartitionByRange(n, *order).sortWithinPartitions(*order)
    # Four keys per range come to the driver, and a range has tens of megabytes of pages.
    firsts, to = _beside(dealt.mapInArrow(_edges, kind + ", copy_key binary, side int").collect())

    @F.pandas_udf("array<int>")
    def ranges(h: pd.Series, p: pd.Series, i: pd.Series, k: pd.Series) -> pd.Series:
        found = []
        for a, b, c, d in zip(h, p, i, k):
            place = (a, b, c is not None, int(c or 0), int(d))
            # A range's own number comes first, then those it lies beside with this page.
            found.append([max(0, bisect.bisect_right(firsts, place) - 1), *to.get(place, ())])
        return pd.Series(found)

    if not firsts:
        return rows.select("page_id", "url", F.lit("").alias("text"))
    dealt = rows.select("*", F.posexplode(ranges("host", "path", F.col("page_id").cast("string"), "html_key")).alias("copy", "range"))
    dealt = dealt.withColumn("ghost", F.col("copy") > 0).drop("copy")
    dealt = dealt.repartitionById(len(firsts), F.col("range")).sortWithinPartitions("range", *order)
    return dealt.mapInArrow(_extract, "page_id bigint, url string, text string")
