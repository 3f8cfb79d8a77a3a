"""Main text of web pages by differencing against the nearest page of the same host.

Pages are laid out by host and URL path; each is paired with the neighbour whose path shares the longer prefix, their text lines are aligned by
longest common subsequence, and lines that both have are deleted as the site's furniture. Inside an article or main element a shared line may be a
quotation, so it goes only if most of the host's pages share it with their neighbours. Lines inside menus, footers, forms and the like go even if
no other page has them.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import store
from millrace.session import pin

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.DOTALL)
LABEL = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+|[0-9]+")
#: Elements whose text is no page text, element kinds that are furniture, names that mark furniture, elements without an end tag, block elements.
RAW = frozenset(("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "object", "annotation", "annotation-xml"))
FURNITURE = frozenset(("nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "label", "fieldset"))
NAMES = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent", "contentinfo", "cookie", "cookies",
    "disclaimer", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promoted", "related",
    "replies", "respond", "search", "share", "sharing", "sidebar", "sidebars", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets", "disqus",
))
PLAIN = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))  # a name must be furniture as a whole here: "related-work" names a section of text
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCK = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
))
#: Inside an article a line is furniture if more than half of the host's different pages share it, and no fewer than this.
FEWEST = 4
MAIN, OPEN, OUT = 2, 1, 0  # inside the article; outside it; inside furniture


@dataclass
class Page:
    page_id: int | None
    url: str | None
    host: str
    path: str
    lines: list[str] = field(default_factory=list)
    zones: list[int] = field(default_factory=list)


def _marked(name: str, attributes: str) -> bool:
    if name in FURNITURE:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    split = str.split if name in PLAIN else WORD.findall
    return any(w in NAMES for m in LABEL.finditer(attributes) for w in split((m[1] or m[2] or m[3] or "").lower()))


def blocks(source: str) -> tuple[list[str], list[int]]:
    """Text blocks in page order, white space folded and references decoded, and the zone of each."""
    lines: list[str] = []
    zones: list[int] = []
    stack: list[tuple[str, int]] = []  # open elements and their zones
    parts: list[str] = []
    zone, at, end = OPEN, 0, len(source)

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                lines.append(text)
                zones.append(zone)

    while at < end:
        m = TOKEN.search(source, at)
        if m is None:
            parts.append(source[at:])
            break
        if m.start() > at:
            parts.append(source[at:m.start()])
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            continue
        if m[1]:
            if name in BLOCK or any(n == name and z != zone for n, z in stack[-1:]):
                close()
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), None)
            if depth is not None:
                if any(z != zone for _, z in stack[depth - 1:depth]) or (depth == 0 and zone != OPEN):
                    close()
                del stack[depth:]
                zone = stack[-1][1] if stack else OPEN
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            close()
            while stack and (stack[-1][0] == "p" or name == "li" and stack[-1][0] == "li"):  # an open paragraph ends where a block begins
                stack.pop()
                zone = stack[-1][1] if stack else OPEN
        if name in RAW:
            closed = m[3].endswith("/")
            stop = None if closed and name in ("svg", "object") else re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(source, at)
            at = stop.end() if stop else at if closed else end
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        inner = OUT if zone == OUT or _marked(name, m[3]) or (name == "header" and zone != MAIN) else MAIN if name in ("article", "main") else zone
        if inner != zone:
            close()
        stack.append((name, inner))
        zone = inner
    close()
    return lines, zones


def shared(mine: list[str], other: list[str]) -> list[bool]:
    """Which of my lines belong to a longest common subsequence with the other page; rows of the table are bit vectors."""
    flags = [False] * len(mine)
    masks: dict[str, int] = {}
    for j, line in enumerate(other):
        masks[line] = masks.get(line, 0) | 1 << j
    full = (1 << len(other)) - 1
    rows, v = [], full
    for line in mine:
        u = v & masks.get(line, 0)
        v = (v + u | v - u) & full
        rows.append(v)
    i, j = len(mine), len(other)
    while i and j:
        if rows[i - 1] >> j - 1 & 1:
            j -= 1
            continue
        i -= 1
        if i and not rows[i - 1] >> j - 1 & 1:
            continue
        flags[i] = True
        j -= 1
    return flags


def main_text(page: Page, common: list[bool], furniture: frozenset[int] = frozenset()) -> str:
    """``common`` says which lines the neighbour has too, ``furniture`` which lines go inside an article; an article of nothing else stays."""
    if MAIN in page.zones:
        inside = [t for t, z in zip(page.lines, page.zones, strict=True) if z == MAIN]
        return "\n".join(furniture and [t for t in inside if number(t) not in furniture] or inside)
    return "\n".join(t for t, z, c in zip(page.lines, page.zones, common, strict=True) if z == OPEN and not c)


def number(line: str) -> int:
    return int.from_bytes(hashlib.sha256(line.encode()).digest()[:8], "little", signed=True)


def _prefix(a: str, b: str) -> int:
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def nearest(page: Page, before: Page | None, after: Page | None) -> Page | None:
    """Of the pages around its run of copies, the one of the same host and the longest common path prefix; the earlier one if equal."""
    fit = [p for p in (before, after) if p and p.host == page.host]
    return max(fit, key=lambda p: _prefix(p.path, page.path)) if fit else None


BODY = "page_id bigint, url string, host string, path string, code binary, body binary"
EDGE = "struct<host: string, path: string, code: binary, body: binary>"
EDGE_ARROW = pa.struct([("host", pa.string()), ("path", pa.string()), ("code", pa.binary()), ("body", pa.binary())])
KEEP = ("host", "path", "code", "body")


def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page the digest of its lines, equal for copies, and the packed lines and zones."""
    for batch in batches:
        code, body = [], []
        for source in batch.column("html").to_pylist():
            lines, zones = blocks(source or "")
            text = "\n".join(lines).encode()  # no line holds a line break
            code.append(hashlib.sha256(text).digest()[:16])
            body.append(zlib.compress(bytes(zones) + b"\n" + text))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host", "path")), pa.array(code, pa.binary()), pa.array(body, pa.binary())], ["page_id", "url", "host", "path", "code", "body"])


def unpack(body: bytes) -> tuple[list[str], list[int]]:
    raw = zlib.decompress(body)
    zones, text = raw.split(b"\n", 1)  # a zone is a byte below 10
    return text.decode().split("\n") if zones else [], list(zones)


@dataclass
class Side:
    """Outermost page of a stretch of pages in order, and the first page from there, on the same host, with other lines."""

    near: dict | None = None
    far: dict | None = None

    def fit(self, page: dict) -> dict | None:
        return next((p for p in (self.near, self.far) if p and p["host"] == page["host"] and p["code"] != page["code"]), None)

    def add(self, page: dict) -> None:
        self.far, self.near = self.fit(page), page


def edge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last page of a partition, and next to each the nearest of the same host with other lines."""
    first, last = Side(), Side()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in KEEP]
        for row in zip(*columns, strict=True):
            page = dict(zip(KEEP, row, strict=True))
            if first.near is None:
                first.near = page
            elif first.far is None and page["host"] == first.near["host"] and page["code"] != first.near["code"]:
                first.far = page
            last.add(page)
    if first.near is not None:
        number = TaskContext.get().partitionId()
        sides = [first.near, first.far, last.near, last.far]
        yield pa.RecordBatch.from_pylist([{"part": number, "sides": sides}], pa.schema([("part", pa.int32()), ("sides", pa.list_(EDGE_ARROW))]))


def carry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each partition the pages before and after it that its first and last pages are compared with; four pages a partition come in."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"])
    out = {r["part"]: [None, None] for r in rows}
    for at, order in ((0, rows), (1, rows[::-1])):
        side = Side()
        for r in order:
            inner, _, outer, outer_far = r["sides"] if at == 0 else r["sides"][2:] + r["sides"][:2]
            out[r["part"]][at] = side.fit(inner)
            # a partition of one host and one text leaves what lay before it in reach
            side = Side(outer, outer_far or side.fit(outer))
    for part, (before, after) in out.items():
        yield pa.RecordBatch.from_pylist([{"part": part, "before": before, "after": after}], pa.schema([("part", pa.int32()), ("before", EDGE_ARROW), ("after", EDGE_ARROW)]))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[Page], list[list[bool]], list[int] | None]]:
    """Pages in order of host and path, copies in a row together, which lines each shares with its neighbour, and the host's furniture.

    A run is done when the page after it is known; of its pages only names and zones are held.
    """
    before: Page | None = None  # the last page before the run
    run: list[Page] = []  # their lines are one list
    code, end, started, furniture = None, None, False, None

    def edge(row: dict | None) -> Page | None:
        return Page(None, None, row["host"], row["path"], *unpack(row["body"])) if row else None

    def compared(after: Page | None) -> list[list[bool]]:
        known: dict[int, list[bool]] = {}
        out = []
        for page in run:
            other = nearest(page, before, after)
            if id(other) not in known:
                known[id(other)] = shared(page.lines, other.lines) if other else [False] * len(page.lines)
            out.append(known[id(other)])
        return out

    for batch in batches:
        names = ("page_id", "url", "host", "path", "code", "body", "before", "after")
        lists = batch.column("furniture").to_pylist() if "furniture" in batch.schema.names else [None] * batch.num_rows
        for page_id, url, host, path, own, body, first, last, gone in zip(*(batch.column(c).to_pylist() for c in names), lists, strict=True):
            if not started:
                before, end, started = edge(first), edge(last), True
            page = Page(page_id, url, host, path, *unpack(body))
            if run and run[0].host == host and code == own:
                page.lines = run[0].lines
            elif run:
                yield run, compared(page), furniture
                before, run = run[-1], []
            run.append(page)
            code, furniture = own, gone
    if run:
        yield run, compared(end), furniture


def suspect_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines inside articles that a page shares with its neighbour, and a null line for the page itself; a run of copies counts once."""
    host, line = [], []
    for run, common, _ in runs(batches):
        page = run[0]
        found = [None, *{number(t) for t, z, c in zip(page.lines, page.zones, common[0], strict=True) if z == MAIN and c}]
        host += [page.host] * len(found)
        line += found
        if len(host) >= 10000:
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(line, pa.int64())], ["host", "line"])
            host, line = [], []
    if host:
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(line, pa.int64())], ["host", "line"])


def extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []

    def table() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.string()), pa.array([r[3] for r in out], pa.int64())], ["page_id", "url", "text", "n_chars"])
        out.clear()
        return made

    for run, common, furniture in runs(batches):
        gone = frozenset(furniture or ())
        for page, flags in zip(run, common, strict=True):
            text = main_text(page, flags, gone)
            out.append((page.page_id, page.url, text, len(text)))
        if len(out) >= 1000:
            yield table()
    if out:
        yield table()


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    Null and empty html give the empty text. Pages without a usable URL stand together as one nameless host. Copies in a row are compared with the
    page before the first and the page after the last of them, so a page is compared with none only if its host has no page with other lines.
    Repeated rows are extracted each. Other columns are ignored. Pages are range-partitioned by (host, path), so a host of any size is spread over
    tasks; the pages that a partition needs from beyond its edges are handed to it, so the texts do not depend on the partitions.
    """
    own = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    rest = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    own = own.withColumn("host", F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))
    parsed = own.mapInArrow(parse_batches, BODY)
    laid = pin(parsed.repartitionByRange("host", "path", "page_id").sortWithinPartitions("host", "path", "page_id", "url", "code", "body"))
    sides = laid.select(*KEEP).mapInArrow(edge_batches, f"part int, sides array<{EDGE}>")
    carry = sides.repartition(1).mapInArrow(carry_batches, f"part int, before {EDGE}, after {EDGE}")  # one row a partition
    place = F.monotonically_increasing_id()  # partition number << 33, plus the row's number in it
    numbered = laid.withColumn("place", place).withColumn("part", F.expr("if(place & 8589934591 = 0, cast(place >> 33 as int), null)"))
    met = numbered.join(F.broadcast(carry), "part", "left")
    met = met.select("page_id", "url", "host", "path", "code", "body", "before", "after")
    counts = met.mapInArrow(suspect_batches, "host string, line bigint").groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    counts = store(counts.where(f"line is null or n >= {FEWEST}"), "page-lines")
    most = counts.where("line is not null").join(counts.where("line is null").select("host", F.col("n").alias("pages")), "host").where("2 * n > pages")
    furniture = most.groupBy("host").agg(F.collect_list("line").alias("furniture"))  # fewer lines a host than twice those of a page
    return met.join(F.broadcast(furniture), "host", "left").mapInArrow(extract_batches, "page_id bigint, url string, text string, n_chars bigint")
