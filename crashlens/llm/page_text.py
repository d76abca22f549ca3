"""Main text of web pages: page structure plus nearest-URL differencing.

A page is cut into text lines (blocks) with the zone they stand in. Pages of a
host are sorted by URL path, so each meets its nearest page; their lines are
aligned by longest common subsequence and shared lines, the site's frame, are
deleted, also inside a declared article. Copies of one article under two URLs
are common, so the nearest page is the nearest one that is no copy.
"""

from __future__ import annotations

import marshal
import pickle
import re
import tempfile
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import per_text
from crashlens.session import stage_partitions

TAG = re.compile(r"<!--.*?(?:-->|\Z)"
                 r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)"
                 r"(?P<attrs>(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)/?>"
                 r"|<[!?/][^>]*>", re.S)
ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
SPACE = re.compile(r"\s+")
#: Elements whose content is no text.
RAW = frozenset("script style noscript template textarea title svg math iframe object select option "
                "button head canvas audio video".split())
#: Elements that hold the page's frame, and class, id or role words that say so.
FRAME = frozenset("nav header footer aside form menu dialog".split())
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent notice "
    "notices alert popup modal overlay newsletter subscribe signup share sharing social related comment "
    "comments disqus reply replies respond complementary contentinfo search pagination pager toolbar "
    "widget widgets login".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p "
                   "pre section summary table tbody tfoot thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Zones of a line; a heading within an article is marked, to go or stay with its section.
BODY, MAIN, ARTICLE, HEADING = 0, 1, 2, 3
#: Why an element is left out: for good, or for a class, id or role that says no
#: more than where it stands, as wrappers round whole pages have them, too.
NEVER, NAMED = 1, 2
WRAPPER_WORDS = frozenset("header masthead sidebar complementary popup modal overlay search toolbar widget widgets "
                          "login".split())
#: A NAMED element is opened after all if it holds this many
#: times the running text of the rest of the page.
WRAPS = 20


def _frame(name: str, attrs: str) -> int:
    """Why an element is part of the frame; 0 if it is none."""
    if name in FRAME:
        return NEVER
    found = 0
    if not attrs or name in ("html", "body", "main"):
        return found
    for key, *values in ATTR.findall(attrs):
        value = next((v for v in values if v), "").lower()
        if key.lower() == "hidden" or key.lower() == "aria-hidden" and value == "true":
            return NEVER
        # a name such as has-sidebar or entry-header says something else than its words
        if key.lower() in ("class", "id", "role") and name != "article":
            words = [re.findall(r"[a-z0-9]+", n) or [n] for n in value.split()]
            words = [w for w in words if FRAME_WORDS.issuperset(w)]
            if not all(WRAPPER_WORDS.issuperset(w) for w in words):
                return NEVER
            found = NAMED if words else found
    return found


def page_lines(html: str) -> list[tuple[int, str]]:
    """(zone, line) of every text block outside frames, scripts and markup."""
    return [(min(z, ARTICLE), line) for z, line in marked_lines(html)]


def marked_lines(html: str) -> list[tuple[int, str]]:
    """As :func:`page_lines`, with headings of articles marked as HEADING.

    Open elements are tracked by name only, so unclosed inline or paragraph
    tags do no harm. Within an article a header keeps its headings. An element
    that is left out as :data:`NAMED` and holds nearly all running text (that
    outside links and other frames) is a wrapper: the page is read again with it
    open, until no such element is left.
    """
    opened: set[int] = set()
    while True:
        lines, running, left_out = _page_lines(html, opened)
        at = max(left_out, key=lambda p: (left_out[p], -p), default=None)
        if at is None or left_out[at] <= WRAPS * (running + sum(left_out.values()) - left_out[at]):
            return lines
        opened.add(at)


def _page_lines(html: str, opened: set[int]) -> tuple[list[tuple[int, str]], int, dict[int, int]]:
    """Lines; characters of running text that is kept; and by place of an element
    left out for its class those within it. ``opened``: places not left out."""
    lines: list[tuple[int, str]] = []
    left_out: dict[int, int] = {}
    running, links, inner, place = 0, 0, [], -1
    held: list[str] = []
    depth = {"article": 0, "main": 0}
    skip, skip_depth, head_only, heading = "", 0, False, False

    def flush() -> None:
        text = SPACE.sub(" ", unescape("".join(held))).strip()
        held.clear()
        if text:
            lines.append(((HEADING if titled else ARTICLE) if depth["article"] else MAIN if depth["main"] else BODY,
                          text))

    def text(a: int, b: int) -> None:
        nonlocal running
        if a >= b:
            return
        if not skip or head_only and heading:
            held.append(html[a:b])
            running += 0 if links else len(html[a:b].strip())
        elif place >= 0 and not links and not inner:
            left_out[place] = left_out.get(place, 0) + len(html[a:b].strip())

    at, endless, titled = 0, set(), False
    while True:
        m = TAG.search(html, at)
        if m is None:
            break
        text(at, m.start())
        at = m.end()
        if m["name"] is None:
            continue
        name, closes = m["name"].lower(), bool(m["close"])
        if name in RAW and not closes:
            if name not in endless:
                end = re.compile(f"</{name}\\b[^>]*>", re.I).search(html, at)
                if end is None:
                    endless.add(name)  # nor is there one for later elements
                at = end.end() if end else len(html) if name in ("script", "style") else at
            continue
        if name in BLOCKS:
            flush()
            titled = name in HEADINGS and not closes
        elif name in ("br", "td", "th"):
            held.append(" ")
        if name == "a":
            links = 0 if closes else 1
        if skip:
            if inner:
                if name == inner[0] and name not in VOID:
                    inner[1] += -1 if closes else 1
                    if not inner[1]:
                        inner = []
            elif place >= 0 and not closes and name not in VOID and _frame(name, m["attrs"] or "") == NEVER:
                inner = [name, 1]  # frames within the element are no running text of it
            if name == skip and name not in VOID:
                skip_depth += -1 if closes else 1
                if not skip_depth:
                    skip, head_only, place, inner = "", False, -1, []
            if name in HEADINGS:
                heading = not closes
            continue
        frame = 0 if closes or name in VOID or m.start() in opened else _frame(name, m["attrs"] or "")
        if frame:
            skip, skip_depth, heading = name, 1, False
            head_only = name == "header" and depth["article"] > 0
            place = m.start() if frame == NAMED else -1
        elif name in depth:
            depth[name] = max(0, depth[name] + (-1 if closes else 1))
    text(at, len(html))
    flush()
    return lines, running, left_out


def shared_lines(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` are in a longest common subsequence with ``b``.

    Bit-parallel rows (one integer a line of b) and a walk back through them.
    """
    place: dict[str, int] = {}
    for i, line in enumerate(a):
        place[line] = place.get(line, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, rows = full, [full]
    for line in b:
        u = row & place.get(line, 0)
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    shared = [False] * len(a)
    i, j = len(a) - 1, len(b)
    while i >= 0 and j > 0:
        if rows[j] >> i & 1:
            i -= 1
        elif not rows[j - 1] >> i & 1:
            j -= 1
        else:
            shared[i] = True
            i, j = i - 1, j - 1
    return shared


#: Share of both pages' characters in equal lines from which two pages are copies
#: of one text: of article lines, and of pages whose frame may be among the lines.
COPY = {ARTICLE: 0.67, MAIN: 0.9, BODY: 0.9}


def best_zone(lines: list[tuple[int, str]]) -> int:
    """The zone that holds the page's text: articles, else the main element, else the
    body; an outer zone with over LARGER times the text of the inner one wins, as
    the inner one is a teaser or a note beside the text then."""
    size = Counter()
    for z, text in lines:
        size[min(z, ARTICLE)] += len(text)
    best = max(size, default=BODY)
    for zone in (MAIN, BODY):
        if zone < best and size[zone] > LARGER[zone] * size[best]:
            best = zone
    return best


#: How many times the text of the inner zone an outer one must hold to be chosen.
LARGER = {MAIN: 2, BODY: 4}


def zone_lines(lines: list[tuple[int, str]], zone: int) -> list[tuple[int, str]]:
    return [x for x in lines if min(x[0], ARTICLE) == zone]


def are_copies(a: list[tuple[int, str]], b: list[tuple[int, str]]) -> bool:
    """Whether the lines of the best zone of both pages are mostly the same."""
    zone = best_zone(a)
    if zone != best_zone(b):
        return False
    x, y = (Counter(t for _, t in zone_lines(lines, zone)) for lines in (a, b))
    both = sum(len(t) * min(n, y[t]) for t, n in x.items())
    most = max(sum(len(t) * n for t, n in c.items()) for c in (x, y))
    return both >= COPY[zone] * most


def main_text(lines: list[tuple[int, str]], nearest: list[tuple[int, str]] | None) -> str:
    """The lines of the page's best zone without those shared with ``nearest``, a
    page that is no copy; a page without any own line keeps all. A heading within
    an article goes only with the line that follows it."""
    zone = best_zone(lines)
    own = zone_lines(lines, zone)
    texts = [x for _, x in own]
    shared = shared_lines(texts, [x for _, x in zone_lines(nearest, zone)]) if nearest else [False] * len(own)
    for i in range(len(own) - 2, -1, -1):
        if own[i][0] == HEADING:
            shared[i] = shared[i] and shared[i + 1]
    return "\n".join([x for x, s in zip(texts, shared, strict=True) if not s] or texts)


def _closeness(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class _Held:
    """Rows that wait for the next page that is no copy; many go to a temporary file."""

    def __init__(self, most: int = 1 << 25):
        self.most, self.size, self.rows, self.file = most, 0, [], None

    def add(self, row: tuple, size: int) -> None:
        self.rows.append(row)
        self.size += size
        if self.size > self.most:
            self.file = self.file or tempfile.TemporaryFile()
            for r in self.rows:
                pickle.dump(r, self.file)
            self.size, self.rows = 0, []

    def take(self) -> Iterator[tuple]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield pickle.load(self.file)
            self.file.close()
        yield from self.rows
        self.size, self.rows, self.file = 0, [], None


def _packed(html: str) -> tuple[bytes]:
    return (zlib.compress(marshal.dumps(marked_lines(html)), 1),)


def _unpacked(packed: bytes) -> list[tuple[int, str]]:
    return marshal.loads(zlib.decompress(packed))


NOTHING = (None, None)


def _paired(rows: Iterator[tuple], before: tuple = NOTHING, ahead: tuple = NOTHING) -> Iterator[tuple]:
    """Every row (page_id, url, host, path, packed lines) with the nearest page of
    its host that is no copy.

    Rows that follow each other and are copies form a run; the pages beside the
    run are its neighbours, the one with the closer path counts (the earlier one
    if equal). ``before``: the row before these and the last page of the run
    before that row's; ``ahead``: the row after these and the first page of the
    run after that row's.
    """
    held = _Held()
    last, prior = before
    last_lines = _unpacked(last[4]) if last else None

    def flush(after):
        for row in held.take():
            near = [x for x in (prior, after) if x is not None]
            yield row, max(near, key=lambda x: _closeness(x[3], row[3]), default=None)

    for row in rows:
        lines = _unpacked(row[4])
        if last is not None and last[2] != row[2]:
            yield from flush(None)
            prior = None
        elif last is not None and not are_copies(last_lines, lines):
            yield from flush(row)
            prior = last
        held.add(row, len(row[4]))
        last, last_lines = row, lines
    yield from flush(_beside(last, *ahead))


def _beside(row: tuple | None, other: tuple | None, beyond: tuple | None) -> tuple | None:
    """The page beside the run of ``row``, given the row next to it and the page
    beside that row's run."""
    if row is None or other is None or row[2] != other[2]:
        return None
    return beyond if are_copies(_unpacked(row[4]), _unpacked(other[4])) else other


def _edges(rows: Iterator[tuple]) -> list[tuple[str, tuple]]:
    """First and last row; unless all are one run, also the first page of the
    second run and the last page of the run before the last, marked by whether
    they are of the host of the first or last row."""
    first = second = prior = last = lines = None
    for row in rows:
        now = _unpacked(row[4])
        if last is None:
            first = row
        elif last[2] != row[2] or not are_copies(lines, now):
            second, prior = second or row, last
        last, lines = row, now
    if first is None:
        return []
    return [("first", first), ("last", last)] + ([("second", second), ("prior", prior)] if second else [])


def _contexts(edges: dict[int, dict[str, tuple]]) -> dict[int, tuple[tuple, tuple]]:
    """What stands before and after each partition, where a host goes on there."""
    before, ahead = {}, {}
    for beside, todo, (near, far, inner) in (
            (before, sorted(edges), ("first", "last", "prior")),
            (ahead, sorted(edges, reverse=True), ("last", "first", "second"))):
        state = NOTHING
        for part in todo:
            e = edges[part]
            beside[part] = state if state[0] and state[0][2] == e[near][2] else NOTHING
            if inner in e:
                state = e[far], e[inner] if e[inner][2] == e[far][2] else None
            else:
                state = e[far], _beside(e[near], *state)
    return {part: (before[part], ahead[part]) for part in edges}


def extract_pages(pages: DataFrame, ident: str = "page_id") -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (ident, url, html).

    Rows are cut into lines, range-partitioned by host and path, which splits
    hosts of any size, and written once; a few rows at the edges of each range
    go to its neighbours. Then they stream through each task: a page is compared
    with the nearest page of its host that is no copy of it, in whatever range. Null html gives an empty
    text; a null url is a host of its own; repeated rows give repeated results.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    rows = pages.select(F.col(ident).cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"),
                        per_text(lambda: _packed, "lines binary")(F.col("html"))["lines"].alias("lines"))
    ordered = stage_partitions(rows.repartitionByRange("host", "path", "page_id")
                               .sortWithinPartitions("host", "path", "page_id"))

    def rim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for place, row in _edges(_rows(batches)):
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, place)] + [
                pa.array([x], t) for x, t in zip(row, (pa.int64(), *[pa.string()] * 3, pa.binary()), strict=True)],
                ["part", "place", "page_id", "url", "host", "path", "lines"])

    # at most four rows a partition
    edges: dict[int, dict[str, tuple]] = {}
    for r in ordered.mapInArrow(rim, "part long, place string, page_id long, url string, host string, path string, "
                                     "lines binary").collect():
        edges.setdefault(r["part"], {})[r["place"]] = (*r[2:6], bytes(r["lines"]))
    contexts = {k: v for k, v in _contexts(edges).items() if v != (NOTHING, NOTHING)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        size = 0
        for row, best in _paired(_rows(batches), *contexts.get(TaskContext.get().partitionId(), (NOTHING, NOTHING))):
            text = main_text(_unpacked(row[4]), _unpacked(best[4]) if best else None)
            out.append((row[0], row[1], text))
            size += len(text)
            if size > 1 << 22:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    found = ordered.mapInArrow(work, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for r in zip(*(b.column(c) for c in ("page_id", "url", "host", "path", "lines")), strict=True):
            yield tuple(x.as_py() for x in r)


def _batch(rows: list) -> pa.RecordBatch:
    a, b, c = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.string()),
                                       pa.array(c, pa.string())], ["page_id", "url", "text"])
