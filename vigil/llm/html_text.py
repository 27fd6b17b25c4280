"""Main text of web pages, with nearest-URL page differencing.

Pages are cut into shards at sampled keys and sorted by (host, path, page_id): a
host that holds a third of all pages is split like any other, and the pages next
to each other are the nearest URLs of a host. Each page's text
lines (blocks) are aligned with those of its nearer neighbour by longest common
subsequence, and shared lines are deleted as the site's template. The first and
last pages of each shard meet their neighbours across the border, a group per
border, so results do not depend on the shards. Lines are shuffled once, no table
is written.

Every page is differenced. Two guards, since differencing alone deletes text that
belongs to the article: lines inside an ``article`` or ``main`` element are marked as
content by the page itself, so they go only if all near pages of the host (up to
``REACH`` on either side, two at least) share them, and they are at most half of the
page's text; and where more than half of another page's text is shared, the pages
may be copies: then only those lines are deleted that the other near page with least
in common shares, too. Elements that by their tag, role or class
are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
or comments are left out before.

Defined results: null or empty html gives the empty text; null urls sort first
with an empty host. Repeated rows each get a result. Text outside any tag is a
line of the page. A page that shares more than half with the only other page of
its host that has lines in common, and a page that would lose all its lines, is
taken for a copy and keeps them; among more than ``REACH`` near copies side by
side the lines they share are deleted. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.url_filter import host_of, path_of

REACH = 2  # pages on either side that a page is compared with

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
LEFT_OUT = {"nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog", "head"} | RAW
NAMES = {"ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "sidebar", "menu", "nav", "navbar", "navigation",
         "breadcrumb", "breadcrumbs", "header", "footer", "cookie", "cookies", "consent", "notice", "popup", "modal", "newsletter",
         "subscribe", "share", "social", "related", "comment", "comments", "complementary", "contentinfo", "search"}
BLOCKS = {"address", "article", "blockquote", "body", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset", "figcaption",
          "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "legend", "li", "main", "ol", "p", "pre", "section",
          "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"} | LEFT_OUT
#: a new one ends an open one of these
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SPACE = re.compile(r"\s+")


def lines_of(html: str | None) -> tuple[list[str], bool]:
    """The text lines of a page in order, and whether they come from an article or main element."""
    found: list[tuple[str, bool]] = []
    open_: list[tuple[str, bool, bool]] = []  # tag, left out from here, in an article from here
    text: list[str] = []
    html = html or ""
    end, raw = 0, None

    def flush() -> None:
        line = SPACE.sub(" ", unescape("".join(text))).strip()
        text.clear()
        if line:
            found.append((line, bool(open_) and open_[-1][2]))

    for m in TOKEN.finditer(html):
        closing, tag = m[1], (m[2] or "").lower()
        if raw:  # the content of a raw element is no markup
            if closing and tag == raw:
                raw, end = None, m.end()
            else:
                continue
        out, inside = open_[-1][1:] if open_ else (False, False)
        if not out:
            text.append(html[end: m.start()])
        end = m.end()
        if not tag:
            continue
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            text.append(" ")
        if closing:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == tag:
                    del open_[k:]
                    break
        elif tag not in VOID and not m[3].endswith("/"):
            while tag in CLOSES and open_ and open_[-1][0] in CLOSES[tag]:
                open_.pop()
            out, inside = open_[-1][1:] if open_ else (False, False)
            names = {w for a in NAMED.findall(m[3]) for w in re.split(r"[\s_-]+", "".join(a).lower())} if m[3] else ()
            out = out or tag in LEFT_OUT or (tag in BLOCKS or tag == "span") and not NAMES.isdisjoint(names)
            if tag in BLOCKS or tag in LEFT_OUT or out:
                open_.append((tag, out, inside or tag in ("article", "main")))
            if tag in RAW:
                raw = tag
    if not raw and not (open_ and open_[-1][1]):
        text.append(html[end:])
    flush()
    marked = any(inside for _, inside in found)
    return [line for line, inside in found if inside or not marked], marked


def shared(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``; of a line that repeats, the k-th
    occurrences are aligned with each other, so the work is n log n."""
    seen: Counter = Counter()
    where = {}
    for j, line in enumerate(b):
        where[line, seen[line]] = j
        seen[line] += 1
    seen.clear()
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    ends: list[int] = []
    for i, line in enumerate(a):
        j = where.get((line, seen[line]))
        seen[line] += 1
        if j is None:
            continue
        k = bisect_left(tails, j)
        tails[k: k + 1] = [j]
        back.append(ends[k - 1] if k else -1)
        ends[k: k + 1] = [len(at)]
        at.append(i)
    out = []
    k = ends[-1] if ends else -1
    while k >= 0:
        out.append(at[k])
        k = back[k]
    return out[::-1]


def difference(lines: list[str], other: list[str], more: Iterable[list[str]] = ()) -> list[str]:
    """``lines`` without those shared with ``other``; if these are more than half, without those of them
    that the page of ``more`` with least in common shares, too."""
    length = lambda places: sum(len(lines[i]) for i in places)
    gone = set(shared(lines, other))
    if 2 * length(gone) > length(range(len(lines))):
        common = [x for x in (gone & set(shared(lines, m)) for m in more) if x]
        gone = min(common, key=length, default=set())
        if len(gone) == len(lines):
            return lines
    return [line for i, line in enumerate(lines) if i not in gone]


def marked_difference(lines: list[str], others: list[list[str]]) -> list[str]:
    """``lines``, which their page marks as content, without those shared with all of the ``others`` (two at least);
    all of them, if those are more than half of the text."""
    gone = set(shared(lines, others[0])) if len(others) > 1 else set()
    for other in others[1:]:
        if gone:
            gone &= set(shared(lines, other))
    length = lambda places: sum(len(lines[i]) for i in places)
    if 2 * length(gone) > length(range(len(lines))):
        return lines
    return [line for i, line in enumerate(lines) if i not in gone]


def _near(a: str, b: str) -> int:
    """Length of the common prefix of two paths."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _text(row: dict, near: list[dict | None]) -> str:
    """The text of a page, ``near`` being the pages before and after it, the nearest first."""
    near = [x for x in near if x and x["host"] == row["host"]]
    if not near:
        return "\n".join(row["lines"])
    first = max(near[:2], key=lambda x: _near(x["path"], row["path"]))
    if row["marked"]:
        return "\n".join(marked_difference(row["lines"], [first["lines"], *(x["lines"] for x in near if x is not first)]))
    return "\n".join(difference(row["lines"], first["lines"], (x["lines"] for x in near if x is not first)))


def _key(host: str, path: str, page_id: int | None, print_: int) -> tuple:
    return host, path, page_id is not None, page_id or 0, print_


def _splitters(sample: list[tuple], shards: int) -> list[tuple]:
    """Up to ``shards`` - 1 keys of the sorted sample, with at least 2 * REACH sampled rows in every shard, so that
    the neighbours of a page at a border are in the next shard."""
    out: list[tuple] = []
    start = 0
    for k in range(1, shards if sample else 1):
        key = sample[len(sample) * k // shards]
        at = bisect_left(sample, key)
        if at - start >= 2 * REACH and len(sample) - at >= 2 * REACH:
            out.append(key)
            start = at
    return out


def _placed_lines(splitters: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                lines, marked = zip(*map(lines_of, part["html"].to_pylist()))
                keys = zip(*(part[c].to_pylist() for c in ("host", "path", "page_id", "print")))
                shard = [bisect_right(splitters, _key(*k)) for k in keys]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in KEPT), part["print"], pa.array(shard, pa.int32()), pa.array(lines, pa.list_(pa.string())), pa.array(marked, pa.bool_())],
                                                 [*KEPT, "print", "shard", "lines", "marked"])

    return run


def _partition_batches(last_shard: int):
    """Pages with their text, and pages near the borders of a shard with their lines, once for each border
    (number ``border``, the one behind shard ``border``): ``place`` orders them there, ``own`` marks those
    whose text is still to be made (null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        near: deque = deque(maxlen=2 * REACH + 1)
        head: list[dict] = []
        tail: deque = deque(maxlen=2 * REACH)
        shard = None

        def take(row: dict | None) -> None:
            near.append(row)
            if len(near) == 2 * REACH + 1 and (here := near[REACH]):
                around = [near[REACH + k * side] for k in range(1, REACH + 1) for side in (-1, 1)]
                rows.append({"page_id": here["page_id"], "url": here["url"], "text": _text(here, around)})

        def finish() -> None:
            if shard == last_shard:
                for _ in range(REACH):
                    take(None)
            else:
                rows.extend(row | {"border": shard, "place": j - len(tail), "own": j >= len(tail) - REACH} for j, row in enumerate(tail))
            if shard:
                rows.extend(row | {"border": shard - 1, "place": j, "own": j < REACH} for j, row in enumerate(head))

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist(rows, schema=PLACED)
            rows.clear()
            return out

        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                for row in batch.slice(lo, 64).to_pylist():
                    if row["shard"] != shard:
                        if shard is not None:
                            finish()
                        shard = row["shard"]
                        near.clear()
                        tail.clear()
                        head.clear()
                        near.extend([None] * (REACH if shard == 0 else 0))
                    if len(head) < 2 * REACH:
                        head.append(row)
                    tail.append(row)
                    take(row)
                    if len(rows) >= 256:
                        yield batch_of()
        if shard is not None:
            finish()
        if rows:
            yield batch_of()

    return run


def _border_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [{"page_id": r["page_id"], "url": r["url"], "text": _text(r, [r[c] for c in NEAR])} for r in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([PLACED.field(c) for c in ("page_id", "url", "text")]))


KEPT = ["page_id", "url", "host", "path"]
NEAR = [f"{side}{k}" for k in range(1, REACH + 1) for side in ("before", "after")]
PLACED = pa.schema([("page_id", pa.int64()), *((c, pa.string()) for c in ("url", "host", "path")), ("lines", pa.list_(pa.string())),
                    ("marked", pa.bool_()), ("text", pa.string()), ("border", pa.int32()), ("place", pa.int32()), ("own", pa.bool_())])
PAGE = "page_id long, url string, host string, path string"
SAMPLE = 32  # sampled keys per shard


def extract(pages: DataFrame, shards: int | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Shards are cut at fixed keys, so that however often a task runs, and in whichever branch of the plan, it
    has the same pages."""
    spark = pages.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"),
                        path_of(F.col("url")).alias("path"), F.xxhash64("url", "html").alias("print"), "html")
    rate = min(1.0, SAMPLE * shards / max(pages.count(), 1))
    few = rows.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    splitters = _splitters(sorted(_key(*r) for r in few.select("host", "path", "page_id", "print").collect()), shards)
    lined = rows.mapInArrow(_placed_lines(splitters), f"{PAGE}, print long, shard int, lines array<string>, marked boolean")
    placed = (lined.repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "host", "path", "page_id", "print")
              .mapInArrow(_partition_batches(len(splitters)), f"{PAGE}, lines array<string>, marked boolean, text string, border int, place int, own boolean"))
    order = Window.partitionBy("border").orderBy("place")  # 4 * REACH pages
    page = F.struct("host", "path", "lines")
    near = [f(page, k).over(order).alias(f"{side}{k}") for k in range(1, REACH + 1) for side, f in (("before", F.lag), ("after", F.lead))]
    borders = placed.where("border is not null").select(*KEPT, "lines", "marked", "own", *near).where("own").drop("own")
    texts = placed.where("border is null").select("page_id", "url", "text").union(borders.mapInArrow(_border_batches, "page_id long, url string, text string"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
