"""HTML extraction by nearest-URL page differencing.

Within each host a page is paired with the page whose URL path is nearest. The text lines of the two are aligned by their
longest common subsequence; shared lines are the site's frame (menus, notices, footers) and are deleted. Markup decides first
where it is explicit: lines in scripts, menus, adverts, forms or reader comments never count as text; and lines in an
article or main element are the article's own, so that copies of an article on one host do not delete each other. All other lines,
on pages with an article element and without, are kept unless the partner shares them.

Spark's part: pages are ordered by (host, path) with a range partitioning, so a host with a third of all pages is spread over many
tasks; neighbours come from a window inside each range, plus one small join for the pages at the ranges' ends. A page travels
with the hashes of its partner's lines only.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from roadlake.llm.common import cut, small_or_not

FRAME, PLAIN, BODY = 0, 1, 2

_RAW = frozenset("script style title noscript template textarea iframe svg".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_FRAME_TAGS = frozenset("nav footer aside form button select menu dialog head".split())
_BODY_TAGS = frozenset(("article", "main"))
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_CONTAINERS = frozenset("address article aside blockquote body div dl fieldset figure footer form header main nav ol section table td ul".split())
_OWN_END = {"li": "li", "dt": "dt", "dd": "dd", "tr": "tr", "td": "td", "th": "th", "option": "option"}
_STRONG = frozenset(
    "ad ads advert advertisement advertisements adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices newsletter subscribe signup popup modal overlay "
    "share sharing social related recommended recommendations comment comments disqus replies respond responses breadcrumb breadcrumbs pagination pager sidebar menu nav navbar navigation toolbar "
    "widget widgets footer tagcloud login paywall".split()
)
_WEAK = frozenset("header masthead topbar".split())
_FRAME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAME = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


def _state(tag: str, attrs: str, above: int) -> int:
    """Of an element, from its tag, its attributes and what it stands in."""
    if above == FRAME or tag in _FRAME_TAGS:
        return FRAME
    body = above == BODY
    state = BODY if body or tag in _BODY_TAGS else PLAIN
    if tag == "header" and not body:
        return FRAME
    if attrs and tag not in ("html", "body"):
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                words = {x.lower() for x in _NAME.findall(value)}
                # Inside an article only whole containers are told by a name; paragraphs, headings and items are its text.
                if (words & _STRONG and (not body or tag in _CONTAINERS)) or (words & _WEAK and not body and tag not in _BODY_TAGS):
                    return FRAME
            elif name == "role":
                if value.lower() in _FRAME_ROLES:
                    return FRAME
                if value.lower() in ("main", "article"):
                    state = BODY
            elif name == "itemprop" and value == "articleBody":
                state = BODY
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                return FRAME
    return state


def page_lines(html: str) -> list[tuple[str, int]]:
    """Text lines in page order, each with FRAME, PLAIN or BODY; white space inside a line is one space."""
    lines: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    text: list[str] = []
    state, at, n = PLAIN, 0, len(html)

    def flush() -> None:
        if text:
            line = " ".join("".join(text).split())
            if line:
                lines.append((line, state))
            text.clear()

    def close(tag: str, stop: frozenset[str] = frozenset()) -> None:
        nonlocal state
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                state = stack[-1][1] if stack else PLAIN
                return
            if stack[i][0] in stop:
                return

    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            text.append(unescape(html[at:]))
            break
        if m.start() > at:
            text.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in _INLINE:
            flush()
        if m[1]:
            if tag in _INLINE and any(t == tag and s != state for t, s in stack[-1:]):
                flush()
            close(tag, _CONTAINERS if tag in _INLINE or tag == "p" else frozenset())
            if state != (stack[-1][1] if stack else PLAIN):
                flush()
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag in _VOID:
            continue
        if tag in _CLOSES_P:
            close("p", _CONTAINERS)
        elif tag in _OWN_END:
            close(tag, _CONTAINERS - {"td"})
        own = _state(tag, m[3], state)
        if own != state:
            flush()
        if not m[3].endswith("/") or tag in _CONTAINERS:
            stack.append((tag, own))
            state = own
    flush()
    return lines


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """For every beginning of a, the lengths of its longest common subsequences with the beginnings of b, as bits: bit j is 0 where b[j] adds one."""
    places: dict[int, int] = defaultdict(int)
    for j, x in enumerate(b):
        places[x] |= 1 << j
    row = full = (1 << len(b)) - 1
    out = []
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        out.append(row)
    return out


def _steps(row: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(row.to_bytes((n + 7) // 8, "little"), np.uint8), count=n, bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(a: list[int], b: list[int], most_bits: int = 1 << 24) -> list[bool]:
    """Which items of a lie on a longest common subsequence of a and b; 64 comparisons a machine word, with most_bits of memory at most beside the lines."""
    mine = [False] * len(a)
    low, high_a, high_b = 0, len(a), len(b)
    while low < high_a and low < high_b and a[low] == b[low]:
        mine[low] = True
        low += 1
    while high_a > low and high_b > low and a[high_a - 1] == b[high_b - 1]:
        high_a, high_b = high_a - 1, high_b - 1
        mine[high_a] = True
    there, here = set(b[low:high_b]), set(a[low:high_a])
    at = [i for i in range(low, high_a) if a[i] in there]  # lines without an equal one cannot be shared
    x, y = [a[i] for i in at], [v for v in b[low:high_b] if v in here]
    if not x or not y:
        return mine
    if len(x) * len(y) > most_bits and len(x) > 1:
        half = len(x) // 2
        ahead = _steps(_lengths(x[:half], y)[-1], len(y))
        behind = _steps(_lengths(x[half:][::-1], y[::-1])[-1], len(y))[::-1]
        split = int((ahead + behind).argmax())
        inner = common_lines(x[:half], y[:split], most_bits) + common_lines(x[half:], y[split:], most_bits)
        for i, both in zip(at, inner, strict=True):
            mine[i] = both
        return mine
    rows = [(1 << len(y)) - 1, *_lengths(x, y)]
    upto = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count()
    i, j = len(x), len(y)
    while i and j:
        if upto(i - 1, j) == upto(i, j):
            i -= 1
        elif rows[i] >> (j - 1) & 1:
            j -= 1
        else:
            mine[at[i - 1]] = True
            i, j = i - 1, j - 1
    return mine


def _hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode()) - (1 << 63)


def main_text(lines: list[tuple[str, int]], partner: list[int] | None) -> tuple[str, int, int]:
    """(text, lines shared with the partner, shared lines deleted)."""
    shared = common_lines([_hash(x) for x, _ in lines], partner) if partner else [False] * len(lines)
    kept = [x for (x, s), both in zip(lines, shared, strict=True) if s == BODY or (s == PLAIN and not both)]
    deleted = sum(both and s != BODY for (_, s), both in zip(lines, shared, strict=True))
    return " ".join(kept), sum(shared), deleted


def _path() -> tuple[Column, Column]:
    bare = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?#]*", 0))
    path = F.regexp_extract(bare, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _partners(heads: DataFrame, ranges: int) -> DataFrame:
    """uid -> partner uid: of the two neighbours in (host, path) order on the same host, the one with the smaller edit distance of paths."""
    keys = cut(heads.select("host", "path", "uid").repartitionByRange(ranges, "host", "path", "uid").withColumn("pid", F.spark_partition_id()))
    order = W.partitionBy("pid").orderBy("host", "path", "uid")
    me = F.struct("host", "path", "uid")
    near = keys.select("pid", "host", "path", "uid", F.lag(me).over(order).alias("prev"), F.lead(me).over(order).alias("next"))
    ends = keys.groupBy("pid").agg(F.min(me).alias("first"), F.max(me).alias("last"))  # one row per range
    across = W.orderBy("pid")
    ends = ends.select("pid", F.lag("last").over(across).alias("before"), F.lead("first").over(across).alias("after"))
    both = near.join(small_or_not(ends, ranges), "pid").withColumns({"prev": F.coalesce("prev", "before"), "next": F.coalesce("next", "after")})

    def gap(c: str) -> Column:
        return F.when(F.col(f"{c}.host") == F.col("host"), F.levenshtein(F.col("path"), F.col(f"{c}.path")))

    prev, nxt = gap("prev"), gap("next")
    return both.select("uid", F.when(prev.isNotNull() & (nxt.isNull() | (prev <= nxt)), F.col("prev.uid")).when(nxt.isNotNull(), F.col("next.uid")).alias("partner")).filter("partner IS NOT NULL")


def extract_pages(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars, n_lines, n_shared, n_deleted.

    A null html is empty (text ''). A null url is the empty host and path. A page without another on its host has
    no partner: markup alone decides. Rows with equal page_id and url share a partner; equal lines of copies under other URLs are shared
    lines, but an article element's lines stay. An empty table gives an empty result. Other columns are ignored.
    """
    host, path = _path()

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [[_hash(x) for x, _ in page_lines(h.as_py() or "")] for h in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(hashes, pa.list_(pa.int64()))], names=["uid", "key", "host", "path", "hashes"])

    key = F.struct(F.col("page_id").alias("p"), F.col("url").alias("u"))
    keyed = pages.select(F.to_json(key).alias("key"), "page_id", "url", "html")
    heads = keyed.select(F.xxhash64("key").alias("uid"), "key", host.alias("host"), path.alias("path"), "html").mapInArrow(lines_of, "uid long, key string, host string, path string, hashes array<long>")
    # One row per (page_id, url); uid is their hash, and equal hashes of different keys merely share a partner.
    heads = cut(heads.groupBy("uid").agg(F.min(F.struct("key", "host", "path", "hashes")).alias("h")).select("uid", "h.host", "h.path", "h.hashes"))
    n = heads.count()
    ranges = max(1, min(4096, n // 2_000))
    partners = _partners(heads, ranges)
    with_lines = partners.join(heads.select(F.col("uid").alias("partner"), F.col("hashes").alias("other")), "partner").select("uid", "other")
    met = keyed.withColumn("uid", F.xxhash64("key")).join(with_lines, "uid", "left").select("page_id", "url", "html", "other")
    out = T.StructType([*pages.select("page_id", "url").schema.fields, T.StructField("text", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("n_chars", "n_lines", "n_shared", "n_deleted")]])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for h, other in zip(batch.column(2), batch.column(3), strict=True):
                lines = page_lines(h.as_py() or "")
                text, shared, deleted = main_text(lines, other.as_py())
                texts.append(text)
                counts.append((len(text), len(lines), shared, deleted))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]], names=["page_id", "url", "text", "n_chars", "n_lines", "n_shared", "n_deleted"])

    return met.mapInArrow(extract, out)
