"""Main text of pages: lines that the nearest page of the same host shares are not its own (operator 13)."""

from __future__ import annotations

import html as entities
import math
import os.path
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import settled, settled_in_place, ship, table
from docketlake.llm.url_filter import host_and_path

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset("""
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary
    table tbody tfoot thead tr ul
""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Their content is text up to the closing tag, whatever it looks like. None of it is page text.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in "script style title textarea iframe noframes xmp".split()}
#: Elements, roles and names (words of class and id) of what stands around an article.
CHROME_TAGS = frozenset("head nav footer aside form noscript template button select dialog menu svg canvas object audio video fieldset search".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar tablist status".split())
CHROME_NAMES = frozenset("""
    ad ads advert adverts advertising advertisement banner sponsor sponsored sponsors promo promotion nav navbar navigation menu menus
    breadcrumb breadcrumbs sidebar sidebars aside footer masthead toolbar topbar cookie cookies consent gdpr notice notices alert
    alerts popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
    recommendations comment comments commentlist reply replies respond disqus pagination pager widget widgets
""".split())
HEADER_NAMES = frozenset(["header"])
#: An element is closed by the start of one of the same kind, looked for no further up than the boundary.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
}
#: A start of a block closes a paragraph, but not one outside of these.
OUTSIDE_P = BLOCKS - HEADINGS - {"p"} | {"td", "th", "button", "object"}
#: A pair of pages that share more than this part of their open text are taken for copies of one, not for a template.
COPY_SHARE = 0.5

_MARK = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_TAG_END = re.compile(r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*+>""")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>"']|$)""", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*|[0-9]+")

#: Where a line stands: in what surrounds the page's own text, anywhere else, in a main element, in an article.
CHROME, OPEN, MAIN, ARTICLE = range(4)


def _place(tag: str, attributes: str, above: int, heading_kept: bool) -> tuple[int, bool]:
    """The place of an element's text, and whether only headings of it count (the header of an article)."""
    if above == CHROME:
        return (above, False)
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        found.setdefault(name.lower(), "".join(values))
    names = {w.lower() for key in ("class", "id") for w in _NAME.findall(found.get(key, ""))} if tag not in ("html", "body", "main", "article") else set()
    role = found.get("role", "").strip().lower()
    if tag in CHROME_TAGS or role in CHROME_ROLES or names & CHROME_NAMES or "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return CHROME, False
    if tag == "header" or names & HEADER_NAMES:
        return (above, True) if above >= MAIN else (CHROME, False)
    if tag == "article" or role == "article" or "articlebody" in found.get("itemprop", "").lower().split():
        return ARTICLE, heading_kept
    return (max(above, MAIN) if tag == "main" or role == "main" else above), heading_kept


def lines_of_page(html: str) -> list[tuple[str, int]]:
    """The blocks of text of a page, in order, each with its place.

    Character references are decoded and white space (Unicode's) is one space. ``br`` is white space. Unclosed and
    misnested elements are closed by what comes after them; what a quote, a comment or a script leaves open at the end
    of the page belongs to it.
    """
    lines: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool]] = [("", OPEN, False)]
    held: list[list[str]] = [[], []]
    place_held = OPEN

    def flush() -> None:
        for kind, place in ((0, CHROME), (1, place_held)):
            if held[kind]:
                text = " ".join("".join(held[kind]).split())
                if text:
                    lines.append((text, place))
                held[kind].clear()

    def add(text: str) -> None:
        nonlocal place_held
        if text:
            _, place, headings_only = stack[-1]
            if headings_only and not any(t in HEADINGS for t, _, _ in stack):
                place = CHROME
            if place != CHROME:
                place_held = place
            held[place != CHROME].append(entities.unescape(text) if "&" in text else text)

    def close(names, boundary) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in boundary:
                return

    at, size = 0, len(html)
    while at < size:
        mark = _MARK.search(html, at)
        if mark is None:
            add(html[at:])
            break
        add(html[at : mark.start()])
        comment, declared, closing, tag = mark.groups()
        if comment:
            end = html.find("-->", mark.start() + 2)
            at = end + 3 if end >= 0 else size
            continue
        if declared:
            end = html.find(">", mark.end())
            at = end + 1 if end >= 0 else size
            continue
        end = _TAG_END.match(html, mark.end())
        at = end.end() if end else size
        tag = tag.lower()
        if tag in BLOCKS:
            flush()
        elif tag in ("br", "td", "th"):
            held[0].append(" ")
            held[1].append(" ")
        if closing:
            close((tag,), () if tag in BLOCKS else BLOCKS)
            continue
        if tag in BLOCKS:
            close(("p",), OUTSIDE_P)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in RAW:
            end = RAW[tag].search(html, at)
            at = end.start() if end else size
            continue
        if tag not in VOID:
            stack.append((tag, *_place(tag, html[mark.end() : at - 1], stack[-1][1], stack[-1][2])))
    flush()
    return lines


def line_hashes(lines: list[tuple[str, int]]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t, _ in lines], dtype=np.uint64).view(np.int64)


def shared_lines(own: list[int], other: list[int]) -> list[int]:
    """Places in ``own`` of a longest common subsequence with ``other``.

    One bit for each line of ``own``: after each line of ``other`` a bit is 0 where the subsequence grows. Every so many
    of these rows are kept, those between are made again on the way back, so that memory grows with n sqrt(m) / 8 bytes.
    """
    where: dict[int, int] = {}
    for i, x in enumerate(own):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(own)) - 1

    def rows(row: int, low: int, high: int) -> list[int]:
        out = [row]
        for x in other[low:high]:
            met = row & where.get(x, 0)
            row = ((row + met) | (row - met)) & full
            out.append(row)
        return out

    step = math.isqrt(len(other)) + 1
    kept, row = [], full
    for low in range(0, len(other), step):
        kept.append(row)
        row = rows(row, low, low + step)[-1]
    found, column = [], len(own)
    for block in range(len(kept) - 1, -1, -1):
        held = rows(kept[block], block * step, min(len(other), (block + 1) * step))
        i = len(held) - 1
        while i and column:
            bit = 1 << (column - 1)
            if held[i] & bit:
                column -= 1
            elif held[i - 1] & bit:
                column, i = column - 1, i - 1
                found.append(column)
            else:
                i -= 1
    return found[::-1]


def main_text(lines: list[tuple[str, int]], near: list[int] | None) -> tuple[str, int]:
    """The page's own text, and how many of its lines the nearest page shares; ``near`` are that page's lines, hashed.

    Of lines outside a main or article element shared ones go, unless the pages are copies of each other by COPY_SHARE.
    Lines of an article stay, since copies and quotations are text too. What menus and the like have of their own, which
    no other page shares, goes by its markup.
    """
    shared = set(shared_lines(line_hashes(lines).tolist(), near)) if near and lines else set()
    chars = [sum(len(t) for t, p in lines if p >= place) for place in range(4)]
    top = ARTICLE if chars[ARTICLE] and 2 * chars[ARTICLE] >= chars[MAIN] else MAIN if chars[MAIN] else OPEN
    gone: set[int] = set()
    if top == OPEN and sum(len(lines[i][0]) for i in shared if lines[i][1] == OPEN) <= COPY_SHARE * chars[OPEN]:
        gone = shared
    return "\n".join(t for i, (t, p) in enumerate(lines) if p >= top and i not in gone), len(shared)


def _keyed(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host, path, key``: pages of one host and equal html have one key."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    return rows.withColumn("key", F.xxhash64("host", "html"))


def nearest_pages(keyed: DataFrame) -> DataFrame:
    """``key, near``: for each key the one before or after it by path whose path begins alike for longer; of ties the one before.

    ``keyed``: ``host, path, key``; a key's path is its least. Rows are dealt out by ranges of (host, path), so that a
    host of very many pages spreads over partitions; the first and last row of each reach the driver. A host's only
    key has no row.
    """
    spark = keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "key"]
    rows = keyed.groupBy("host", "key").agg(F.min("path").alias("path")).select(*order)
    dealt = settled_in_place(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()))
    ends = sorted(tuple(r) for r in dealt.groupBy("pid").agg(F.min(F.struct(*order)).alias("a"), F.max(F.struct(*order)).alias("b")).collect())
    before = {pid: tuple(ends[i - 1][2]) if i else None for i, (pid, _, _) in enumerate(ends)}
    after = {pid: tuple(ends[i + 1][1]) if i + 1 < len(ends) else None for i, (pid, _, _) in enumerate(ends)}
    around = spark.sparkContext.broadcast((before, after))

    def pair(batches):
        last = here = pid = None
        out: list[tuple[int, int]] = []

        def near(left, this, right) -> None:
            alike = [(len(os.path.commonprefix([x[1], this[1]])), -i, x[2]) for i, x in enumerate((left, right)) if x is not None and x[0] == this[0]]
            if alike:
                out.append((this[2], max(alike)[2]))

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns[:3], strict=True):
                if here is None:
                    pid = columns[3][0]
                    last = around.value[0][pid]
                else:
                    near(last, here, row)
                    last = here
                here = row
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["key", "near"])
                out = []
        if here is not None:
            near(last, here, around.value[1][pid])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["key", "near"])

    return dealt.mapInArrow(pair, "key long, near long")


def _hashed(batches):
    for batch in batches:
        lines = [line_hashes(lines_of_page(html)).tolist() for html in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.list_(pa.int64()))], ["key", "lines"])


def _extract(batches):
    for batch in batches:
        found = [main_text(lines_of_page(html), near) for html, near in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        texts = pa.array([t.encode("utf-8", "replace") for t, _ in found], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, pa.array([n for _, n in found], pa.int64())], ["page_id", "url", "text", "n_shared"])


def page_texts(pages: DataFrame) -> DataFrame:
    """One row for each row of ``pages``: ``page_id, url, text, n_shared``.

    A page's lines are its blocks of text, outside scripts, styles and markup. Each page is paired with the nearest one
    by url path among those of its host with other html, their lines are aligned by a longest common subsequence, and
    ``n_shared`` of its lines are shared. Shared lines go, but for those of an article (see ``main_text``); then what menus,
    headers, footers, sidebars, notices, adverts, forms and comments have of their own goes by its markup. Of a page with
    an ``article``, or else a ``main`` element, only that counts.

    Null html counts as empty and has an empty text. A null url, or one without ``://``, has an empty host, which is a
    host like any other. Rows that repeat are answered each, with the same text. Extra columns are ignored.
    """
    ship(pages.sparkSession)
    keyed = _keyed(pages)
    near = nearest_pages(keyed.select("host", "path", "key"))
    lines = keyed.select("key", "html").mapInArrow(_hashed, "key long, lines array<long>").groupBy("key").agg(F.first("lines").alias("lines"))
    theirs = settled(near.join(lines.withColumnRenamed("key", "near"), "near").select("key", "lines"))
    both = keyed.select("page_id", "url", "html", "key").join(theirs, "key", "left").select("page_id", "url", "html", "lines")
    return both.mapInArrow(_extract, "page_id long, url string, text binary, n_shared long").withColumn("text", F.col("text").cast("string"))


def op13_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")
