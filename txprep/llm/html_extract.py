"""The main text of web pages, by differences between pages of near URLs.

Pages of one host are put in order of their URL paths, and each page is paired
with its neighbour in that order, the one that shares more of the path (both, if
they share alike). The text lines of a pair are aligned by their longest common
subsequence; lines that the pair shares belong to the site, not to the page,
and are deleted.

What the markup tells goes before that. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts and comments that say what they are never become
lines (``html_lines``); where a page has an ``article`` or ``main`` element, lines
outside it go; and prose inside it (elements without a class or an id) stays even
if a neighbour quotes it. Differences decide the rest: all lines of a page
without such an element, and classed or named elements inside one.

1. One pass reads the pages and keeps a hash of each line; equal pages of a
   host collapse, so thousands of copies are one neighbour.
2. They are numbered over the whole table in order of host and path, a range
   of the order to a task, and meet their neighbours by number: no group of a
   host is ever gathered, so a host may hold any share of the pages.
3. The numbers of deleted lines go back to the pages, which are read again.

A pair whose shared lines are more than ``COPY_SHARE`` of the page's text is a
pair of copies and deletes nothing.

Defined results: a null or empty page has an empty text; a null URL, or one
without a host, has no neighbours; repeated rows and ids give one row each, all
alike for equal URL and page; very long pages are read whole; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prefix_sums, text_or_empty, written
from .html_lines import PLAIN, Line, decided, read_lines

COPY_SHARE = 0.9
#: Bits of alignment state held at a time.
STATE_BITS = 1 << 28
FLUSH_BYTES = 8 << 20

LINES_SCHEMA = "host string, path string, page_a long, page_b long, hashes binary, sizes binary, unsure binary"
DELETED_SCHEMA = "host string, page_a long, page_b long, deleted binary"
TEXT_SCHEMA = "page_id long, url string, text string, n_lines long, n_shared long"


# ------------------------------------------------------------ alignment
def _rows(a: list[int], b: list[int]) -> list[int]:
    """After each symbol of b, a number whose bit i is 0 where the longest common
    subsequence of b so far and a grows with a[i]."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v, rows = full, []
    for y in b:
        u = v & places.get(y, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def _last_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of b with each prefix of a."""
    v = (1 << len(a)) - 1
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = v
    for y in b:
        u = v & places.get(y, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(a)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(a: list[int], b: list[int], bits: int = STATE_BITS) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    in_b = set(b)
    keep = [i for i, x in enumerate(a) if x in in_b]
    in_a = {a[i] for i in keep}
    return _align(a, keep, [y for y in b if y in in_a], bits)


def _align(a: list[int], places: list[int], b: list[int], bits: int) -> list[int]:
    head = 0
    while head < min(len(places), len(b)) and a[places[head]] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(places), len(b)) - head and a[places[-1 - tail]] == b[-1 - tail]:
        tail += 1
    first, last = places[:head], places[len(places) - tail:]
    middle, b = places[head:len(places) - tail], b[head:len(b) - tail]
    if not middle or not b:
        return first + last
    x = [a[i] for i in middle]
    if len(x) * len(b) > bits and len(b) > 1:
        # cut b in half, and a where both halves together align best
        half = len(b) // 2
        forward = _last_lengths(x, b[:half])
        backward = _last_lengths(x[::-1], b[half:][::-1])[::-1]
        cut = int((forward + backward).argmax())
        return [*first, *_align(a, middle[:cut], b[:half], bits), *_align(a, middle[cut:], b[half:], bits), *last]
    rows, found = _rows(x, b), []
    i, j = len(x), len(b)
    while i and j:
        if rows[j - 1] >> (i - 1) & 1:
            i -= 1
            continue
        j -= 1
        if j and not rows[j - 1] >> (i - 1) & 1:
            continue
        i -= 1
        found.append(middle[i])
    return first + found[::-1] + last


def shared_path(a: str, b: str) -> int:
    """Leading parts that two URL paths share."""
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


# ------------------------------------------------------------ reading
def _unsure(lines: list[Line], kept: list[bool]) -> list[bool]:
    """Lines that the differences decide on."""
    return [k and (line.level == PLAIN or line.named) for line, k in zip(lines, kept)]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash
    for batch in batches:
        out: list[tuple[bytes, bytes, bytes]] = []
        for page in batch.column("html"):
            lines = read_lines(page.as_py())
            out.append((np.array([xxhash.xxh64_intdigest(x.text) for x in lines], "<u8").tobytes(),
                        np.array([len(x.text) for x in lines], "<u4").tobytes(),
                        np.array(_unsure(lines, decided(lines)), np.uint8).tobytes()))
        columns = list(zip(*out)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("host", "path", "page_a", "page_b")], *[pa.array(c, pa.binary()) for c in columns]],
            names=["host", "path", "page_a", "page_b", "hashes", "sizes", "unsure"])


def deleted_lines(path: str, hashes: list[int], sizes: np.ndarray, unsure: np.ndarray,
                  others: list[tuple[str, list[int]]]) -> np.ndarray:
    """Numbers of the unsure lines that the nearest of ``others`` (path, line
    hashes) share in order."""
    nearest = max((shared_path(path, p) for p, _ in others), default=0)
    gone: set[int] = set()
    for other, lines in others:
        if shared_path(path, other) < nearest:
            continue
        common = np.array(common_lines(hashes, lines), np.int64)
        if len(common) and sizes[common].sum() <= COPY_SHARE * sizes.sum():
            gone.update(common[unsure[common] == 1].tolist())
    return np.array(sorted(gone), "<i4")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            others = [(r[f"{side}_path"], np.frombuffer(r[f"{side}_hashes"], "<u8").tolist())
                      for side in ("before", "after") if r[f"{side}_hashes"] is not None]
            gone = deleted_lines(r["path"], np.frombuffer(r["hashes"], "<u8").tolist(), np.frombuffer(r["sizes"], "<u4"),
                                 np.frombuffer(r["unsure"], np.uint8), others)
            if len(gone):
                rows.append((r["host"], r["page_a"], r["page_b"], gone.tobytes()))
        host, a, b, gone = zip(*rows) if rows else ([],) * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(host, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(gone, pa.binary())],
            names=["host", "page_a", "page_b", "deleted"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for page_id, url, page, deleted in zip(*[batch.column(c) for c in ("page_id", "url", "html", "deleted")]):
            lines = read_lines(page.as_py())
            gone = set(np.frombuffer(deleted.as_py(), "<i4").tolist()) if deleted.is_valid else ()
            kept = [x.text for i, (x, k) in enumerate(zip(lines, decided(lines))) if k and i not in gone]
            rows.append((page_id.as_py(), url.as_py(), " ".join(kept), len(lines), len(gone)))
            size += len(rows[-1][2]) + 64
            if size > FLUSH_BYTES:
                yield _texts(rows)
                rows, size = [], 0
    if rows:
        yield _texts(rows)


def _texts(rows: list[tuple]) -> pa.RecordBatch:
    ids, urls, texts, n, gone = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
                                       pa.array(n, pa.int64()), pa.array(gone, pa.int64())],
                                      names=["page_id", "url", "text", "n_lines", "n_shared"])


# ------------------------------------------------------------ pairs
def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def near_differences(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``host, page_a, page_b, deleted`` (line numbers) for the pages of which
    differences delete any line; ``pages``: ``host, path, page_a, page_b, html``."""
    lines = pages.filter("host <> ''").mapInArrow(_read, LINES_SCHEMA)
    one = lines.groupBy("host", "page_a", "page_b").agg(
        F.min("path").alias("path"), *[F.first(c).alias(c) for c in ("hashes", "sizes", "unsure")])
    # "/" first, so that a folder's pages follow each other
    order = ["host", "key", "page_a", "page_b"]
    ranged = written(spark, one.withColumn("key", F.translate("path", "/", "\x01")), "html-lines") \
        .repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    placed = prefix_sums(written(spark, ranged.withColumn("one", F.lit(1)), "html-ranges"), "part", order, "one", "place")
    placed = written(spark, placed.drop("key", "part", "one"), "html-places")
    asking = placed.filter(F.col("unsure").contains(F.lit(b"\x01")))
    pairs = asking
    for side, step in (("before", -1), ("after", 1)):
        other = placed.select((F.col("place") - step).alias("place"), F.col("host").alias("other_host"),
                              F.col("path").alias("other_path"), F.col("hashes").alias("other_hashes"))
        here = F.col("other_host") == F.col("host")
        pairs = pairs.join(other, "place", "left") \
            .withColumn(f"{side}_path", F.when(here, F.col("other_path"))) \
            .withColumn(f"{side}_hashes", F.when(here, F.col("other_hashes"))) \
            .drop("other_host", "other_path", "other_hashes")
    return pairs.drop("place").mapInArrow(_compare, DELETED_SCHEMA)


def extract_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_lines, n_shared`` per row of ``pages``
    (``page_id, url, html``): the main text (blocks joined by a blank), the lines
    the markup left and those that differences deleted."""
    whole = text_or_empty("html")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", whole.alias("html"),
                         F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"),
                         F.coalesce(url_path(F.col("url")), F.lit("")).alias("path"),
                         F.xxhash64(whole).alias("page_a"), F.xxhash64(F.lit(1), whole).alias("page_b"))
    found = written(spark, near_differences(spark, keyed.drop("page_id", "url")), "html-deleted")
    joined = keyed.drop("path").join(found, ["host", "page_a", "page_b"], "left")
    return joined.select("page_id", "url", "html", "deleted").mapInArrow(_extract, TEXT_SCHEMA)
