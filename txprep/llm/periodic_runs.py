"""Maximal periodic runs of words, by Lyndon roots.

Every run has a Lyndon root (the least rotation of its period, in one of the two
orders of the words) that is the longest Lyndon word from its place on. So the
Lyndon arrays under both orders, which phase one of the grouping suffix sorter
yields (``lyndon.phase_one``), name a place and the period of every run; the
root is then extended to both sides as far as words one period apart agree
(longest common extensions).

A text is first narrowed, losing no run: a run of ``least`` words or more, and of
``MIN_EXPONENT`` periods or more, has ``least / 3`` words beyond two periods, so
every string of that many words in it occurs twice in the text. Only stretches
of such strings are sorted; in prose there are hardly any.

Rows are independent: no shuffle, memory is bounded by a text. Defined results:
a null text has no words, no runs and an empty collapse; a null id is a row like
any other (``rewrite`` sees None); repeated rows give repeated results; a very
long text is handled whole, in time linear in it but for a sort; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .lyndon import lyndon_arrays

LEAST = 24
MIN_EXPONENT = 3
#: Texts of this many bytes together leave a task's buffer at once.
FLUSH_BYTES = 8 << 20

SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
          "best struct<start: long, length: long, period: long>, collapsed string")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def _repeated_stretches(codes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Ranges of places that hold every run: stretches of strings of ``least //
    3`` words that occur twice. Equal strings have equal hashes, so a collision
    only adds a range."""
    k = least // MIN_EXPONENT
    if len(codes) < least:
        return []
    h, have, mix = codes.view(np.uint64), 1, np.uint64(0x9E3779B97F4A7C15)
    while have < k:
        step = min(have, k - have)
        h = (h[:-step] * mix + (h[step:] ^ (h[step:] >> np.uint64(31)))) * np.uint64(0xBF58476D1CE4E5B9)
        have += step
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    mark = np.isin(h, twice)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mark, [0]]).astype(np.int8)))
    return [(a, b + k - 1) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b + k - 1 - a >= least]


def _agree(a: np.ndarray, i: int, j: int) -> int:
    """How many symbols from i and from j (> i) on are equal."""
    n, step, most = 0, 64, len(a) - j
    while n < most:
        k = min(step, most - n)
        differ = a[i + n:i + n + k] != a[j + n:j + n + k]
        at = int(differ.argmax())
        if differ[at]:
            return n + at
        n, step = n + k, step * 2
    return n


def _roots(symbols: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Periods and, for each, the ascending places of Lyndon words of that
    length that are followed by themselves."""
    n = len(symbols)
    weights = np.cumprod(np.full(n + 1, 0x5851F42D4C957F2D, np.uint64))
    values = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * weights[:n])])
    found = []
    for lengths in lyndon_arrays(symbols.tolist()):
        i, p = np.arange(n), np.array(lengths, np.int64)
        fits = i + 2 * p <= n
        i, p = i[fits], p[fits]
        # the hash only spares the extension of roots that aren't repeated
        square = (sums[i + p] - sums[i]) * weights[p - 1] == sums[i + 2 * p] - sums[i + p]
        found.append(np.column_stack([p[square], i[square]]))
    pairs = np.unique(np.concatenate(found), axis=0)
    cut = np.flatnonzero(np.diff(pairs[:, 0])) + 1
    return [(int(g[0, 0]), g[:, 1]) for g in np.split(pairs, cut) if len(g)]


def runs_of(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``words`` with at least
    ``least`` words and three periods, by start, then period."""
    if len(words) < least:
        return []
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    runs = []
    for a, b in _repeated_stretches(codes, least):
        names: dict[bytes, int] = {}
        symbols = np.array([names.setdefault(w, len(names)) for w in words[a:b]], np.int64)
        back = symbols[::-1]
        n = len(symbols)
        for p, places in _roots(symbols):
            at = 0
            while at < len(places):
                i = int(places[at])
                start = i - _agree(back, n - i - p, n - i)
                end = i + p + _agree(symbols, i, i + p)
                if end - start >= max(least, MIN_EXPONENT * p):
                    runs.append((a + start, end - start, p))
                # the other roots in this run say the same
                at = max(at + 1, int(np.searchsorted(places, end - p + 1)))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if g == 0]


def _find(least: int, rewrite: Rewrite | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = text.as_buffer().to_pybytes().split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                runs = runs_of(words, least)
                best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
                text = b" ".join(collapse(words, runs))
                rows.append((doc_id, len(words), runs, best, text))
                size += len(text) + 64
                if size > FLUSH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, n, runs, best, text = zip(*rows)
    named = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(named, pa.list_(_RUN)),
         pa.array([None if b is None else dict(zip(("start", "length", "period"), b)) for b in best], _RUN),
         pa.array(text, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "best", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
              rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id, n_words, runs, best, collapsed`` per document: all maximal runs
    of words by start and period, the one with the greatest length over period
    (ties: smallest start, then period; null if there is none) and the words
    that no run repeats, joined by a space. ``least`` (9 or more) is the least
    length of a run; ``rewrite`` may change a document's words before."""
    if least < 3 * MIN_EXPONENT:
        raise ValueError(f"least must be {3 * MIN_EXPONENT} or more")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_find(least, rewrite), SCHEMA)
