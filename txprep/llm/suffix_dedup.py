"""Removal of repeated byte strings, with suffix arrays by linear grouping.

A byte goes if a ``LENGTH``-byte string over it also starts in a document with
a smaller id. Every such string holds ``LENGTH - K + 1`` strings of ``K`` bytes;
the first one with the smallest hash is its *anchor*, and it depends on the
string's content alone, so equal strings meet at equal anchors. Successive strings of a
document with one anchor make a *run*: the anchor, what precedes it (left) and
what follows (right).

1. ``chunks``: documents are packed into compressed chunks of bounded size.
2. Anchors that occur in two documents are found by an exchange of 6-byte keys,
   each once per chunk.
3. Runs with such anchors go to their anchor's shard, each content once per
   chunk, with its smallest document; the shard merges equal contents. Lefts
   (reversed) and rights of anchors with several contents are concatenated and
   sorted by a suffix array (``suffix_array``); sides that agree up to a depth are
   neighbours in it, and their common prefixes tell up to where. A string is
   a left up to one depth and a right up to another, so this tells exactly which
   strings are equal, and the smallest document of each.
4. One bit per string goes back to the run's chunk, where bytes are removed.

``suffix_array`` sorts by groups of suffixes with equal Lyndon prefixes: groups
are processed in descending order, previous-smaller pointers move the suffixes
before them to new groups (``lyndon.phase_one``), and a pass over the result
emits each group's order.

Both exchanges route by the digits of the shard's number: a chunk sends at most
``FAN`` messages, whatever the size of the corpus, and where there are more
shards than that, further rounds merge the messages of some ``FAN`` chunks and
split them by the next digit (``route``).

Hot passages: copies within a chunk collapse before the shuffle, so a shard gets
a row per chunk and content, however many documents hold it. Nothing reaches
the driver.

Defined results: a null text is empty; texts under ``LENGTH`` bytes keep all;
a very long text is a chunk of its own; a null ``doc_id`` is neither smaller nor
larger than any, its text is kept and removes nothing; rows with the same
``doc_id`` never remove from each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .lyndon import phase_one

LENGTH = 50
K = 16
#: Strings of K bytes in one of LENGTH bytes, and the longest left or right.
SPAN = LENGTH - K + 1
SIDE = LENGTH - K
CHUNK_BYTES = 4 << 20
#: Messages that a chunk sends, at most, and that a routing step merges, about.
FAN = 128
#: Chunks for one shard.
CHUNKS_PER_SHARD = 2
#: Bytes to a symbol of the suffix array: 257 to this power fits 64 bits.
BLOCK = 7
#: Symbols that one suffix array sorts, about; the sort is linear, this bounds memory.
SORT_SYMBOLS = 1 << 16

ROW_SCHEMA = "chunk long, kind int, part long, n long, data binary"
DIGEST_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed binary"


# ------------------------------------------------------------ suffix array
def suffix_array(text) -> list[int]:
    """The starts of the suffixes of ``text`` (bytes or small ints) in order,
    in linear time apart from sorting a group's places."""
    n = len(text)
    start, before, _ = phase_one(text)
    # a suffix comes right after its group's earlier ones once its next smaller suffix is out
    head = list(range(n))
    result, done = [0] * n, [False] * n
    for i in range(-1, n):
        j = (result[i] if i >= 0 else n) - 1
        while j >= 0 and not done[j]:
            g = start[j]
            h = head[g]
            result[h] = j
            head[g] = h + 1
            done[j] = True
            j = before[j]
    return result


# ------------------------------------------------------------ anchors and runs
def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of K = 16 bytes, from their halves."""
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(7))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _least_places(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the first smallest value, by its upper half, in every window
    of ``width``. Hash and place share a word, so one minimum does for both."""
    v, k = (h & ~np.uint64(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64), 1
    while k < width:
        step = min(k, width - k)                 # the last step overlaps
        v = np.minimum(v[:-step], v[step:])
        k += step
    return (v & np.uint64(0xFFFFFFFF)).view(np.int64)


def _eights(buf: bytes) -> np.ndarray:
    """The 8 bytes from every place on, as a view."""
    return np.ndarray(shape=(max(len(buf) - 7, 0),), dtype="<u8", buffer=buf, strides=(1,))


def _anchors(buf: bytes, block: int = 1 << 15) -> np.ndarray:
    """The anchor's place of the string that starts at each place, in pieces
    that stay in a processor's cache."""
    n = len(buf) - LENGTH + 1
    eights, out = _eights(buf), np.empty(n, np.int64)
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        m = hi - lo + SPAN - 1
        u = eights[lo:lo + m + 8].copy()
        out[lo:hi] = _least_places(_mix(u[:m], u[8:8 + m]), SPAN) + lo
    return out


class Runs:
    """The runs of a chunk: ``doc`` (place of the document), ``key``, the
    anchor's place, first and last string start."""

    def __init__(self, buf: bytes, ends: np.ndarray, usable: np.ndarray):
        self.doc = self.key = self.anchor = self.lo = self.hi = np.empty(0, np.int64)
        if len(buf) < LENGTH:
            return
        at = _anchors(buf)                                  # the anchor of the string that starts here
        starts = np.concatenate([[0], ends[:-1]])
        whole = usable & (ends - starts >= LENGTH)
        edge = np.zeros(len(at) + 1, np.int8)               # where strings inside a document start
        edge[starts[whole]] += 1
        edge[ends[whole] - LENGTH + 1] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        # strings of two documents have no anchor in common
        new = np.concatenate([[True], at[1:] != at[:-1]])
        self.lo = np.flatnonzero(inside & (new | ~np.concatenate([[False], inside[:-1]])))
        self.hi = np.flatnonzero(inside & np.concatenate([new[1:] | ~inside[1:], [True]]))
        self.anchor = at[self.lo]
        self.doc = np.searchsorted(ends, self.lo, side="right")
        eights = _eights(buf)
        self.key = _mix(eights[self.anchor], eights[self.anchor + 8])

    def take(self, which: np.ndarray) -> None:
        for name in ("lo", "hi", "doc", "key", "anchor"):
            setattr(self, name, getattr(self, name)[which])


def _short(key: np.ndarray) -> np.ndarray:
    """The 47 bits of a hash by which chunks tell each other of anchors."""
    return key >> np.uint64(17)


# ------------------------------------------------------------ blobs
def _blob(*arrays: np.ndarray | bytes, level: int = 1) -> bytes:
    """Arrays in one string, compressed unless ``level`` is 0; ``_unblob`` gives
    their bytes."""
    raw = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    body = np.array([len(raw), *map(len, raw)], "<u8").tobytes() + b"".join(raw)
    if not level:
        return bytes(8) + body
    return np.array([len(body)], "<u8").tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _unblob(blob: bytes) -> list[bytes]:
    size = int(np.frombuffer(blob, "<u8", 1)[0])
    body = pa.decompress(blob[8:], size, codec="zstd", asbytes=True) if size else blob[8:]
    count = int(np.frombuffer(body, "<u8", 1)[0])
    sizes = np.frombuffer(body, "<u8", count, 8).astype(int)
    at = 8 * (count + 1)
    out = []
    for size in sizes:
        out.append(body[at:at + size])
        at += size
    return out


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    chunk, kind, part, n, data = zip(*rows) if rows else ([],) * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(kind, pa.int32()), pa.array(part, pa.int64()),
         pa.array(n, pa.int64()), pa.array(data, pa.binary())], names=["chunk", "kind", "part", "n", "data"])


DOCS, SHARED, MASKS = 0, 1, 2


class Chunk:
    def __init__(self, data: bytes):
        ids, null, ends, self.buf = _unblob(data)
        self.ids = np.frombuffer(ids, "<i8")
        self.null = np.frombuffer(null, np.uint8).astype(bool)
        self.ends = np.frombuffer(ends, "<i8")

    def runs(self) -> Runs:
        return Runs(self.buf, self.ends, ~self.null)


def _pack(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        ids, texts, size, count = [], [], 0, 0

        def flush():
            data = _blob(np.array([i or 0 for i in ids], "<i8"), np.array([i is None for i in ids], np.uint8),
                         np.cumsum([len(t) for t in texts]).astype("<i8"), b"".join(texts))
            return _rows([(part << 32 | count, DOCS, 0, len(ids), data)])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                if texts and size + len(raw) > chunk_bytes:
                    yield flush()
                    ids, texts, size, count = [], [], 0, count + 1
                ids.append(doc_id)
                texts.append(raw)
                size += len(raw)
        if texts:
            yield flush()
    return run


def _by_key(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of sorted batches, one list per value of ``columns``."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[c] for c in columns)
            if rows and now != key:
                yield key, rows
                rows = []
            key = now
            rows.append(row)
    if rows:
        yield key, rows


class Shards:
    """How keys are dealt to ``base ** levels`` shards: one digit a round."""

    def __init__(self, wanted: int, fan: int = FAN):
        self.levels = 1
        while fan ** self.levels < wanted:
            self.levels += 1
        self.base = 1
        while self.base ** self.levels < wanted:
            self.base += 1

    def of(self, key: np.ndarray, level: int) -> np.ndarray:
        """The leading ``level`` digits of the keys' shards, as one number."""
        return _short(key).astype(np.int64) % self.base ** self.levels // self.base ** (self.levels - level)

    def last(self, key: np.ndarray) -> np.ndarray:
        return self.of(key, self.levels)


def _split(message: "Keys | Contents", shards: Shards, level: int, kind: int) -> list[tuple]:
    """The rows of a message, by the leading digits of its keys."""
    part = shards.of(message.key, level)
    if (part[1:] < part[:-1]).any():
        order = np.argsort(part, kind="stable")
        message, part = message.take(order), part[order]
    begin = np.flatnonzero(np.diff(part, prepend=-1))
    rows = []
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(part)]):
        mine = message.between(a, b)
        # rows of one round are named by the first of their chunks
        rows.append((int(mine.chunk[0]), kind, int(part[a]), b - a, mine.pack()))
    return rows


def route(df: DataFrame, shards: Shards, kind: int, n_chunks: int) -> DataFrame:
    """Messages split by the first digit, dealt to the shards of all digits."""
    make = Keys if kind == SHARED else Contents

    def step(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, rows in _by_key(batches, "part", "meet"):
                yield _rows(_split(make.join([make.unpack(x["data"]) for x in rows]), shards, level, kind))
        return run

    for level in range(2, shards.levels + 1):
        # about FAN messages of a digit meet in a task, whatever the number of chunks
        groups = max(1, n_chunks // shards.base ** (level - 1))
        meet = F.pmod(F.xxhash64("chunk"), F.lit(groups))
        dealt = df.withColumn("meet", meet).repartition("part", "meet").sortWithinPartitions("part", "meet", "chunk")
        df = dealt.mapInArrow(step(level), ROW_SCHEMA)
    return df


class Keys:
    """Keys of anchors with the chunks that have them, and whether two documents of the chunk do."""

    def __init__(self, chunk: np.ndarray, key: np.ndarray, many: np.ndarray):
        self.chunk, self.key, self.many = chunk, key, many

    def take(self, at: np.ndarray) -> "Keys":
        return Keys(self.chunk[at], self.key[at], self.many[at])

    def between(self, a: int, b: int) -> "Keys":
        return Keys(self.chunk[a:b], self.key[a:b], self.many[a:b])

    def pack(self) -> bytes:
        """Six bytes a key, and each chunk once."""
        begin = np.flatnonzero(np.diff(self.chunk, prepend=-1))
        short = (_short(self.key).astype(np.int64) << 1) | self.many
        six = short.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]
        return _blob(self.chunk[begin].astype("<i8"), begin.astype("<i8"), six.tobytes(), level=0)

    @staticmethod
    def unpack(data: bytes) -> "Keys":
        chunk, begin, six = _unblob(data)
        eight = np.zeros((len(six) // 6, 8), np.uint8)
        eight[:, :6] = np.frombuffer(six, np.uint8).reshape(-1, 6)
        sent = eight.view("<i8").ravel()
        begin = np.frombuffer(begin, "<i8")
        chunk = np.repeat(np.frombuffer(chunk, "<i8"), np.diff(begin, append=len(sent)))
        return Keys(chunk, (sent >> 1).astype(np.uint64) << np.uint64(17), (sent & 1).astype(bool))

    @staticmethod
    def join(parts: list["Keys"]) -> "Keys":
        return Keys(*[np.concatenate([getattr(p, c) for p in parts]) for c in ("chunk", "key", "many")])


def _send_keys(shards: Shards):
    """Each anchor of a chunk once, and whether two of its documents have it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row["data"])
                r = c.runs()
                if not len(r.key):
                    continue
                # runs of one anchor in two places of this chunk that are different documents
                order = np.argsort(r.key, kind="stable")
                key, doc = _short(r.key[order]), r.doc[order]
                begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                many = np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin)
                chunk = np.full(len(begin), row["chunk"], np.int64)
                yield _rows(_split(Keys(chunk, key[begin] << np.uint64(17), many), shards, 1, SHARED))
    return run


def _answer_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each chunk, those of its anchors that two documents have."""
    for (part,), rows in _by_key(batches, "part"):
        sent = Keys.join([Keys.unpack(x["data"]) for x in rows])
        order = np.argsort(sent.key, kind="stable")
        key, many = sent.key[order], sent.many[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n = np.diff(begin, append=len(key))
        keep = np.repeat((n > 1) | np.logical_or.reduceat(many, begin), n)
        key, chunk = key[keep], sent.chunk[order][keep]
        # one answer a chunk: sort and split
        order = np.argsort(chunk, kind="stable")
        key, chunk = _short(key[order]).astype("<i8"), chunk[order]
        begin = np.flatnonzero(np.diff(chunk, prepend=-1))
        for lo in range(0, len(begin), 1024):
            ends = [*begin[lo + 1:lo + 1025].tolist(), len(chunk)]
            yield _rows([(int(chunk[a]), SHARED, part, b - a, _blob(key[a:b]))
                         for a, b in zip(begin[lo:lo + 1024].tolist(), ends)])


def _shared_runs(c: Chunk, rows: list[dict]) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of a chunk with shared anchors, the contents among them (place
    of one run each, one that has the smallest document) and each run's content."""
    r = c.runs()
    answers = [np.frombuffer(_unblob(x["data"])[0], "<i8") for x in rows if x["kind"] == SHARED]
    shared = np.sort(np.concatenate(answers)) if answers else np.empty(0, np.int64)
    short = _short(r.key).astype(np.int64) if len(r.key) else np.empty(0, np.int64)
    if len(shared) and len(short):
        at = np.minimum(np.searchsorted(shared, short), len(shared) - 1)
        r.take(shared[at] == short)
    else:
        r.take(np.empty(0, np.int64))
    # equal contents: equal key, extent and bytes
    left, right = r.anchor - r.lo, r.hi + LENGTH - (r.anchor + K)
    ids = c.ids[r.doc]
    view = memoryview(c.buf)
    seen: dict = {}
    content = np.empty(len(r.key), np.int64)
    first: list[int] = []
    for i, (lo, hi, l, doc) in enumerate(zip(r.lo.tolist(), r.hi.tolist(), left.tolist(), ids.tolist())):
        k = (l, view[lo:hi + LENGTH].tobytes())
        j = seen.setdefault(k, len(first))
        if j == len(first):
            first.append(i)
        elif doc < ids[first[j]]:
            first[j] = i
        content[i] = j
    return r, np.array(first, np.int64), content, np.column_stack([left, right]) if len(left) else np.empty((0, 2), np.int64)


class Contents:
    """Distinct contents of a chunk's shared runs: anchor's key, smallest
    document, lengths of left and right, and the bytes one after the other."""

    def __init__(self, chunk, key, doc, sides, pieces: bytes):
        self.chunk, self.key, self.doc, self.sides, self.pieces = chunk, key, doc, sides, pieces

        self.ends = np.concatenate([[0], np.cumsum(sides.sum(axis=1, dtype=np.int64) + K)])

    def take(self, at: np.ndarray) -> "Contents":
        view = memoryview(self.pieces)
        pieces = b"".join([view[a:b] for a, b in zip(self.ends[at].tolist(), self.ends[at + 1].tolist())])
        return Contents(self.chunk[at], self.key[at], self.doc[at], self.sides[at], pieces)

    def between(self, a: int, b: int) -> "Contents":
        return Contents(self.chunk[a:b], self.key[a:b], self.doc[a:b], self.sides[a:b], self.pieces[self.ends[a]:self.ends[b]])

    def pack(self) -> bytes:
        begin = np.flatnonzero(np.diff(self.chunk, prepend=-1))
        return _blob(self.chunk[begin].astype("<i8"), begin.astype("<i8"), self.key.astype("<u8"), self.doc.astype("<i8"),
                     self.sides.astype(np.uint8), self.pieces)

    @staticmethod
    def unpack(data: bytes) -> "Contents":
        chunk, begin, key, doc, sides, pieces = _unblob(data)
        begin, key = np.frombuffer(begin, "<i8"), np.frombuffer(key, "<u8")
        return Contents(np.repeat(np.frombuffer(chunk, "<i8"), np.diff(begin, append=len(key))), key,
                        np.frombuffer(doc, "<i8"), np.frombuffer(sides, np.uint8).reshape(-1, 2), pieces)

    @staticmethod
    def join(parts: list["Contents"]) -> "Contents":
        return Contents(*[np.concatenate([getattr(p, c) for p in parts]) for c in ("chunk", "key", "doc", "sides")],
                        b"".join([p.pieces for p in parts]))


def _send_runs(shards: Shards):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (chunk,), rows in _by_key(batches, "chunk"):
            c = Chunk(next(x["data"] for x in rows if x["kind"] == DOCS))
            r, first, _, sides = _shared_runs(c, rows)
            if not len(first):
                continue
            first = first[np.argsort(shards.of(r.key[first], 1), kind="stable")]
            pieces = b"".join([c.buf[a:b] for a, b in zip(r.lo[first].tolist(), (r.hi[first] + LENGTH).tolist())])
            yield _rows(_split(Contents(np.full(len(first), chunk, np.int64), r.key[first], c.ids[r.doc[first]],
                                        sides[first].astype(np.uint8), pieces), shards, 1, MASKS))
    return run


def _matrix(strings: list[bytes]) -> np.ndarray:
    """Bytes + 1 of each string in a row, padded with 0 to SIDE."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    out = np.zeros((len(strings), SIDE), np.int16)
    out[np.arange(SIDE) < lengths[:, None]] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1
    return out


def _symbols(strings: np.ndarray) -> np.ndarray:
    """Rows of bytes + 1 (0: none) as numbers of ``BLOCK`` bytes each, whose
    order is that of the bytes."""
    wide = np.zeros((len(strings), -(-SIDE // BLOCK) * BLOCK), np.uint64)
    wide[:, :SIDE] = strings
    weights = np.array([257 ** (BLOCK - 1 - i) for i in range(BLOCK)], np.uint64)
    return (wide.reshape(len(strings), -1, BLOCK) * weights).sum(axis=2, dtype=np.uint64)


def _ranks(strings: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The place of each row (of one group, among those) in the order of the
    suffixes of all rows together, each row one stretch of symbols and a 0 that
    is smaller than any."""
    symbols = _symbols(strings)
    blocks = (symbols > 0).sum(axis=1)
    rank = np.empty(len(strings), np.int64)
    # as many groups at a time as the bound allows; a group is never cut
    last = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
    total = np.cumsum(blocks + 1)
    begin = 0
    while begin < len(strings):
        reach = total[begin - 1] + SORT_SYMBOLS if begin else SORT_SYMBOLS
        end = int(last[np.searchsorted(last, max(int(np.searchsorted(total, reach)), begin + 1))])
        part = slice(begin, end)
        text = symbols[part][np.arange(symbols.shape[1]) < blocks[part, None]]
        heads = np.cumsum(blocks[part] + 1) - (blocks[part] + 1)
        joined = np.insert(np.unique(text, return_inverse=True)[1] + 1, np.cumsum(blocks[part]), 0)
        place = np.empty(len(joined), np.int64)
        place[np.array(suffix_array(joined.tolist()), np.int64)] = np.arange(len(joined))
        rank[part] = place[heads]
        begin = end
    return rank


def _depth_classes(group: np.ndarray, sides: list[bytes]) -> np.ndarray:
    """For each row the class of its side up to every depth 0..SIDE: rows of one
    group (groups ascend) have equal classes at a depth iff their sides agree up
    to it. Sides that agree are neighbours in the order of the suffix array, so
    the common prefixes of neighbours tell all."""
    seen: dict = {}
    named = np.array([seen.setdefault((g, s), len(seen)) for g, s in zip(group.tolist(), sides)], np.int64)
    groups = np.array([g for g, _ in seen], np.int64)
    strings = _matrix([s for _, s in seen])
    rank = np.arange(len(groups))
    # two sides are neighbours in any order
    many = np.bincount(groups)[groups] > 2
    if many.any():
        rank[many] = _ranks(strings[many], groups[many])
    order = np.lexsort((rank, groups))
    ordered, g = strings[order], groups[order]
    same = np.full(len(order), -1, np.int64)               # common prefix with the one before, -1 across groups
    if len(order) > 1:
        equal = (ordered[1:] == ordered[:-1]) & (ordered[1:] > 0)
        agree = np.where(equal.all(axis=1), SIDE, equal.argmin(axis=1))
        same[1:] = np.where(g[1:] == g[:-1], agree, -1)
    classes = np.cumsum(same[:, None] < np.arange(SIDE + 1), axis=0, dtype=np.int32)
    out = np.empty((len(order), SIDE + 1), np.int32)
    out[order] = classes
    return out[named]


def _string_masks(group: np.ndarray, doc: np.ndarray, sides: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """For distinct contents (groups ascend) the strings that a smaller document has."""
    left, right = sides[:, 0].astype(np.int64), sides[:, 1].astype(np.int64)
    at_left = _depth_classes(group, [t[:a][::-1] for t, a in zip(texts, left.tolist())])
    at_right = _depth_classes(group, [t[a + K:] for t, a in zip(texts, left.tolist())])
    masks = np.zeros(len(group), np.uint64)
    for o in range(SPAN):
        rows = np.flatnonzero((left >= o) & (right >= SIDE - o))
        if not len(rows):
            continue
        pair = at_left[rows, o].astype(np.int64) << 32 | at_right[rows, SIDE - o]
        order = np.argsort(pair, kind="stable")
        p, d = pair[order], doc[rows[order]]
        begin = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        least = np.repeat(np.minimum.reduceat(d, begin), np.diff(begin, append=len(p)))
        masks[rows[order]] |= (least < d).astype(np.uint64) << np.uint64(o)
    return masks


def _all_strings(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A bit for every string of each run."""
    one, low = np.uint64(1), np.maximum(SIDE - right, 0).astype(np.uint64)
    return (one << (left.astype(np.uint64) + one)) - (one << low)


def match_masks(key: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray, pieces: bytes) -> np.ndarray:
    """For runs (anchor key, document, lengths of left and right, bytes one
    after the other) the strings that a smaller document has: bit ``o`` for the
    string in which the anchor is at ``o``."""
    ends = np.cumsum(left + K + right)
    # equal contents are one, with the smallest of their documents
    seen: dict = {}
    view, begin = memoryview(pieces), 0
    named = np.empty(len(key), np.int64)
    for i, (k, a, end) in enumerate(zip(key.tolist(), left.tolist(), ends.tolist())):
        named[i] = seen.setdefault((k, a, view[begin:end].tobytes()), len(seen))
        begin = end
    least = np.full(len(seen), np.iinfo(np.int64).max)
    np.minimum.at(least, named, doc)
    # equal hashes of different anchors are told apart by their bytes
    anchors: dict = {}
    contents = list(seen)
    group = np.array([anchors.setdefault((k, t[a:a + K]), len(anchors)) for k, a, t in contents], np.int64)
    n = np.bincount(group)
    lowest, highest = np.full(len(n), np.iinfo(np.int64).max), np.full(len(n), np.iinfo(np.int64).min)
    np.minimum.at(lowest, group, least)
    np.maximum.at(highest, group, least)
    # a group of one content, or of one document, says nothing more
    open_ = np.flatnonzero((n > 1)[group] & (lowest < highest)[group])
    open_ = open_[np.argsort(group[open_], kind="stable")]
    masks = np.zeros(len(contents), np.uint64)
    if len(open_):
        picked = [contents[i] for i in open_.tolist()]
        sides = np.array([(a, len(t) - a - K) for _, a, t in picked], np.int64)
        masks[open_] = _string_masks(group[open_], least[open_], sides, [t for _, _, t in picked])
    return np.where(doc > least[named], _all_strings(left, right), masks[named])


def _answer_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (part,), rows in _by_key(batches, "part"):
        sent = Contents.join([Contents.unpack(x["data"]) for x in rows])
        masks = match_masks(sent.key, sent.doc, sent.sides[:, 0].astype(np.int64), sent.sides[:, 1].astype(np.int64), sent.pieces)
        order = np.argsort(sent.chunk, kind="stable")       # the order within a chunk stays
        chunk, masks = sent.chunk[order], masks[order].astype("<u8")
        begin = np.flatnonzero(np.diff(chunk, prepend=-1))
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(chunk)]):
            yield _rows([(int(chunk[a]), MASKS, part, b - a, _blob(masks[a:b]))])


def _removed(c: Chunk, rows: list[dict], shards: Shards) -> np.ndarray:
    """Per byte of the chunk: removed or not."""
    r, first, content, _ = _shared_runs(c, rows)
    cover = np.zeros(len(c.buf) + 1, np.int32)
    if not len(first):
        return cover[:-1].astype(bool)
    part = shards.last(r.key[first])
    masks = np.zeros(len(first), np.uint64)
    for x in rows:
        if x["kind"] == MASKS:
            masks[part == x["part"]] = np.frombuffer(_unblob(x["data"])[0], "<u8")
    least = c.ids[r.doc[first]][content]
    # a copy in a larger document of this chunk: all strings are in the smaller one
    mask = np.where(c.ids[r.doc] > least, ~np.uint64(0), masks[content])
    some = mask > 0
    mask, anchor, lo, hi = mask[some], r.anchor[some], r.lo[some], r.hi[some]
    # every string starts in one run, so a place is hit once
    for o in range(SPAN):
        s = anchor - o
        hit = s[((mask >> np.uint64(o)) & np.uint64(1)).astype(bool) & (s >= lo) & (s <= hi)]
        cover[hit] += 1
        cover[hit + LENGTH] -= 1
    return np.cumsum(cover)[:-1] > 0


def _digest(shards: Shards):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_key(batches, "chunk"):
            c = Chunk(next(x["data"] for x in rows if x["kind"] == DOCS))
            gone = _removed(c, rows, shards)
            buf = np.frombuffer(c.buf, np.uint8)
            out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")}
            starts = np.concatenate([[0], c.ends[:-1]])
            for a, b in zip(starts.tolist(), c.ends.tolist()):
                g = gone[a:b]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], g, [0]]).astype(np.int8)))
                out["n_bytes"].append(b - a)
                out["n_removed"].append(int(g.sum()))
                out["n_spans"].append(len(edges) // 2)
                out["kept_sha256"].append(hashlib.sha256(buf[a:b][~g].tobytes()).hexdigest())
                out["removed"].append(edges.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.ids, mask=c.null), *[pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")],
                 pa.array(out["kept_sha256"], pa.string()), pa.array(out["removed"], pa.binary())],
                names=["doc_id", *out])
    return run


def dedup_substrings(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` per
    document; ``removed``: start and end (int64, in bytes) of each removed span."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    chunks = written(spark, rows.mapInArrow(_pack(chunk_bytes), ROW_SCHEMA), "dedup-chunks")
    # as many shards as chunks need, so a shard grows no faster than a chunk's share of anchors
    n_chunks = chunks.count()
    shards = Shards(max(1, n_chunks // CHUNKS_PER_SHARD), fan)

    def by(df: DataFrame, column: str) -> DataFrame:
        return df.repartition(column).sortWithinPartitions(column, "kind", "chunk", "part")

    keys = by(route(chunks.mapInArrow(_send_keys(shards), ROW_SCHEMA), shards, SHARED, n_chunks), "part")
    shared = written(spark, keys.mapInArrow(_answer_keys, ROW_SCHEMA), "dedup-shared")
    runs = by(chunks.unionByName(shared), "chunk").mapInArrow(_send_runs(shards), ROW_SCHEMA)
    runs = by(route(runs, shards, MASKS, n_chunks), "part")
    masks = written(spark, runs.mapInArrow(_answer_runs, ROW_SCHEMA), "dedup-masks")
    return by(chunks.unionByName(shared).unionByName(masks), "chunk").mapInArrow(_digest(shards), DIGEST_SCHEMA)
