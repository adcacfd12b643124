"""LM scoring with a Brown class bigram model.

``P(w | v) = (1 - u(class v)) P(class w | class v) P(w | class w)``, and ``u`` for
a word that training doesn't know. Transitions are smoothed towards the class's
own frequency, ``u`` is estimated from words seen once, emissions are relative
frequencies within the class; over the vocabulary and the unknown word they sum
to 1.

Classes come from exchange clustering. The ``core`` most frequent words are
exchanged one after the other, each to the class that raises the class bigram
likelihood most, until the likelihood stops rising; that needs the bigrams among ``core``
words, a bounded matrix that Spark sums over the whole corpus. Every other word
then goes, in parallel, to the class that raises the likelihood most given its
neighbours of the core; it is placed once, and neighbours outside the core don't
count for it.

Work is dealt in chunks of documents, each with its own word numbers, so counts
and answers travel once per chunk and word instead of once per token: a word's
rows meet in one task, which sums them to one row of neighbour counts, places the
word and answers every chunk that asked. The most frequent word has one row per
chunk; of those only the chunk's name and the place are kept until it is placed.

Defined results: a null text is empty; an empty text is one end token; a null
``doc_id`` is never held out by a predicate that is null for it; repeated rows
are documents of their own; a very long text is a chunk of its own; without training
tokens every token is unknown and each score is 0; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty, written

CLASSES = 64
CORE = 1024
CHUNK_BYTES = 16 << 20
SMOOTH = 20.0
#: A token's code: its class, with ONCE for words seen once; UNKNOWN stands for any other.
ONCE, UNKNOWN = 128, 127
END = b""                     # the end token: no word is empty

CHUNK_SCHEMA = "chunk string, data binary"
WORD_SCHEMA = "chunk string, place int, word binary, n long, slots binary, counts binary"
ANSWER_SCHEMA = "chunk string, place int, n long, cls int, first boolean"
SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double")


def _blob(*arrays) -> bytes:
    raw = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    body = np.array([len(raw), *map(len, raw)], "<u8").tobytes() + b"".join(raw)
    return np.array([len(body)], "<u8").tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _unblob(blob: bytes) -> list[bytes]:
    body = pa.decompress(blob[8:], int(np.frombuffer(blob, "<u8", 1)[0]), codec="zstd", asbytes=True)
    count = int(np.frombuffer(body, "<u8", 1)[0])
    cuts = 8 * (count + 1) + np.concatenate([[0], np.cumsum(np.frombuffer(body, "<u8", count, 8).astype(int))])
    return [body[a:b] for a, b in zip(cuts, cuts[1:])]


def tokens(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case, and the end token."""
    return [*text.encode().lower().split(), END]     # bytes split at 0x20 and 0x09-0x0D


class Chunk:
    """Documents as numbers of the chunk's own words."""

    def __init__(self, data: bytes):
        ids, null, held, lengths, words, toks = _unblob(data)
        self.ids, self.null = np.frombuffer(ids, "<i8"), np.frombuffer(null, np.uint8).astype(bool)
        self.held, self.lengths = np.frombuffer(held, np.uint8).astype(bool), np.frombuffer(lengths, "<i8")
        self.words = words.split(b"\n")               # no word holds a line end
        self.toks = np.frombuffer(toks, "<i4")

    def train(self) -> tuple[np.ndarray, np.ndarray]:
        """The training tokens, and which of them begin a document."""
        used = np.repeat(~self.held, self.lengths)
        begins = np.zeros(len(self.toks), bool)
        begins[np.cumsum(self.lengths) - self.lengths] = True
        return self.toks[used], begins[used]


def _pack(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, count = TaskContext.get().partitionId(), 0

        def fresh():
            number = defaultdict(itertools.count().__next__)
            number[END]
            return [], [], [], [], number, 0

        def flush():
            data = _blob(np.array([i or 0 for i in ids], "<i8"), np.array([i is None for i in ids], np.uint8),
                         np.array(held, np.uint8), np.array([len(t) for t in toks], "<i8"), b"\n".join(number),
                         np.concatenate(toks))
            return pa.RecordBatch.from_pydict({"chunk": [f"{part}-{count}"], "data": pa.array([data], pa.binary())})

        ids, held, toks, _, number, size = fresh()
        for batch in batches:
            for doc_id, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(),
                                         batch.column("text")):
                text = text.as_py()
                if toks and size + len(text) > chunk_bytes:
                    yield flush()
                    count += 1
                    ids, held, toks, _, number, size = fresh()
                ids.append(doc_id)
                held.append(bool(out))
                toks.append(np.fromiter(map(number.__getitem__, tokens(text)), dtype="<i4"))
                size += len(text)
        if toks:
            yield flush()
    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("data"):
            c = Chunk(data.as_py())
            n = np.bincount(c.train()[0], minlength=len(c.words))
            seen = np.flatnonzero(n)
            for lo in range(0, len(seen), 50_000):
                at = seen[lo:lo + 50_000]
                yield pa.RecordBatch.from_pydict({"word": pa.array([c.words[i] for i in at.tolist()], pa.binary()),
                                                  "n": pa.array(n[at], pa.int64())})


def _core_numbers(c: Chunk, core: dict[bytes, int], other: int) -> np.ndarray:
    return np.array([core.get(w, other) for w in c.words], np.int64)


def _core_bigrams(core: dict[bytes, int]):
    """Rows of the matrix of core bigrams, ``core`` and the two contexts *other
    word* and *start* included, one per chunk and word."""
    k = len(core)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 2) * (k + 2), np.int64)
        for batch in batches:
            for data in batch.column("data"):
                c = Chunk(data.as_py())
                t, begins = c.train()
                if not len(t):
                    continue
                right = _core_numbers(c, core, k)[t]
                left = np.concatenate([[k + 1], right[:-1]])
                left[begins] = k + 1
                total += np.bincount(left * (k + 2) + right, minlength=len(total))
        rows = np.flatnonzero(total.reshape(k + 2, k + 2).any(axis=1))
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(rows, pa.int64()),
            "data": pa.array([pa.compress(total.reshape(k + 2, -1)[r].tobytes(), codec="zstd", asbytes=True)
                              for r in rows], pa.binary())})
    return run


def _sum_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, data in zip(batch.column("row").to_pylist(), batch.column("data").to_pylist()):
                v = np.frombuffer(pa.decompress(data, 8 * width, codec="zstd", asbytes=True), np.int64)
                sums[row] = sums[row] + v if row in sums else v
        yield pa.RecordBatch.from_pydict({"row": pa.array(list(sums), pa.int64()),
                                          "data": pa.array([v.tobytes() for v in sums.values()], pa.binary())})
    return run


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


#: A sweep of the exchange that raises the log-likelihood by less than this share of it is the last.
TOLERANCE = 1e-6


def class_likelihood(table: np.ndarray) -> float:
    """What the class bigram log-likelihood owes to the classes."""
    return float(_f(table).sum() - _f(table.sum(axis=1)).sum() - _f(table.sum(axis=0)).sum())


def exchange(bigrams: np.ndarray, classes: int, tolerance: float = TOLERANCE) -> np.ndarray:
    """Class of each of the first n - 2 words of a bigram matrix, whose last two
    rows are contexts with classes of their own. Words start in the order of
    their frequency, dealt round; each in turn moves to the class that raises
    the class bigram log-likelihood most, until a sweep raises it by less than
    ``tolerance`` of it. No move lowers it, so the sweeps end."""
    b = bigrams.astype(float)
    n = len(b) - 2
    cls = np.concatenate([np.arange(n) % classes, [classes, classes + 1]])
    to = np.eye(classes + 2)[cls]
    table = to.T @ b @ to
    before, now = -np.inf, class_likelihood(table)
    while now - before > tolerance * abs(now):
        before = now
        for w in range(n):
            old = cls[w]
            row, col, own = b[w] @ to, b[:, w] @ to, b[w, w]
            row[old] -= own                             # neighbours other than the word itself
            col[old] -= own
            table[old] -= row
            table[:, old] -= col
            table[old, old] -= own
            # what other classes get from the word's neighbours doesn't depend on its class
            out, into = table.sum(axis=1) + col, table.sum(axis=0) + row
            base = _f(table)
            by_row, by_col = _f(table + row) - base, _f(table + col[:, None]) - base
            d = np.arange(classes + 2)
            both = table[d, d] + row + col + own
            gain = by_row.sum(axis=1) - by_row[d, d] + by_col.sum(axis=0) - by_col[d, d] + _f(both) - base[d, d]
            gain -= _f(out + row.sum() + own) - _f(out) + _f(into + col.sum() + own) - _f(into)
            new = int(np.argmax(gain[:classes]))
            if gain[new] <= gain[old] + 1e-6:
                new = old
            table[new] += row
            table[:, new] += col
            table[new, new] += own
            if new != old:
                cls[w] = new
                to[w, old], to[w, new] = 0.0, 1.0
        now = class_likelihood(table)
    return cls[:n]


def _ask(core: dict[bytes, int], cls: np.ndarray, classes: int):
    """A row per chunk and word: its count and the classes of its neighbours,
    a slot for each class before it and one for each after it."""
    k, width = len(core), classes + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in WORD_SCHEMA.split(", ")]
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("data")):
                c = Chunk(data.as_py())
                t, begins = c.train()
                n = np.bincount(t, minlength=len(c.words)) if len(t) else np.zeros(len(c.words), np.int64)
                number = _core_numbers(c, core, k)
                of = np.concatenate([cls, [classes]])[number]
                pairs = np.empty(0, np.int64)
                if len(t):
                    mine = of[t]
                    before = np.concatenate([[classes + 1], mine[:-1]])
                    before[begins] = classes + 1
                    after = np.concatenate([mine[1:], [classes]])
                    after[np.concatenate([begins[1:], [True]])] = classes
                    rare = number[t] == k
                    pairs = np.concatenate([(t * (2 * width) + before)[rare & (before != classes)],
                                            (t * (2 * width) + width + after)[rare & (after != classes)]])
                found, count = np.unique(pairs, return_counts=True)
                word, slot = found // (2 * width), (found % (2 * width)).astype("<i2")
                cuts = np.searchsorted(word, np.arange(len(c.words) + 1))
                raw_slot, raw_count = slot.tobytes(), count.astype("<i4").tobytes()
                for lo in range(0, len(c.words), 50_000):
                    hi = min(len(c.words), lo + 50_000)
                    edge = cuts[lo:hi + 1].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk] * (hi - lo), pa.string()), pa.array(np.arange(lo, hi), pa.int32()),
                         pa.array(c.words[lo:hi], pa.binary()), pa.array(n[lo:hi], pa.int64()),
                         pa.array([raw_slot[2 * a:2 * b] for a, b in zip(edge, edge[1:])], pa.binary()),
                         pa.array([raw_count[4 * a:4 * b] for a, b in zip(edge, edge[1:])], pa.binary())], names=names)
    return run


def _flat(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset:column.offset + len(column) + 1]
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[offsets[0]:offsets[-1]] if buf is not None else np.empty(0, np.uint8)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(data.tobytes(), dtype), np.diff(offsets) // size


#: Neighbour counts up to this are looked up, larger ones computed.
TABLED = 32


class Placement:
    """The class that raises the class bigram likelihood most for a word outside
    the core, given counts of the classes before and after it (slots). Class
    totals are taken without the word's own neighbours, which are few to them."""

    def __init__(self, table: np.ndarray):
        self.table, self.classes = table, len(table) - 2
        # slot v: class v comes before, so column counts grow; slot width + v: class v comes after
        self.cells = np.concatenate([table[:, :self.classes], table[:self.classes].T]).astype(float)
        self.out, self.into = table.sum(axis=1)[:self.classes], table.sum(axis=0)[:self.classes]
        self.known = np.stack([self._cell(np.arange(len(self.cells)), np.full(len(self.cells), float(c))) for c in range(TABLED + 1)])
        self.common = int(np.argmax(self.into)) if self.classes else 0

    def _cell(self, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
        now = self.cells[slots]
        return _f(now + counts[:, None]) - _f(now)

    def gains(self, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What each (slot, count) adds to a word's gain, per class."""
        out = self.known[np.minimum(counts, TABLED), slots]
        large = np.flatnonzero(counts > TABLED)
        out[large] = self._cell(slots[large], counts[large].astype(float))
        return out

    def choose(self, gain: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The best class of words with summed ``gain``; ``before`` and ``after``
        are their neighbours in all. Words without any go to the commonest class."""
        if not self.classes:
            return np.zeros(len(gain), np.int64)
        margins = _f(self.into + before[:, None]) - _f(self.into) + _f(self.out + after[:, None]) - _f(self.out)
        best = np.argmax(gain - margins, axis=1)
        return np.where(before + after > 0, best, self.common)


def _answer(core: dict[bytes, int], cls: np.ndarray, table: np.ndarray):
    """Place every word (rows come sorted by word) and answer each row."""
    classes = len(table) - 2
    width = classes + 2
    placement = Placement(table)

    def sums(word: np.ndarray, n_words: int, slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (word, slot) with their counts, from many chunks."""
        pair = word * (2 * width) + slots
        found, at = np.unique(pair, return_inverse=True)
        return found // (2 * width), found % (2 * width), np.bincount(at, weights=counts, minlength=len(found)).astype(np.int64)

    def chosen(names: list[bytes], word: np.ndarray, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
        gain = np.zeros((len(names), classes))
        for lo in range(0, len(slots), 100_000):
            s = slice(lo, lo + 100_000)
            w = word[s]                                  # ascending
            cut = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            gain[w[cut]] += np.add.reduceat(placement.gains(slots[s], counts[s]), cut, axis=0)
        sides = [np.bincount(word[side], weights=counts[side], minlength=len(names)) for side in (slots < width, slots >= width)]
        out = placement.choose(gain, *sides)
        for i, w in enumerate(names):
            if w in core:
                out[i] = cls[core[w]]
        return out

    def answers(batch: pa.RecordBatch, n: np.ndarray, at: np.ndarray, of: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("place"), pa.array(n[at]),
                                           pa.array(of[at], pa.int32()), pa.array(first)], names=["chunk", "place", "n", "cls", "first"])

    def numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slots, per_row = _flat(batch.column("slots"), "<i2")
        return per_row, slots.astype(np.int64), _flat(batch.column("counts"), "<i4")[0].astype(np.int64)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Answers to rows of words that are whole in ``batch``."""
        words = batch.column("word").dictionary_encode()
        at, names = words.indices.to_numpy(zero_copy_only=False), words.dictionary.to_pylist()
        total = np.bincount(at, weights=batch.column("n").to_numpy(), minlength=len(names)).astype(np.int64)
        per_row, slots, counts = numbers(batch)
        of = chosen(names, *sums(np.repeat(at, per_row).astype(np.int64), len(names), slots, counts))
        return answers(batch, total, at, of, np.concatenate([[True], at[1:] != at[:-1]]) & (total[at] > 0))

    class Long:
        """A word whose rows fill whole batches: its sums, and whom to answer."""

        def __init__(self, word: bytes):
            self.word, self.n, self.slots, self.rows = word, 0, np.zeros(2 * width, np.int64), []

        def add(self, batch: pa.RecordBatch) -> None:
            _, slots, counts = numbers(batch)
            self.n += int(batch.column("n").to_numpy().sum())
            self.slots += np.bincount(slots, weights=counts, minlength=2 * width).astype(np.int64)
            self.rows.append(batch.select(["chunk", "place"]))

        def answer(self) -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(self.slots)
            of = chosen([self.word], np.zeros(len(at), np.int64), at, self.slots[at])
            for i, rows in enumerate(self.rows):
                none = np.zeros(rows.num_rows, np.int64)
                first = np.zeros(rows.num_rows, bool)
                first[0] = i == 0 and self.n > 0
                yield answers(rows, np.array([self.n]), none, of, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Long | None = None                        # the word that the batches so far ended with
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column("word")
            a, last = 0, word[batch.num_rows - 1].as_py()
            if held is not None:
                while a < batch.num_rows and word[a].as_py() == held.word:
                    a += 1
                if a:
                    held.add(batch.slice(0, a))
                if a == batch.num_rows:
                    continue
                yield from held.answer()
            b = batch.num_rows - 1                      # where the last word's rows begin
            while b > a and word[b - 1].as_py() == last:
                b -= 1
            if b > a:
                yield place(batch.slice(a, b - a))
            held = Long(last)
            held.add(batch.slice(b))
        if held is not None:
            yield from held.answer()
    return run


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks as codes of tokens, with what each document's scores need.
    Rows come sorted: a chunk, then the answers to its words in order."""
    def coded(name: str, data: bytes, n: np.ndarray, cls: np.ndarray) -> pa.RecordBatch:
        c = Chunk(data)
        code = np.where(n == 0, UNKNOWN, cls | np.where(n == 1, ONCE, 0)).astype(np.uint8)
        begin = np.cumsum(c.lengths) - c.lengths

        def per_doc(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x[c.toks], begin)
        known = per_doc((n > 0).astype(np.int64))
        blob = _blob(c.ids, c.null.astype(np.uint8), c.held.astype(np.uint8), c.lengths, known.astype("<i8"),
                     per_doc(np.log10(n + 1.0)).astype("<f8"), per_doc(np.log10(np.maximum(n, 1))).astype("<f8"),
                     code[c.toks])
        return pa.RecordBatch.from_pydict({"chunk": [name], "data": pa.array([blob], pa.binary())})

    name, data, ns, cs = None, None, [], []
    for batch in batches:
        heads = np.append(np.flatnonzero(batch.column("place").to_numpy() < 0), batch.num_rows)
        lo = 0
        for head in heads.tolist():
            part = batch.slice(lo, head - lo)
            ns.append(part.column("n").to_numpy())
            cs.append(part.column("cls").to_numpy())
            if head < batch.num_rows:
                if data is not None:
                    yield coded(name, data, np.concatenate(ns), np.concatenate(cs))
                name, data, ns, cs = batch.column("chunk")[head].as_py(), batch.column("data")[head].as_py(), [], []
            lo = head + 1
    if data is not None:
        yield coded(name, data, np.concatenate(ns), np.concatenate(cs))


class Coded:
    def __init__(self, data: bytes, classes: int):
        ids, null, held, lengths, known, plus, words, code = _unblob(data)
        self.ids, self.null = np.frombuffer(ids, "<i8"), np.frombuffer(null, np.uint8).astype(bool)
        self.held, self.lengths = np.frombuffer(held, np.uint8).astype(bool), np.frombuffer(lengths, "<i8")
        self.known, self.plus, self.words = np.frombuffer(known, "<i8"), np.frombuffer(plus), np.frombuffer(words)
        code = np.frombuffer(code, np.uint8)
        self.unknown, self.once = code == UNKNOWN, (code & ONCE) > 0
        self.cls = np.where(self.unknown, classes + 1, code & (ONCE - 1)).astype(np.int64)
        self.begin = np.cumsum(self.lengths) - self.lengths
        self.before = np.concatenate([[classes], self.cls[:-1]])      # the class of the token before
        self.before[self.begin] = classes


def _transitions(classes: int):
    """Counts of (before, class) over training tokens; words seen once also
    count as unknown: after ``before`` (class ``classes + 1``) and before it."""
    width = classes + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            for data in batch.column("data"):
                c = Coded(data.as_py(), classes)
                used = np.repeat(~c.held, c.lengths)
                total += np.bincount((c.before * width + c.cls)[used], minlength=len(total))
                total += np.bincount((c.before * width + width - 1)[used & c.once], minlength=len(total))
                follows = np.concatenate([[False], c.once[:-1]])
                follows[c.begin] = False
                total += np.bincount(((width - 1) * width + c.cls)[used & follows], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})
    return run


@dataclass
class Model:
    """Tables of log10 probabilities: ``step[before, class]`` with the unknown
    word as the last class, and ``size[class]``."""

    step: np.ndarray
    size: np.ndarray
    train_tokens: int
    vocabulary: int

    @classmethod
    def fit(cls, counts: np.ndarray, vocabulary: int, smooth: float = SMOOTH) -> Model:
        """From (before, class) counts as ``_transitions`` makes them."""
        classes = len(counts) - 2
        real = counts[:classes + 1, :classes].astype(float)       # not the rows and columns of words seen once
        size = real.sum(axis=0)
        total = size.sum()
        if total == 0:
            return cls(np.zeros(counts.shape), np.zeros(classes), 0, 0)
        prior = size / total
        rows = counts[:, :classes].astype(float)
        seen = rows.sum(axis=1, keepdims=True)
        step = (rows + smooth * prior) / (seen + smooth)
        once = counts[:, classes + 1].astype(float)
        # after an unknown word: as after any
        once[classes + 1] = seen[classes + 1, 0] * once[:classes + 1].sum() / total
        new = (once + smooth * max(once[:classes + 1].sum(), 1.0) / total) / (seen[:, 0] + smooth)
        new = np.clip(new, 1e-9, 0.999)
        table = np.concatenate([step * (1 - new)[:, None], np.zeros((len(counts), 1)), new[:, None]], axis=1)
        return cls(np.log10(np.maximum(table, 1e-300)), size, int(total), vocabulary)


def _score(model: Model, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.concatenate([np.log10(np.maximum(model.size, 1.0)), [0.0, 0.0]])
        for batch in batches:
            for data in batch.column("data"):
                c = Coded(data.as_py(), classes)
                steps = model.step[c.before, c.cls] - np.where(c.unknown, 0.0, size[c.cls])
                score = np.add.reduceat(steps, c.begin) + c.words
                base = c.plus - c.lengths * np.log10(model.train_tokens + model.vocabulary + 1.0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.ids, mask=c.null), pa.array(c.held), pa.array(c.lengths), pa.array(c.known),
                     pa.array(np.full(len(c.ids), model.train_tokens)), pa.array(base), pa.array(score)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score_documents(spark: SparkSession, docs: DataFrame, held_out: Column, classes: int = CLASSES, core: int = CORE,
                    id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Train on the rows where ``held_out`` isn't true, score all: ``doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score``; perplexity is
    ``10 ** (-score / n_tokens)``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       text_or_empty(text_col).alias("text"))
    chunks = written(spark, rows.mapInArrow(_pack(chunk_bytes), CHUNK_SCHEMA), "lm-chunks")
    words = chunks.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = [bytes(r["word"]) for r in words.orderBy(F.desc("n"), "word").limit(core).collect()]
    number = {w: i for i, w in enumerate(top)}
    classes = max(1, min(classes, len(top)))
    k = len(top) + 2
    summed = chunks.mapInArrow(_core_bigrams(number), "row long, data binary").repartition("row") \
        .mapInArrow(_sum_rows(k), "row long, data binary").collect()
    bigrams = np.zeros((k, k))
    for r in summed:
        bigrams[r["row"]] = np.frombuffer(r["data"], np.int64)
    cls = exchange(bigrams, classes) if top else np.empty(0, np.int64)
    to = np.eye(classes + 2)[np.concatenate([cls, [classes, classes + 1]]).astype(int)]
    asked = chunks.mapInArrow(_ask(number, cls, classes), WORD_SCHEMA).repartition("word").sortWithinPartitions("word")
    answers = written(spark, asked.mapInArrow(_answer(number, cls, to.T @ bigrams @ to), ANSWER_SCHEMA), "lm-answers")
    vocabulary = answers.filter("first").count()
    none = F.lit(None)
    both = chunks.select("chunk", F.lit(-1).alias("place"), none.cast("long").alias("n"), none.cast("int").alias("cls"),
                         "data").unionByName(answers.select("chunk", "place", "n", "cls", none.cast("binary").alias("data")))
    # a row without answers has none to give: numbers stand in for nulls
    both = both.withColumns({"n": F.coalesce("n", F.lit(0)), "cls": F.coalesce("cls", F.lit(0))})
    coded = written(spark, both.repartition("chunk").sortWithinPartitions("chunk", "place")
                    .mapInArrow(_code, CHUNK_SCHEMA), "lm-coded")
    cells = coded.mapInArrow(_transitions(classes), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = np.zeros((classes + 2) * (classes + 2), np.int64)
    for r in cells.collect():                                 # at most (classes + 2) squared
        counts[r["cell"]] = r["n"]
    model = Model.fit(counts.reshape(classes + 2, classes + 2), vocabulary)
    return coded.mapInArrow(_score(model, classes), SCORE_SCHEMA)
