"""Fast exact encoding with a byte-level BPE of the ``tokenizers`` library.

A byte-level BPE never merges across the tokens of its pre-tokenizer, and two
kinds of places always lie between two of these: before a space or a line feed
that follows another visible character, and between a letter and a visible ASCII
character that is none. So the bytes of many texts are cut there at once (at
characters whose kind a few bytes tell), Arrow numbers the distinct pieces, each
of them is encoded once by the library and kept in a bounded per-worker cache,
and the pieces' ids are joined.
A text that holds the string of an added token is one piece, for which the
library gives that token's id. The result equals
``encode(text, add_special_tokens=False)`` (tested), for a fraction of the time:
words repeat, and the library's cost is per call and per character.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# other bytes 0, space and line feed 1, visible ASCII 2, letters 3: a cut is where the code falls, but not to 0
_CODE = np.zeros(256, np.uint8)
_CODE[[0x20, 0x0A]] = 1
_CODE[0x21:0x7F] = 2
_CODE[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = 3
# pieces that may be encoded in one string: each starts with its only white space
_WORD = rb"[ \n](?:[!-~]|[\xc3-\xdf].)+"
#: Pieces that the library gets in one string.
LEARN = 250
#: Longer pieces (texts without a cut) are not kept.
MAX_PIECE = 64
#: Bytes of texts that are encoded at once, about.
SLICE = 2 << 20

_WORKER: dict = {}


def load_tokenizer(path: str):
    """The tokenizer of ``path``. One thread: Spark's tasks are the parallelism."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _cuts(raw: np.ndarray) -> np.ndarray:
    """Whether a piece may start at each byte of UTF-8 text, and after the last."""
    code = _CODE[raw]
    cut = np.ones(len(raw) + 1, dtype=bool)
    cut[1:-1] = (code[:-1] > code[1:]) & (code[1:] > 0)
    # the last bytes of other characters; none of these leads has white space, C3's are letters but for two signs
    last = np.flatnonzero((raw[:-1] > 0x7F) & (code[1:] > 0) & (code[1:] < 3))
    byte, two, three = raw[last], raw[np.maximum(last - 1, 0)], raw[np.maximum(last - 2, 0)]
    letter = (two == 0xC3) & (byte != 0x97) & (byte != 0xB7)
    visible = (two >= 0xC3) & (two <= 0xDF) | (three == 0xE0) | (three >= 0xE4) & (three <= 0xEF)
    cut[last + 1] = letter | visible & (code[last + 1] == 1)
    return cut


def _values(array: pa.Array) -> list[bytes]:
    """As ``to_pylist`` of a binary array without nulls, faster."""
    at = np.frombuffer(array.buffers()[1], "<i4", len(array) + 1, 4 * array.offset).tolist()
    data = array.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in zip(at, at[1:])]


class PieceEncoder:
    """``encode_array(texts)`` -> the ids of all texts, and where each starts.

    Pieces are kept in two generations of ``max_entries`` and a slice's pieces at
    most: a full one becomes the old one, and what is found in the old one moves
    on, so frequent pieces stay and memory is bounded."""

    def __init__(self, path: str, max_entries: int = 200_000):
        self.tok = load_tokenizer(path)
        self.vocab_size = self.tok.get_vocab_size()
        self.starts = np.zeros(self.vocab_size, dtype=bool)
        for token, i in self.tok.get_vocab().items():
            self.starts[i] = token.startswith(("Ġ", "Ċ"))      # the byte-level forms of a space and a line feed
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        never = b"".join(rb"(?!.*%s)" % re.escape(a.encode()) for a in self.added)
        self.word = re.compile(never + _WORD, re.DOTALL)
        self.max_entries = max_entries
        self.cache: dict[bytes, bytes] = {}              # piece -> its ids
        self.old: dict[bytes, bytes] = {}

    def _encoded(self, texts: list[bytes]) -> list[np.ndarray]:
        encoded = self.tok.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in encoded]

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """The ids of new pieces: words many at a time, cut again at the ids that
        start with white space, and others one by one."""
        words = list(filter(self.word.fullmatch, pieces))
        found = {}
        for i in range(0, len(words), LEARN):
            part = words[i:i + LEARN]
            ids = self._encoded([b"".join(part)])[0]
            at = np.flatnonzero(self.starts[ids])
            if len(at) != len(part):
                raise ValueError("this tokenizer is not a byte-level BPE with spaces in front of words")
            raw, cuts = ids.tobytes(), (at * 4).tolist()
            cuts.append(len(raw))
            found.update(zip(part, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))
        others = [p for p in pieces if p not in found]
        for i in range(0, len(others), LEARN):
            part = others[i:i + LEARN]
            found.update(zip(part, [ids.tobytes() for ids in self._encoded(part)]))
        return found

    def _look(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, as bytes."""
        if len(self.cache) > self.max_entries:
            self.old, self.cache = self.cache, {}
        out = list(map(self.cache.get, pieces))
        lost = [p for p, ids in zip(pieces, out) if ids is None]
        known = dict(zip(lost, map(self.old.get, lost)))
        known.update(self._learn([p for p, ids in known.items() if ids is None]))
        self.cache.update((p, ids) for p, ids in known.items() if len(p) <= MAX_PIECE)
        return [known[p] if ids is None else ids for p, ids in zip(pieces, out)]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` (strings, no nulls) one after another, and
        the place of each text's first id, with the end of the last."""
        offsets = np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, 4 * texts.offset)
        first, size = int(offsets[0]), int(offsets[-1] - offsets[0])
        if not size:
            return np.empty(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        data = texts.buffers()[2].slice(first, size)
        ends = offsets - first
        cut = _cuts(np.frombuffer(data, np.uint8))
        for a in self.added:
            for i in np.flatnonzero(pc.match_substring(texts, a).to_numpy(zero_copy_only=False)).tolist():
                cut[ends[i]:ends[i + 1]] = False
        cut[ends] = True
        cuts = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype("<i4")), data]) \
            .dictionary_encode()
        number = pieces.indices.to_numpy()
        ids = self._look(_values(pieces.dictionary))
        length = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        n = length[number]
        at = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat(((np.cumsum(length) - length)[number] - at[:-1]).astype(np.int32), n)      # fewer ids than bytes
        place += np.arange(len(place), dtype=np.int32)
        return flat[place], at[np.searchsorted(cuts, ends)]

    def encode_slices(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, in order; about ``SLICE`` bytes are encoded at once."""
        offsets = np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, 4 * texts.offset)
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(offsets, int(offsets[lo]) + SLICE, side="right")) - 1)
            ids, at = self.encode_array(texts.slice(lo, hi - lo))
            at = at.tolist()
            yield from (ids[a:b] for a, b in zip(at, at[1:]))
            lo = hi

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text, as bytes; an empty text has none."""
        return [ids.tobytes() for ids in self.encode_slices(pa.array(texts, pa.string()))]


def worker_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker, reused over its tasks."""
    if path not in _WORKER:
        _WORKER[path] = PieceEncoder(path)
    return _WORKER[path]
