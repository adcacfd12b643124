"""Brute-force versions and a small awkward table for the operators' tests."""

from __future__ import annotations

import hashlib
import random

import numpy as np

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators use inside
          "score double, size long, fp long, sketch string, chunk string, held string, w string, key string, "
          "copies long, tie long, kind int, target double")


def prose(rng: random.Random, n: int, words: int = 60) -> str:
    return " ".join(f"{rng.choice('abcdefgh')}{rng.choice(['or', 'en', 'ti', 'ash'])}{rng.randrange(words)}"
                    for _ in range(n))


def awkward_rows(seed: int = 3) -> list[tuple]:
    """Null and empty texts and ids, repeated rows and ids, copies, near copies,
    shared passages, control characters and one very long text."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    passage = prose(rng, 70, 5000)
    texts = [base, base, base + " end", base.replace("or1", "zz1", 1), base.upper(), "", None, " \t\n ", "one", "a b", "a b c",
             "x" * 200, "#" * 300 + "é", "ÄÖ ß " + passage, passage, "pre " + passage + " post", "\x00\x0b\x1c é z",
             prose(rng, 20_000), "password = hunter2hunter2 token: abc", "日本語 テキスト 🎉🎉 " * 30]
    texts += [prose(rng, rng.randrange(3, 90)) for _ in range(40)]
    rows = [(i * 7 % 61, t, "en", [None, "s0", "s0", "s0", "s1", "é"][i % 6]) for i, t in enumerate(texts)]
    rows += [(None, base, None, None), (None, "unique null id text " + passage, "en", "s1"), rows[0], rows[0], rows[13],
             (rows[1][0], "another text with the same id", "fr", "s0")]
    return [(*r, None if r[1] is None else len(r[1]), 0.5, 1, 2, "s", "c", "h", "w", "k", 9, 8, 7, 1.5) for r in rows]


def awkward_docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def kept_bytes(rows: list[tuple[int | None, str | None]], length: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of substring removal."""
    first: dict[bytes, int] = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1) if i is not None else ():
            w = b[s:s + length]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        m = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1) if i is not None else ():
            if first[b[s:s + length]] < i:
                m[s] += 1
                m[s + length] -= 1
        g = np.cumsum(m)[:-1] > 0
        e = np.flatnonzero(np.diff(np.concatenate([[0], g, [0]]).astype(int)))
        out.append((i, len(b), int(g.sum()), len(e) // 2, sha(np.frombuffer(b, np.uint8)[~g].tobytes())))
    return out


def simhash(text: str | None) -> int:
    import xxhash
    w = words(text)
    s = [b" ".join(w[j:j + 4]) for j in range(len(w) - 3)] if len(w) >= 4 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def hamming_components(fps: dict[int, set], bits: int = 4) -> dict[int, int]:
    """Smallest id reachable, by fingerprint; ``fps``: ids of each fingerprint."""
    keys = list(fps)
    up = {k: k for k in keys}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                up[find(a)] = find(b)
    low: dict = {}
    for k in keys:
        ids = [x for x in fps[k] if x is not None]
        if ids:
            low[find(k)] = min([*ids, low.get(find(k), min(ids))])
    return {k: low.get(find(k)) for k in keys}


def key(row):
    """Sorts rows that hold None."""
    return [(v is not None, v if v is not None else 0) if not isinstance(v, str) else (True, v) for v in row]
