import random

import numpy as np
import pytest
from helpers import awkward_docs, kept_bytes, key, no_docs

from txprep.llm import suffix_dedup
from txprep.llm.suffix_dedup import K, LENGTH, Shards, _send_keys, dedup_substrings, match_masks, suffix_array


def test_suffix_array_equals_sorting():
    rng = random.Random(5)
    for _ in range(800):
        x = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(45))]
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])
    assert suffix_array(b"") == [] and suffix_array(b"a" * 500) == list(range(499, -1, -1))


@pytest.mark.parametrize("chunk_bytes, fan", [(2_000, 128), (1_000, 3), (4 << 20, 128)])
def test_removed_bytes_equal_brute_force(spark, chunk_bytes, fan):
    docs = awkward_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = dedup_substrings(spark, docs.repartition(3), chunk_bytes=chunk_bytes, fan=fan) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    want = kept_bytes(rows)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r[2] for r in want) > 1000


def test_empty_table(spark):
    assert dedup_substrings(spark, no_docs(spark)).count() == 0


def test_equal_hashes_of_different_anchors_are_told_apart():
    a, b = b"a" * 50, b"b" * 50
    pieces = np.frombuffer(a + b + a, np.uint8)
    sides = np.full(3, 10), np.full(3, 24)
    masks = match_masks(np.zeros(3, "<u8"), np.array([1, 2, 3]), *sides, pieces)
    assert masks.tolist() == [0, 0, 1 << 10]


def shared_passages(seed):
    """Runs (key, document, left, right, bytes) of one anchor in several texts."""
    rng = random.Random(seed)
    anchor = b"ANCHOR_ANCHOR_16"
    stems = [bytes(rng.choice(b"ab") for _ in range(34)) for _ in range(3)]
    rows = []
    for d in range(40):
        left, right = rng.randrange(10, 35), rng.randrange(24, 35)
        a, b = bytearray(rng.choice(stems)[-left:]), bytearray(rng.choice(stems)[:right])
        if rng.random() < 0.5:
            a[rng.randrange(len(a))] = b[rng.randrange(len(b))] = 99
        rows.append((rng.randrange(30), left, right, bytes(a) + anchor + bytes(b)))
    return rows


def masks_of(rows):
    return match_masks(np.zeros(len(rows), "<u8"), np.array([r[0] for r in rows]), np.array([r[1] for r in rows]),
                       np.array([r[2] for r in rows]), b"".join(r[3] for r in rows)).tolist()


def masks_by_hand(rows):
    first = {}
    for d, left, right, text in rows:
        for o in range(LENGTH - K - right, left + 1):
            s = (o, text[left - o:left - o + LENGTH])
            first[s] = min(d, first.get(s, d))
    return [sum(1 << o for o in range(LENGTH - K - right, left + 1) if first[o, text[left - o:left - o + LENGTH]] < d)
            for d, left, right, text in rows]


def test_masks_equal_every_string():
    for seed in range(60):
        rows = shared_passages(seed)
        assert masks_of(rows) == masks_by_hand(rows)


def test_masks_need_the_suffix_array(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text: list(range(len(text))))
    assert any(masks_of(shared_passages(seed)) != masks_by_hand(shared_passages(seed)) for seed in range(10))


def test_messages_of_a_chunk_do_not_grow_with_the_corpus():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 123, size=200_000, dtype=np.uint8).tobytes()
    data = suffix_dedup._blob(np.array([1], "<i8"), np.zeros(1, np.uint8), np.array([len(text)], "<i8"), text)
    batch = suffix_dedup._rows([(7, suffix_dedup.DOCS, 0, 1, data)])
    sent = {}
    for chunks in (200, 200_000_000):
        shards = Shards(chunks // 2)
        assert shards.base ** shards.levels >= chunks // 2
        sent[chunks] = sum(b.num_rows for b in _send_keys(shards)(iter([batch])))
    assert max(sent.values()) <= suffix_dedup.FAN
