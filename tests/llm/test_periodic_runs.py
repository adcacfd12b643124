"""Lyndon arrays, runs and their collapse against brute force."""

import random
import zlib

import pytest
from helpers import SCHEMA, awkward_docs, awkward_rows, key, no_docs, sha
from hypothesis import given, settings
from hypothesis import strategies as st

from txprep.llm.lyndon import lyndon_arrays
from txprep.llm.periodic_runs import collapse, find_runs, runs_of
from txprep.llm.queries import _periodic_tail


def longest_lyndon(text):
    """At each place the distance to the next smaller suffix."""
    out = []
    for i in range(len(text)):
        j = i + 1
        while j < len(text) and text[i:] < text[j:]:
            j += 1
        out.append(j - i)
    return out


def all_runs(words, least=24):
    """Every stretch of equal words p apart, for all p that are smallest periods."""
    n, out = len(words), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            size = j - i + p
            smaller = any(all(words[x] == words[x + q] for x in range(i, i + size - q)) for q in range(1, p))
            if size >= max(least, 3 * p) and not smaller:
                out.append((i, size, p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng):
    words = []
    for _ in range(rng.randrange(1, 8)):
        if rng.random() < 0.6:
            period = [b"%d" % rng.randrange(4) for _ in range(rng.randrange(1, 14))]
            words += (period * 40)[:rng.randrange(1, 90)]
        else:
            words += [b"%d" % rng.randrange(6) for _ in range(rng.randrange(1, 10))]
    return words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_lyndon_arrays(text):
    assert lyndon_arrays(text) == (longest_lyndon(text), longest_lyndon([9 - c for c in text]))


@pytest.mark.parametrize("least", [9, 24])
def test_runs_equal_all_pairs_of_places(least):
    rng = random.Random(least)
    for _ in range(250):
        words = periodic_words(rng)
        assert runs_of(words, least) == all_runs(words, least)


def test_runs_need_the_lyndon_arrays(monkeypatch):
    from txprep.llm import periodic_runs
    words = [b"a", b"b", b"c"] * 10
    assert runs_of(words) == [(0, 30, 3)]
    monkeypatch.setattr(periodic_runs, "lyndon_arrays", lambda text: ([1] * len(text),) * 2)
    assert runs_of(words) == []


def test_long_run_in_long_text():
    rng = random.Random(5)
    noise = [b"n%d" % i for i in range(10_000)]
    period = [b"p%d" % rng.randrange(300) for _ in range(2_000)]
    words = noise + period * 10 + [b"end"]
    assert runs_of(words) == [(10_000, 20_000, 2_000)]
    assert len(collapse(words, runs_of(words))) == 12_001


def expected(doc_id, text):
    words = _periodic_tail(doc_id, (text or "").encode().split())
    runs = all_runs(words) if len(words) < 5_000 else runs_of(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


def test_query_equals_brute_force(spark, tmp):
    from txprep.llm.queries import QUERIES
    docs = awkward_docs(spark)
    docs.write.parquet(f"{tmp}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, tmp).collect()
    want = [expected(r[0], r[1]) for r in awkward_rows()]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert any(r["n_runs"] for r in got)


def test_tail_is_a_tenth_of_the_documents():
    words = [b"w%d" % i for i in range(50)]
    changed = [i for i in range(1000) if _periodic_tail(i, words) != words]
    assert changed and all(zlib.crc32(str(i).encode()) % 10 == 0 for i in changed)
    assert _periodic_tail(None, words) == words
    assert _periodic_tail(changed[0], []) == []


def test_general_interface_ties_and_empty(spark):
    rows = [(1, "x y z " * 20 + "q " + "a b c " * 20), (1, "x y z " * 20 + "q " + "a b c " * 20), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(find_runs(docs).collect(), key=lambda r: r["n_words"])
    assert (out[0]["doc_id"], out[0]["n_words"], out[0]["runs"], out[0]["best"], out[0]["collapsed"]) == (None, 0, [], None, "")
    assert out[1] == out[2] and out[1]["collapsed"] == "x y z q a b c"
    assert [tuple(r) for r in out[1]["runs"]] == [(0, 60, 3), (61, 60, 3)] and tuple(out[1]["best"]) == (0, 60, 3)
    assert find_runs(no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        find_runs(docs, least=8)
    assert "doc_id long" in SCHEMA
