from collections import defaultdict

import numpy as np
from helpers import awkward_docs, hamming_components, key, no_docs, simhash

from txprep.llm.simhash import components, connect, fingerprint_links, spanning_links


def test_fingerprints_and_components_equal_brute_force(spark):
    docs = awkward_docs(spark)
    rows = [(r.doc_id, simhash(r.text)) for r in docs.select("doc_id", "text").collect()]
    ids = defaultdict(set)
    for i, f in rows:
        ids[f].add(i)
    comp = hamming_components(ids)
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in components(spark, docs).collect()]
    assert sorted(got, key=key) == sorted([(i, f, comp[f]) for i, f in rows], key=key)


def random_fingerprints(n, seed=1):
    """Random ones and chains of near ones around some of them."""
    rng = np.random.default_rng(seed)
    out = list(rng.integers(0, 1 << 63, size=n).tolist())
    for c in out[:20]:
        for _ in range(30):
            for b in rng.integers(0, 64, size=rng.integers(1, 6)):
                c ^= 1 << int(b)
            out.append(c)
    return sorted(set(out))


def test_links_connect_exactly_what_is_near(spark):
    fps = random_fingerprints(400)
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps]
    links = fingerprint_links(spark.createDataFrame(signed, "fp long"), len(fps))
    roots = {r.node % (1 << 64): r.root for r in connect(spark, links).collect()}
    want = hamming_components({f: {i} for i, f in enumerate(fps)})
    groups = defaultdict(set)
    for f in fps:
        groups[roots.get(f, f - (1 << 64) if f >= 1 << 63 else f)].add(want[f])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))


def test_tree_in_a_shard_equals_all_pairs():
    fps = np.array(random_fingerprints(2500, 7), dtype=np.uint64)
    want = hamming_components({int(f): {i} for i, f in enumerate(fps)})
    got = spanning_links(fps, 4)
    assert [want[int(f)] for f in fps] == got.tolist()


def test_empty_table(spark):
    assert components(spark, no_docs(spark)).count() == 0
