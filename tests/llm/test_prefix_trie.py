"""The prefix trie against dictionaries and the oracle's SQL."""

import random
import zlib

import duckdb
import pytest
from helpers import key, sha

from txprep.llm.prefix_trie import ordered_turns, prefix_trie
from txprep.llm.queries import ORACLES, QUERIES

TURNS = ("conv_id long, turn long, role string, text string, "
         # names that the operator uses inside
         "pos long, name string, words long, node long, block long, parent long, depth long, part int, place long, tie int")


def in_order(rows):
    """Original turns of every conversation, by turn (null first), role and a digest."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda r: sha(f"{len(r[2])}:{r[2]}{r[3]}")
    return {c: [r[2:] for r in sorted(t, key=lambda r: (*r[:3], digest(r)))] for c, t in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def trie(convs):
    """Every node by its sequence of turns, with its members."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for n in nodes:
        if n:
            children.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        words = len(n[-1][1].encode().split()) if n else 0
        below = children.get(n, [])
        leaves[n] = sum(leaves[k] for k in below) or 1
        saved[n] = (len(nodes[n]) - 1) * words + sum(saved[k] for k in below)
    return [(min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
             sha(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(n)))) for n, m in nodes.items()]


def awkward_turns():
    rng = random.Random(8)
    texts = [None, "", "a", "a b", " x\ty\x0bz ", "é ü", "long " * 3_000]
    rows = []
    for c in range(70):
        base = rng.randrange(5)
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, ["user", "assistant"][t % 2], texts[(base * t) % 7] if t < 3 else f"own {rng.randrange(4)}"))
    rows += [(200, None, None, None), (200, 0, "user", "a"), (200, 0, "user", "a"), (200, 0, "user", "b"), (201, 5, None, "a"),
             (None, 0, "user", "a"), (None, None, None, None), (-3, 0, "user", "minus"), (203, 0, "u", "ser a"), (204, 0, "us", "er a")]
    rows += [(300 + i, 0, "user", "same first turn") for i in range(40)] + [(300 + i, 1, "user", f"{i % 30}") for i in range(40)]
    rows += [(621 + i, 0, "user", f"alone {i}") for i in range(9)]                     # their donor does not exist
    rows += [(500, t, "user", f"deep {t}") for t in range(70)] + [(501, t, "user", f"deep {t}") for t in range(66)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2, 3, 4, 5, 6, 7, 8, 9) for r in rows], TURNS)


def test_trie_equals_dictionaries(spark):
    rows = awkward_turns()
    turns = ordered_turns(spark, frame(spark, rows).repartition(6))
    got = prefix_trie(spark, turns, turns.select("conv_id").distinct()).collect()
    assert sorted(map(tuple, got), key=key) == sorted(trie(in_order(rows)), key=key)


def test_query_equals_brute_force(spark, tmp):
    rows = [r for r in awkward_turns() if r[0] is None or r[0] >= 0]
    frame(spark, rows).write.parquet(f"{tmp}/conversations.parquet")
    got = QUERIES["op11_prefix_trie"](spark, tmp).collect()
    want = trie(rebuilt(in_order(rows)))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert any(n[1] == 0 and n[7] != sha("") for n in want)             # a turnless conversation


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '/root/testdata/{sf}/conversations.parquet'")
    want = db.execute(ORACLES["op11_prefix_trie"]).fetchall()
    got = QUERIES["op11_prefix_trie"](spark, f"/root/testdata/{sf}").collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_and_turnless(spark):
    none = ordered_turns(spark, frame(spark, []))
    assert prefix_trie(spark, none, none.select("conv_id").distinct()).count() == 0
    three = spark.createDataFrame([(9,), (4,), (30,)], "conv_id long")
    got = prefix_trie(spark, none, three).collect()
    assert [tuple(r) for r in got] == [(4, 0, None, 3, 0, 1, 0, sha("4,9,30"))]
