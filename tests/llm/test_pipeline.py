"""The corpus pipeline stage by stage against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from helpers import hamming_components, prose, simhash, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from txprep.llm.common import written
from txprep.llm.queries import tokenizer_path

ITEM = "which of the seven colours does the old painter never use when the rain falls on the northern hills"


def corpus(tmp: str, spark, empty: bool = False) -> str:
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(400):
        w = prose(rng, rng.randrange(20, 120)).split()
        toxic = i % 8 == 0
        for _ in range(4 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["vilegrot", "muckling", "v1legrot"]))
        rows.append((i, " ".join(w), "en", ["s0", "s0", "s1", None][i % 4], 0))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[5][1], "en", "s1", 0) for i in range(20)]                       # copies
    rows += [(1100, f"{prose(rng, 40)} {ITEM} {prose(rng, 40)}", "en", "s1", 0), (1101, None, None, "s1", 0), (1102, "", "en", "s0", 0)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return tmp


def test_stages_against_brute_force(spark, tmp):
    sf = corpus(tmp, spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = {r.doc_id: r for r in docs.collect()}
    out = {}
    for name, stage in pipeline.STAGES:
        docs = written(spark, stage(spark, docs, sf), f"test-{name}")
        out[name] = docs.collect()
        if name != "token_output":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r == first[r.doc_id] for r in out[name])
    kept = {r.doc_id for r in out["toxicity"]}
    assert kept == {i for i in first if i >= 400 or i % 8}
    ids = defaultdict(set)
    for i in kept:
        ids[simhash(first[i].text)].add(i)
    comp = hamming_components(ids)
    assert sorted(r.doc_id for r in out["simhash_near_dedup"]) == sorted(set(comp.values()))
    clean = sorted(r.doc_id for r in out["benchmark_decontamination"])
    assert clean == sorted(i for i in set(comp.values()) if ITEM not in (first[i].text or ""))
    copies = Counter(r.doc_id for r in out["source_mix"])
    assert set(copies) <= set(clean) and max(copies.values()) <= 3
    total = sum(len(words(first[i].text)) for i in clean)
    assert abs(sum(len(words(first[i].text)) * n for i, n in copies.items()) - total) <= 0.02 * total
    tok, at = Tokenizer.from_file(tokenizer_path()), 0
    tokens = sorted(out["token_output"], key=lambda r: r.start)
    assert [r.doc_id for r in tokens] == sorted(copies.elements())
    for r in tokens:
        t = [*tok.encode(first[r.doc_id].text or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(t), zlib.crc32(np.array(t, "<u4").tobytes()))
        at += len(t)


def test_null_and_repeated_ids_are_judged_by_their_texts(spark, tmp):
    rng = random.Random(4)
    a, b, c, d, e = (prose(rng, 90, 5000) for _ in range(5))
    leak = f"{prose(rng, 30)} {ITEM} {prose(rng, 30)}"
    rows = [(None, a), (None, a), (None, a + " "), (None, b), (7, c), (7, c), (7, d), (9, d), (None, leak), (8, leak), (8, e), (None, None), (None, "")]
    docs = spark.createDataFrame([(*r, "en", "s0", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")

    def texts(df):
        return Counter((r.doc_id, (r.text or "").strip()) for r in df.collect())
    # one row of each component, also of those without an id
    assert texts(pipeline.drop_near_duplicates(spark, docs, tmp)) == Counter(
        [(None, a), (None, b), (7, c), (7, d), (8, leak), (8, e), (None, "")])
    # every row but the two that hold the item
    assert texts(pipeline.drop_contaminated(spark, docs, tmp)) == texts(docs) - Counter([(None, leak), (8, leak)])


NAMES = ["_a", "_b", "_copies", "_n", "_id", "_none", "_hash", "_row", "_toxicity", "score", "doc", "none", "id", "hash", "a", "b",
         "rows", "copies", "times", "row", "part", "place", "number", "one", "tie", "w", "x", "key", "first"]


def test_clashing_names_and_a_map_column(spark, tmp):
    sf = corpus(tmp, spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    many = docs.filter("doc_id = 5 or doc_id = 1005").crossJoin(spark.range(30)).drop("id")       # repeated rows
    long_text = docs.limit(1).withColumns({"doc_id": F.lit(3000).cast("long"), "text": F.lit(prose(random.Random(1), 30_000))})
    docs = docs.unionByName(many).unionByName(long_text)
    docs = docs.withColumns({c: F.lit(7) for c in NAMES}).withColumn("map", F.create_map(F.lit("k"), F.col("doc_id")))
    names = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf), f"names-{name}")
        assert docs.columns == names
        rows = docs.collect()
        assert rows and all(r["map"] == {"k": r["doc_id"]} and r["_toxicity"] == r["score"] == r["place"] == 7 for r in rows)
        if name == "simhash_near_dedup":
            assert len(rows) == len({r["doc_id"] for r in rows}) and 5 in {r["doc_id"] for r in rows}
    assert 3000 in {r["doc_id"] for r in rows}


def test_run_of_no_documents(spark, tmp):
    assert pipeline.run(spark, corpus(tmp, spark, empty=True)).count() == 0


def test_entry_registers_all_queries():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
