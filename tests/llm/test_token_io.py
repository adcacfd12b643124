import zlib

import numpy as np
import pytest
from helpers import awkward_docs, key, no_docs
from tokenizers import Tokenizer

from txprep.llm.encoding import PieceEncoder
from txprep.llm.queries import tokenizer_path
from txprep.llm.token_io import Shard, pack, pack_shard, read_tokens, unpack, width_for, write_tokens
from txprep.scratch import scratch_path


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 31, 32])
def test_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, size=1001, dtype=np.uint64).astype(np.uint32)
    data = pack(ids, width)
    assert len(data) == -(-1001 * width // 8)
    assert (unpack(data, width, 1001) == ids).all()
    bits = "".join(format(i, f"0{width}b")[::-1] for i in ids.tolist())
    assert data == int(bits[::-1], 2).to_bytes(len(data), "little")


def test_random_access_reads_the_range():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 5000, size=n).astype(np.uint32) for n in (0, 1, 9000, 3, 5000)]
    shard = Shard(pack_shard([5, None, 7, 8, 9], docs, 5000))
    whole = np.concatenate(docs)
    assert shard.width == width_for(5000) == 13 and shard.null_id.tolist() == [False, True, False, False, False]
    for lo, hi in [(0, 0), (0, 1), (4095, 4097), (100, 13000), (8192, 14004)]:
        assert (shard.ids(lo, hi) == whole[lo:hi]).all()
    assert all((shard.document(i) == d).all() for i, d in enumerate(docs))
    with pytest.raises(ValueError):
        pack_shard([1], [np.array([5000])], 5000)


def test_piece_encoder_equals_the_library():
    texts = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>  y", "<|endoftext", "", " ", "  a", "a  b", "\n\n x", " a\n b\t", "a' b's it's, 12.5 x;;", "é à,b <|endoftext|> z", "日本 語。a",
             "a  b  c", "x\x1c y", "can't won't,. 'll", "word.Next, \"quoted\" (x) -- y", "tab\t\tend \r\n", "trail "]
    enc = PieceEncoder(tokenizer_path())
    tok = Tokenizer.from_file(tokenizer_path())
    assert tok.encode(texts[1], add_special_tokens=False).ids == [64, 220, 50256, 275]
    for _ in range(2):                                     # cold and from the cache
        got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode_batch(texts)]
        assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_cuts_at_any_character_equal_the_library():
    enc, tok = PieceEncoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    chars = [*range(0x800), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0x65E5, 0xAC00, 0xFEFF, 0x1F600]
    texts = [f"a{c} b{c}, c{c}\nd {c}  {c}\n\n{c}'s {c}\n" for c in map(chr, chars)]
    got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode_batch(texts)]
    assert got == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_kept_pieces_are_few_and_short():
    enc, tok = PieceEncoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", "S1").astype(str)
    for lo in range(0, 700_000, 100_000):                  # each word once, and a text without a cut
        n = np.arange(lo, lo + 100_000)
        words = ["".join(w) for w in zip(*[letters[n // 26 ** k % 26] for k in range(5)])]
        texts = [" ".join(words[i:i + 1000]) for i in range(0, len(words), 1000)] + ["a " + "\u65e5" * 5000]
        got = enc.encode_batch(texts)
        for i in (0, -1):
            assert np.frombuffer(got[i], "<u4").tolist() == tok.encode(texts[i], add_special_tokens=False).ids
    kept = [k for held in vars(enc).values() if isinstance(held, dict) for k in held]
    assert len(kept) <= 600_000 and max(map(len, kept)) <= 100


def test_a_piece_is_learned_once_whatever_follows_it():
    enc = PieceEncoder(tokenizer_path())
    enc.encode_batch(["x caf\u00e9 word", "x. x, \u00e9. \u00e9, word\nx"])
    sent, plain = [], enc.tok
    enc.tok = type("Spy", (), {"encode_batch_fast": lambda self, texts, **k: sent.extend(texts) or plain.encode_batch_fast(texts, **k)})()
    enc.encode_batch(["x caf\u00e9, word. caf\u00e9. word,\nx word caf\u00e9"])
    assert sent == []


def test_written_ids_equal_the_library(spark):
    docs = awkward_docs(spark)
    docs = docs.unionByName(spark.createDataFrame([(90, "some <|endoftext|> text")], "doc_id long, text string"),
                            allowMissingColumns=True)
    tok = Tokenizer.from_file(tokenizer_path())
    rows = sorted([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
                  key=lambda r: (r[0] is not None, r[0] or 0))
    path = scratch_path(spark, "test-tokens")
    write_tokens(docs, path, tokenizer_path(), shard_ids=3000)
    got = sorted(map(tuple, read_tokens(spark, path).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    at, want = 0, []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted([g[1:] for g in got], key=key) == sorted(want, key=key)
    assert [g[1] for g in got] == [i for i, _ in rows]     # in ascending order of ids
    for start, _, n, _ in got:
        assert start == at
        at += n


def test_rows_without_an_id_are_spread(spark):
    docs = spark.range(4000).selectExpr("cast(null as long) as doc_id", "if(id % 2 = 0, 'same text', concat('text ', id)) as text")
    path = scratch_path(spark, "test-tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # 4,000 rows would be one partition
    try:
        write_tokens(docs.repartition(8), path, tokenizer_path())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.read.parquet(path).groupBy("part").agg({"n_docs": "sum"}).collect()
    assert len(parts) >= 6 and max(r[1] for r in parts) < 1500
    got = read_tokens(spark, path).select("start", "n_tokens").orderBy("start").collect()
    assert len(got) == 4000 and [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]


def test_empty_table(spark):
    path = scratch_path(spark, "test-tokens")
    write_tokens(no_docs(spark), path, tokenizer_path())
    assert read_tokens(spark, path).count() == 0
