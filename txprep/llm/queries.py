"""Registered queries of this subpackage: one per operator, over the whole
tables of ``sf_dir``, and the pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def sha256_hex(col):
    return F.sha2(F.encode(col, "UTF-8"), 256)


@register("op1_secret_scan")
def op1_secret_scan(spark, sf_dir):
    from .secret_scan import scan_secrets
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", sha256_hex(F.col("base_spans")).alias("base_sha256"),
                        F.col("secret_spans").alias("spans"), "n_entropy_hex", "n_entropy_b64")


@register("op2_token_output")
def op2_token_output(spark, sf_dir):
    from ..scratch import scratch_path
    from .token_io import read_tokens, write_tokens
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=0)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op3_brown_lm")
def op3_brown_lm(spark, sf_dir):
    from .brown_lm import score_documents
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_documents(spark, table(spark, sf_dir, "documents"), held_out)


@register("op4_doc_fingerprint")
def op4_doc_fingerprint(spark, sf_dir):
    from .doc_sketch import as_string, sketch_edits
    out = sketch_edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", sha256_hex(F.col("edited")).alias("edited_sha256"),
                      as_string(F.col("sketch")).alias("fingerprint"),
                      as_string(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


@register("op5_substring_dedup")
def op5_substring_dedup(spark, sf_dir):
    from .suffix_dedup import dedup_substrings
    return dedup_substrings(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op6_decontamination")
def op6_decontamination(spark, sf_dir):
    from .decontaminate import contaminated
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    from .toxicity import fit_lexicon, score_toxicity
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    lexicon = fit_lexicon(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = score_toxicity(docs, lexicon)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@register("op8_chat_format")
def op8_chat_format(spark, sf_dir):
    from .chat import END, START, format_conversations, read_back
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = f"{END}{START}assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(turns.unionByName(extra), tokenizer_path()))


@register("op9_source_mix")
def op9_source_mix(spark, sf_dir):
    from .mixing import mix
    mixed = mix(spark, table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"), "copies")


@register("op10_simhash")
def op10_simhash(spark, sf_dir):
    from .simhash import components
    found = components(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents with a repeated tail, as the query's contract says."""
    import zlib
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@register("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    from .periodic_runs import find_runs
    found = find_runs(table(spark, sf_dir, "documents"), rewrite=_periodic_tail)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        sha256_hex(listed).alias("runs_sha256"), sha256_hex(F.col("collapsed")).alias("collapsed_sha256"))


@register("op13_html_extract")
def op13_html_extract(spark, sf_dir):
    from .html_extract import extract_pages
    found = extract_pages(spark, table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_lines", "n_shared")


def _rebuilt(turns):
    """Conversations with the first turns of another one in place of theirs, as
    the query's contract says: ``(turns, conversations)``."""
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
    h = F.crc32(F.col("conv_id").cast("string")) % 4
    convs = lengths.select("conv_id", h.alias("h"), F.pmod("conv_id", F.lit(20)).alias("rest"))
    donors = turns.filter((F.pmod("conv_id", F.lit(20)) == 0) & (F.col("pos") < 3)) \
        .select(F.col("conv_id").alias("donor"), "pos", "name", "words")
    given = convs.withColumn("donor", F.col("conv_id") - F.col("rest")).join(donors, "donor").filter("pos < h") \
        .select("conv_id", "pos", "name", "words")
    have = lengths.filter(F.pmod("conv_id", F.lit(20)) == 0).select(F.col("conv_id").alias("donor"), F.col("length").alias("donor_length"))
    shift = convs.withColumn("donor", F.col("conv_id") - F.col("rest")).join(have, "donor", "left") \
        .select("conv_id", "h", F.least("h", F.coalesce("donor_length", F.lit(0))).alias("got"))
    own = turns.join(shift, "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "name", "words")
    return given.unionByName(own), convs.select("conv_id")


TRIE_SQL = """
WITH RECURSIVE o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS length, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda s, x: list_reduce(list_prepend(xor(s, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END))) % 4 AS h
  FROM o GROUP BY conv_id),
g AS (
  SELECT c.conv_id, c.h, least(c.h, coalesce(d.length, 0)) AS got, c.conv_id - c.conv_id % 20 AS donor
  FROM c LEFT JOIN c d ON d.conv_id = c.conv_id - c.conv_id % 20),
t AS (
  SELECT g.conv_id, o.pos, o.role, o.text FROM g JOIN o ON o.conv_id = g.donor AND o.pos < g.h
  UNION ALL
  SELECT g.conv_id, o.pos - g.h + g.got, o.role, o.text FROM g JOIN o ON o.conv_id = g.conv_id AND o.pos >= g.h),
p AS (
  SELECT conv_id, 0 AS depth, 0 AS node, 0 AS parent, NULL::VARCHAR AS text FROM c
  UNION ALL
  SELECT p.conv_id, p.depth + 1, min(t.conv_id) OVER (PARTITION BY p.depth, p.node, t.role, t.text), p.node, t.text
  FROM p JOIN t ON t.conv_id = p.conv_id AND t.pos = p.depth),
q AS (SELECT conv_id, depth, CASE WHEN depth = 0 THEN (SELECT min(conv_id) FROM c) ELSE node END AS node,
        CASE WHEN depth = 1 THEN (SELECT min(conv_id) FROM c) WHEN depth > 1 THEN parent END AS parent, text,
        depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
n AS (
  SELECT node, depth, min(parent) AS parent, count(*) AS n_convs,
    (count(*) - 1) * coalesce(len(list_filter(regexp_split_to_array(min(text), '[ \\t-\\r]+'), lambda w: w <> '')), 0) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
  FROM q GROUP BY node, depth),
k AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
s AS (
  SELECT q.node, q.depth, sum(CASE WHEN k.node IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM n JOIN q ON q.conv_id = n.node AND q.depth <= n.depth LEFT JOIN k ON k.node = n.node AND k.depth = n.depth
  GROUP BY q.node, q.depth)
SELECT n.node::BIGINT AS conv_id, n.depth::BIGINT AS depth, n.parent::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(k.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
  n.ends_sha256
FROM n LEFT JOIN k ON k.node = n.node AND k.depth = n.depth JOIN s ON s.node = n.node AND s.depth = n.depth
"""


@register("op11_prefix_trie", TRIE_SQL)
def op11_prefix_trie(spark, sf_dir):
    from .common import written
    from .prefix_trie import ordered_turns, prefix_trie
    turns = written(spark, ordered_turns(spark, table(spark, sf_dir, "conversations")), "trie-ordered")
    rebuilt, convs = _rebuilt(turns)
    return prefix_trie(spark, written(spark, rebuilt, "trie-rebuilt"), convs)
