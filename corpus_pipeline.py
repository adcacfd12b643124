"""The corpus pipeline: documents in, packed token ids out.

Five stages, each one operator of ``txprep.llm`` over all that the stage before
it kept: toxic documents go, one document of each near-duplicate group stays,
documents that leak benchmark items go, the rest is mixed to the sources'
targets (a document is repeated as often as it is taken), and the mix is written
as packed ids. Each stage takes ``(spark, docs, sf_dir)``; all but the last
return the columns of ``docs``.

Defined results: a null text is empty in every stage and stays null in the rows
that are kept; rows with the same ``doc_id``, or with none, are judged each by
its own text, and one row of each near-duplicate group stays; very long texts are
judged whole; empty input gives empty output at every stage; extra columns of
any name and type are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txprep.llm.common import text_or_empty, written
from txprep.llm.decontaminate import leaks
from txprep.llm.mixing import mixed_documents, row_hash
from txprep.llm.queries import table, tokenizer_path
from txprep.llm.simhash import survivors
from txprep.llm.token_io import read_tokens, write_tokens
from txprep.llm.toxicity import fit_lexicon, score_toxicity
from txprep.scratch import scratch_path


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """``docs`` as one column ``doc`` beside ``columns``: names of the caller's
    columns and of ours never meet."""
    return docs.select(F.struct("*").alias("doc"), *columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5; the lexicon is learned from
    the labels that are not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lexicon = fit_lexicon(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = score_toxicity(packed(docs, F.col("text")), lexicon)
    return scored.filter("score < 0.5").select("doc.*")


#: What tells rows apart besides copies: null or not, the id, the text's hash.
KEY = ["none", "id", "hash"]


def key_columns(text_hash: Column) -> list[Column]:
    """``KEY``, which holds no null."""
    doc_id = F.col("doc_id").cast("long")
    return [doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).alias("id"), text_hash.alias("hash")]


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: the smallest ``doc_id``, null last; of rows
    alike in id and text the one with the smallest hash of all its columns."""
    keyed = packed(docs, *key_columns(F.xxhash64(text_or_empty("text"))))
    rows = docs.select(*key_columns(F.xxhash64(text_or_empty("text")))).groupBy(*KEY).agg(F.count("*").alias("rows"))
    best = survivors(spark, docs).select(*key_columns(F.col("doc_hash")))
    kept = written(spark, best.join(rows, KEY), "pipeline-survivors")
    single = keyed.join(kept.filter("rows = 1").select(*KEY), KEY, "left_semi").select("doc")
    # few keys as a rule: written by themselves, so that Spark sees their size and broadcasts them; the
    # rows of a key then combine in each task before they are shuffled
    many = written(spark, kept.filter("rows > 1").select(*KEY), "pipeline-repeated")
    repeats = keyed.join(many, KEY, "left_semi").groupBy(*KEY).agg(F.min_by("doc", row_hash("doc")).alias("doc")).select("doc")
    return single.unionByName(repeats).select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = leaks(spark, docs, table(spark, sf_dir, "benchmark"))
    bad = found.select(*key_columns(F.col("doc_hash"))).distinct()
    keyed = packed(docs, *key_columns(F.xxhash64(text_or_empty("text"))))
    return keyed.join(bad, KEY, "left_anti").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed_documents(spark, docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as packed token ids; one row per document as read from them."""
    path = scratch_path(spark, "pipeline-tokens")
    write_tokens(docs, path, tokenizer_path(), end_id=0)
    return read_tokens(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_output", token_output),
]

#: The stages hash, draw and tokenize; SQL has no equivalent (tests hold brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
