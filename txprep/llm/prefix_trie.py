"""The prefix trie of all conversations, by halving depths.

A node is a distinct sequence of first turns. The van Emde Boas recursion cuts
sequences at half depth, names the cut prefixes, builds the upper trie and the
forests below the cuts, and grafts the forests' totals on the upper trie. Here
all blocks of one depth range are built at once, so the recursion is a loop over
block sizes L = 1, 2, 4, ..., one Spark job each, from the bottom up:

* naming: in a block of 2L turns the name of the prefix at its cut (the upper
  half whole) is joined to the turns of the lower half, and a lower prefix is
  named by the pair. Names are SHA-256 digests, so equal names are equal prefixes.
* grafting: totals within blocks of L are known. The lower forests' roots are
  summed up per cut node, and every node of the upper half above a cut node gets
  that sum.

So the longest conversation costs the logarithm of its turns in rounds, not a
round per turn, shorter ones leave the rounds as soon as a block holds them, and
no conversation or node is gathered in one task: joins are on
(conversation, block) and (conversation, place), whose hot keys adaptive
execution splits, and sums combine before they are shuffled. A node is known by
its smallest member and its depth; copies of a conversation own no node. Texts
leave the scan as digests and word counts.

Turns are numbered by ranges over the whole table. The ids that end at a node
are sorted by ranges too and packed; one task then streams a node's packed ids
through SHA-256, as that digest is sequential.

Defined results: turns go by turn (null first), then role and digest of the
text, so ties and repeated rows have one order; null roles and texts are empty;
rows without a ``conv_id`` belong to no conversation; very long texts and
conversations are handled whole; an empty table gives no rows (not even a root);
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prefix_sums, words, written

#: Characters of packed ids in one row.
PACK_CHARS = 1 << 16
PACK_SCHEMA = "conv_id long, depth long, first long, ids string"
ENDS_SCHEMA = "conv_id long, depth long, ends_sha256 string"


def ordered_turns(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """``conv_id, pos, name, words`` for the turns of ``conv_id, turn, role,
    text``: places from 0 in each conversation, a digest of role and text, and
    the text's words."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    slim = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.unhex(F.sha2(F.concat(F.encode(F.concat(F.char_length(role).cast("string"), F.lit(":")), "UTF-8"),
                                F.encode(role, "UTF-8"), F.encode(text, "UTF-8")), 256)).alias("name"),
        F.size(words(text)).cast("long").alias("words")).filter("conv_id is not null")
    # the last key spreads repeated rows, which no other key tells apart
    order = ["conv_id", "turn", "role", "name", "tie"]
    ranged = slim.withColumn("tie", F.monotonically_increasing_id() % 1024).repartitionByRange(*order) \
        .withColumn("part", F.spark_partition_id()).withColumn("one", F.lit(1))
    placed = prefix_sums(written(spark, ranged, "trie-ranges"), "part", order, "one", "place")
    placed = written(spark, placed.select("conv_id", "place", "name", "words"), "trie-turns")
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("pos"), "name", "words")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def name_prefixes(spark: SparkSession, turns: DataFrame, longest: int) -> DataFrame:
    """``turns`` (with ``length``, that of the conversation) with ``name`` the
    name of the whole prefix that ends there. Conversations leave the rounds
    when a block holds them whole."""
    done, size = [], 1
    while size < longest:
        done.append(turns.filter(F.col("length") <= size))
        block, inside = F.expr(f"pos div {2 * size}"), F.col("pos") % (2 * size)
        open_ = turns.filter(F.col("length") > size)
        cuts = open_.filter(inside == size - 1).select("conv_id", block.alias("block"), F.col("name").alias("upper"))
        lower = open_.filter(inside >= size).withColumn("block", block).join(cuts, ["conv_id", "block"])
        named = lower.select("conv_id", "pos", F.unhex(F.sha2(F.concat("upper", "name"), 256)).alias("name"), "words", "length")
        turns = written(spark, open_.filter(inside < size).unionByName(named), f"trie-names-{size}")
        size *= 2
    return union_all([*done, turns])


def graft_totals(spark: SparkSession, nodes: DataFrame, paths: DataFrame, longest: int) -> DataFrame:
    """``nodes`` (``conv_id, pos, parent, reach, leaves, saved``; ``reach``: turns
    of the longest member) with ``leaves`` and ``saved`` summed over subtrees;
    ``paths``: ``conv_id, pos, node`` (the node's smallest member) along the
    conversations that own a node. Nodes leave the rounds when nothing is below
    their block."""
    done, size = [], 1
    while size < longest:
        done.append(nodes.filter(F.col("reach") <= size))
        block, inside = F.expr(f"pos div {2 * size}"), F.col("pos") % (2 * size)
        open_ = nodes.filter(F.col("reach") > size)
        cut = open_.filter(inside == size).groupBy(F.col("parent").alias("conv_id"), block.alias("block")) \
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        upper = paths.filter(inside < size).select("conv_id", block.alias("block"), "pos", "node")
        graft = cut.join(upper, ["conv_id", "block"]).select(F.col("node").alias("conv_id"), "pos", "leaves", "saved")
        grafted = open_.unionByName(graft, allowMissingColumns=True).groupBy("conv_id", "pos").agg(
            *[F.max(c).alias(c) for c in ("parent", "reach", "n_convs", "n_children")],
            *[F.sum(c).alias(c) for c in ("leaves", "saved")])
        nodes, size = written(spark, grafted, f"trie-totals-{size}"), 2 * size
    return union_all([*done, nodes])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, member) rows as rows of many members each."""
    key, first, ids, size, out = None, None, [], 0, []
    for batch in batches:
        for conv_id, depth, member in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "depth", "member")]):
            if (conv_id, depth) != key or size > PACK_CHARS:
                if ids:
                    out.append((*key, first, ",".join(ids)))
                key, first, ids, size = (conv_id, depth), member, [], 0
            ids.append(str(member))
            size += len(ids[-1]) + 1
        if len(out) > 256:
            yield _packed(out)
            out = []
    if ids:
        out.append((*key, first, ",".join(ids)))
    if out:
        yield _packed(out)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    conv_id, depth, first, ids = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(conv_id, pa.int64()), pa.array(depth, pa.int64()), pa.array(first, pa.int64()),
                                       pa.array(ids, pa.string())], names=["conv_id", "depth", "first", "ids"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its packed rows, which come in order."""
    key, state = None, hashlib.sha256()
    done: list[tuple] = []
    for batch in batches:
        for conv_id, depth, ids in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")]):
            if (conv_id, depth) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (conv_id, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if len(done) > 4096:
            yield _digests(done)
            done = []
    if key is not None:
        done.append((*key, state.hexdigest()))
    if done:
        yield _digests(done)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    conv_id, depth, digest = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(conv_id, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest, pa.string())],
                                      names=["conv_id", "depth", "ends_sha256"])


def prefix_trie(spark: SparkSession, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of ``turns`` (``conv_id, pos, name, words``; places from 0
    without gaps) over the conversations ``convs`` (``conv_id``, each once; those
    without turns end at the root). Per node: ``conv_id`` (its smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("length"))
    longest = lengths.agg(F.max("length")).first()[0] or 0
    named = name_prefixes(spark, written(spark, turns.join(lengths, "conv_id"), "trie-names-0"), longest)

    known = written(spark, named.groupBy("pos", "name").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("length").alias("reach")), "trie-nodes")
    steps = written(spark, named.select("conv_id", "pos", "name", "length").join(
        known.select("pos", "name", "node"), ["pos", "name"]).select("conv_id", "pos", "length", "node"), "trie-paths")
    owners = steps.filter("conv_id = node").select("conv_id").distinct()
    paths = written(spark, steps.join(owners, "conv_id", "left_semi"), "trie-owned")
    above = paths.select("conv_id", (F.col("pos") + 1).alias("pos"), F.col("node").alias("parent"))
    plain = known.select(F.col("node").alias("conv_id"), "pos", "reach", "n_convs",
                         ((F.col("n_convs") - 1) * F.col("words")).alias("saved")).join(above, ["conv_id", "pos"], "left")
    plain = written(spark, plain, "trie-parents")
    children = plain.filter("pos > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("pos") - 1).alias("pos")) \
        .agg(F.count("*").alias("n_children"))
    own = plain.join(children, ["conv_id", "pos"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))) \
        .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
    total = graft_totals(spark, written(spark, own, "trie-totals-0"), paths, longest)

    # one row of totals each
    top = total.filter("pos = 0").agg(F.count("*"), F.sum("leaves"), F.sum("saved")).first()
    root_id, n_convs = convs.agg(F.min("conv_id"), F.count("*")).first()
    root = spark.createDataFrame([(root_id, -1, n_convs, top[0], max(top[1] or 0, 1), top[2] or 0)] if n_convs else [],
                                 "conv_id long, pos long, n_convs long, n_children long, leaves long, saved long")
    root_id = F.lit(root_id).cast("long")
    nodes = total.drop("reach").unionByName(root, allowMissingColumns=True).select(
        "conv_id", (F.col("pos") + 1).alias("depth"),
        F.when(F.col("pos") == 0, root_id).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))

    last = steps.filter("pos = length - 1").select(
        F.col("node").alias("conv_id"), (F.col("pos") + 1).alias("depth"), F.col("conv_id").alias("member"))
    turnless = convs.join(lengths, "conv_id", "left_anti").select(
        root_id.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member"))
    ends = written(spark, last.unionByName(turnless), "trie-ends")
    key = ["conv_id", "depth", "member"]
    packed = ends.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_pack, PACK_SCHEMA)
    digests = packed.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first") \
        .mapInArrow(_digest, ENDS_SCHEMA)
    nothing = F.sha2(F.lit(b""), 256)
    return nodes.join(digests, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
