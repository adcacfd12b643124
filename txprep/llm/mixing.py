"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of a source with rate
``target / source size`` is taken ``floor(rate)`` times, and once more with the
fractional part as its probability. The last draws are not independent: two
fractional documents meet, and one of them randomly gives words to the other,
in expectation none, until one probability is 0 or 1. So the words that a
source takes stay at its target, up to the last fractional document.

Pairs meet in a distributed reduction tree. Documents are dealt by a hash to
buckets of about ``fan_in``; within a bucket and source they are rounded one
after the other (``aggregate`` over a bounded array) and one fractional
document is left, which goes up to the bucket's parent. A hot source is spread
over all buckets; no group holds more than about ``fan_in`` documents.

All draws are hashes of the documents and the seed, so reruns agree.

Defined results: a null text has size 0; an empty document is taken
``floor(rate)`` times (its words are none either way); null is a source, the
last one; a null id is an id like any other; a source without words has target
0; repeated rows are rounded as documents of their own, however many they are; a
very long text is one document, counted whole; an empty table gives no rows;
extra columns, whatever their names and types, don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, prefix_sums, repeated, text_or_empty, written

FAN_IN = 512
MAX_COPIES = 3


def sizes(docs: DataFrame, text_col: str = "text") -> Column:
    """Words of a text."""
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, cycle: int = 3, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target`` for rows ``source, size``.

    Sources by code point, null last, weigh 1 to ``cycle``, repeating, and share
    all words; a target stops at ``max_copies`` times its source's size and the
    excess is shared again by weight. Filling in the order of size to weight
    gives the level at which no source is above its stop, without iterating. The
    windows run over one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = per.withColumn("weight", ((rank - 1) % cycle + 1).cast("double"))
    w = w.withColumn("stop", F.col("source_size").cast("double") * max_copies)
    order = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum(F.col("source_size").cast("double")).over(every)
    # the level if this source and all after it stay below their stops
    level = ((total - F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    w = w.withColumn("level", level)
    # the first source whose stop is not below its level fixes the level of all after it
    fixed = F.min_by(F.when(F.col("stop") >= F.col("level") * F.col("weight"), F.col("level")),
                     F.when(F.col("stop") >= F.col("level") * F.col("weight"), F.col("stop") / F.col("weight"))).over(every)
    return w.select("source", "source_size",
                    F.when(F.col("source_size") == 0, F.lit(0.0))
                    .otherwise(F.least("stop", fixed * F.col("weight"))).alias("target"))


def _uniform(*cols: Column) -> Column:
    """A draw in [0, 1) from a hash: the same in every rerun."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def _round_group(items: Column, seed: int) -> Column:
    """Round an array of (key, size, x) one after the other: a struct of the
    fractional item that is left and the array of decided ones, (key, size, x)
    with x 0 or 1."""
    kind = "struct<key:bigint,row:bigint,size:bigint,x:double>"

    def step(acc: Column, item: Column) -> Column:
        cur = acc["cur"]
        a, b = cur["size"].cast("double"), item["size"].cast("double")
        # words that can move from the current to the next item, and back
        down = F.least(cur["x"] * a, (F.lit(1.0) - item["x"]) * b)
        up = F.least((F.lit(1.0) - cur["x"]) * a, item["x"] * b)
        gives = _uniform(cur["key"], item["key"], F.lit(seed)) * (down + up) < up
        moved = F.when(gives, -down).otherwise(up)
        # the side that bounds the move becomes integral, exactly
        cur_done = F.when(gives, cur["x"] * a <= (F.lit(1.0) - item["x"]) * b) \
            .otherwise((F.lit(1.0) - cur["x"]) * a <= item["x"] * b)
        whole_cur = F.when(gives, F.lit(0.0)).otherwise(F.lit(1.0))
        new_cur = F.greatest(F.lit(0.0), F.least(F.lit(1.0), cur["x"] + moved / a))
        new_item = F.greatest(F.lit(0.0), F.least(F.lit(1.0), item["x"] - moved / b))

        def as_item(i: Column, x: Column) -> Column:
            return F.struct(i["key"].alias("key"), i["row"].alias("row"), i["size"].alias("size"), x.alias("x"))

        done = F.when(cur_done, as_item(cur, whole_cur)).otherwise(as_item(item, F.lit(1.0) - whole_cur))
        left = F.when(cur_done, as_item(item, new_item)).otherwise(as_item(cur, new_cur))
        return F.struct(left.alias("cur"), F.array_append(acc["done"], done).alias("done"))

    first = F.struct(F.element_at(items, 1).alias("cur"), F.array().cast(f"array<{kind}>").alias("done"))
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), first, step)


def pivotal_rounding(spark: SparkSession, rows: DataFrame, n_rows: int, fan_in: int = FAN_IN,
                     seed: int = 17) -> DataFrame:
    """Decide ``x`` of rows ``(key, row, source, size, x)``, ``0 < x < 1`` and
    ``size > 0``: the same rows with x 0.0 or 1.0. ``(key, row)`` names a row.

    The levels of the tree follow from ``n_rows``: one more for every factor of
    ``fan_in``. The one fractional document that a source has left at the root
    is rounded to the nearer side, and ``settle`` evens out what that moved.
    """
    buckets = max(1, -(-n_rows // fan_in))
    level = rows.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(buckets)))
    kinds, decided = ("key", "row", "size", "x"), None
    while True:
        items = F.array_sort(F.collect_list(F.struct(F.col("key"), F.col("row"), F.col("size"), F.col("x"))))
        done = level.groupBy("source", "bucket").agg(_round_group(items, seed).alias("r"))
        done = written(spark, done, "mix-level")
        out = done.select("source", F.explode("r.done").alias("i")).select("source", *[f"i.{k}" for k in kinds])
        decided = out if decided is None else decided.unionByName(out)
        left = done.select("source", "bucket", *[F.col(f"r.cur.{k}").alias(k) for k in kinds])
        if buckets == 1:
            nearer = F.when(F.col("x") >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0))
            return settle(rows, decided.unionByName(left.select("source", *kinds).withColumn("x", nearer)))
        buckets = -(-buckets // fan_in)
        level = left.withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("long"))


def settle(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Turn over the one document of each source whose size comes closest to
    what the source's decisions are off by, if that brings them nearer."""
    words = F.col("size") * F.col("x")
    off = rows.groupBy("source").agg(F.sum(words).alias("want")).withColumnRenamed("source", "_s").join(
        decided.groupBy("source").agg(F.sum(words).alias("have")), F.col("_s").eqNullSafe(F.col("source"))) \
        .select("_s", F.round(F.col("want") - F.col("have"), 6).alias("off"))      # sums differ in their last digits by order
    turned = F.when(F.col("off") > 0, F.col("x") == 0.0).otherwise(F.col("x") == 1.0)
    rest = F.abs(F.abs("off") - F.col("size"))
    able = decided.join(off, F.col("source").eqNullSafe(F.col("_s"))).filter(turned & (rest < F.abs("off")))
    best = able.groupBy("_s").agg(F.min(F.struct(rest.alias("rest"), F.col("key"), F.col("row"))).alias("b")) \
        .select(F.col("b.key").alias("key"), F.col("b.row").alias("row"), F.lit(True).alias("turn"))
    return decided.join(best, ["key", "row"], "left").withColumn(
        "x", F.when(F.col("turn"), 1.0 - F.col("x")).otherwise(F.col("x"))).drop("turn")


def mix(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", cycle: int = 3, max_copies: int = MAX_COPIES, fan_in: int = FAN_IN,
        seed: int = 17) -> DataFrame:
    """``doc_id, source, text_hash, size, source_size, target, copies`` per
    document (row of ``docs``). ``(doc_id, source, text_hash)`` is the row's
    content; repeated rows are rows of their own here too."""
    text = text_or_empty(text_col)
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        F.xxhash64(text).alias("text_hash"), sizes(docs, text_col).alias("size"))
    # repeated rows get numbers of their own; the group key is the content, so
    # only whole repeats share a group
    sized = written(spark, sized, "mix-sizes")
    counted = sized.groupBy("doc_id", "source", "text_hash", "size").agg(F.count("*").alias("repeats"))
    rows = repeated(counted, "repeats", "row").drop("repeats")
    targets = source_targets(sized, cycle, max_copies)
    rows = rows.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))) \
        .drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("rate", F.least(rate, F.lit(float(max_copies))))
    rows = rows.withColumn("base", F.floor("rate").cast("long")).withColumn("x", F.col("rate") - F.floor("rate"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "source", "text_hash", "row", F.lit(seed))) \
        .withColumn("row", F.xxhash64("text_hash", "row", "doc_id", "source", F.lit(seed + 1)))
    open_rows = rows.filter((F.col("x") > 0) & (F.col("size") > 0))
    n = open_rows.count()
    done = pivotal_rounding(spark, open_rows.select("key", "row", "source", "size", "x"), n, fan_in, seed)
    extra = done.filter(F.col("x") == 1.0).select("key", "row", F.lit(1).cast("long").alias("more"))
    return rows.join(extra, ["key", "row"], "left").select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        (F.col("base") + F.coalesce(F.col("more"), F.lit(0))).alias("copies"))


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the
    columns of ``docs``.

    Rows are found by their content; rows of one content take the copies of all
    of them together and share them evenly, and the first ones, in order of a
    hash of the whole row, take the odd copies. Their numbers come from ranges
    over all such rows, so a content may hold any share of the table.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    source_col = options.get("source_col", "source")
    taken = mix(spark, docs, **options).groupBy("doc_id", "source", "text_hash", "size").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    taken = taken.select(F.xxhash64("doc_id", "source").alias("a"), F.col("text_hash").alias("b"), "copies", "rows")
    # the caller's row is one column here, so its names meet no others
    packed = docs.select(F.xxhash64(F.col(id_col), F.col(source_col)).alias("a"),
                         F.xxhash64(text_or_empty(text_col)).alias("b"), F.struct("*").alias("doc"))
    taken = written(spark, taken, "mix-copies")
    once = packed.join(taken.filter("rows = 1"), ["a", "b"]).select("doc", F.col("copies").alias("times"))
    ranged = packed.join(taken.filter("rows > 1"), ["a", "b"]).withColumns(
        {"row": row_hash("doc"), "tie": F.monotonically_increasing_id() % 1024, "one": F.lit(1)})
    order = ["a", "b", "row", "tie"]
    ranged = ranged.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    places = prefix_sums(written(spark, ranged, "mix-repeats"), "part", order, "one", "place")
    places = written(spark, places, "mix-places")
    first = places.groupBy("a", "b").agg(F.min("place").alias("first"))
    share = F.floor(F.col("copies") / F.col("rows")).cast("long")
    odd = (F.col("place") - F.col("first") < F.col("copies") % F.col("rows")).cast("long")
    shared = places.join(first, ["a", "b"]).select("doc", (share + odd).alias("times"))
    return repeated(once.unionByName(shared).filter("times > 0"), "times", "number").select("doc.*")


def row_hash(row: str) -> Column:
    """A hash of a struct column with fields of any type."""
    return F.xxhash64(F.to_json(F.col(row)))
