"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_path

#: ASCII white space, as the contracts define words: ``[^\\x20\\x09-\\x0D]+``.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_or_empty(col: Column | str) -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, UPPER.lower())


def words(col: Column) -> Column:
    """The words of a text as an array, in order; empty for a text without."""
    return F.filter(F.split(col, SPACE), lambda w: w != "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: an expression that is used
    inside a lambda is otherwise evaluated again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    again: cuts the lineage, and a lost executor costs no recomputation."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


#: Repeats that one array holds when rows are multiplied.
REPEAT_BLOCK = 100_000


def repeated(df: DataFrame, times: str, number: str, block: int = REPEAT_BLOCK) -> DataFrame:
    """Every row ``times`` times (a long column), numbered from 1 in ``number``.

    A row that repeats more than ``block`` times is first split to blocks, which
    are dealt over the tasks, so no array grows with a repeat count."""
    n = F.col(times)
    once = df.filter((n > 0) & (n <= block)).withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), n)))
    starts = df.filter(n > block).withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), n, F.lit(block).cast("long"))))
    dealt = starts.repartition(F.col("_from"))
    many = dealt.withColumn(number, F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + (block - 1), n)))).drop("_from")
    return once.unionByName(many)


def prefix_sums(df: DataFrame, part: str, order: list[str], amount: str, out: str) -> DataFrame:
    """``out``: the sum of ``amount`` over all rows before this one, in the
    order of ``part`` and within it of ``order``.

    ``part`` numbers the write tasks of a range-partitioned table, so the one
    window without partitions runs over one row per task of the writer.
    """
    from pyspark.sql import Window
    totals = df.groupBy(part).agg(F.sum(amount).alias("_total"))
    whole = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(part, F.coalesce(F.sum("_total").over(whole), F.lit(0)).alias("_base"))
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return local.join(bases, part).withColumn(out, F.col("_base") + F.col("_local")).drop("_base", "_local")
