"""Output partition sizing, and partitions that hot keys do not overload."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import task_group

# The reference's output sizing rule.
ROWS_PER_PARTITION = 1_000_000
MIN_PARTITIONS = 50
# The reference's ceiling, for callers who want it; a fixed ceiling throttles large writes.
MAX_PARTITIONS = 200


def plan_partitions(rows: int, rows_per_partition: int = ROWS_PER_PARTITION,
                    min_partitions: int = MIN_PARTITIONS,
                    max_partitions: int | None = None) -> int:
    """rows // rows_per_partition when rows exceed it (else the minimum),
    at least ``min_partitions`` and, if given, at most ``max_partitions``."""
    k = rows // rows_per_partition if rows > rows_per_partition else min_partitions
    if max_partitions is not None:
        k = min(k, max_partitions)
    return max(k, min_partitions)


def plan_partitions_col(rows: Column, rows_per_partition: int = ROWS_PER_PARTITION,
                        min_partitions: int = MIN_PARTITIONS,
                        max_partitions: int | None = None) -> Column:
    """The same rule as a Column expression over a row-count column."""
    k = F.when(rows > rows_per_partition, F.floor(rows / F.lit(rows_per_partition))).otherwise(
        F.lit(min_partitions)).cast("bigint")
    if max_partitions is not None:
        k = F.least(k, F.lit(max_partitions).cast("bigint"))
    return F.greatest(k, F.lit(min_partitions).cast("bigint"))


#: Keys that a heavy-hitter sketch tracks: a key with more than 1 / TRACKED of the rows is seen.
TRACKED = 10_000
#: Pieces of a hot key for each partition's worth of its rows.
PIECES = 4


def heavy_keys(df: DataFrame, key: str, at_least: float, tracked: int = TRACKED) -> tuple[int, int, dict]:
    """Rows, rows with a NULL key, and ``{key: about its rows}`` for the keys that
    hold at least the share ``at_least`` of the rows, from one pass.

    A heavy-hitter sketch per task group, then one of those: no task merges a
    sketch per input split, and what comes back is at most ``1 / at_least`` keys.
    """
    k = min(tracked, max(1, math.ceil(1 / at_least)))
    grouped = df.groupBy(task_group()).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"),
        F.call_function("approx_top_k_accumulate", F.col(key), F.lit(tracked)).alias("s"))
    # grouped by a constant: without rows there is nothing to combine
    row = grouped.groupBy(F.lit("all")).agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"),
        F.call_function("approx_top_k_combine", F.col("s"), F.lit(tracked)).alias("s")).select(
            "n", "nulls", F.when(F.col("n") > F.col("nulls"), F.call_function("approx_top_k_estimate", F.col("s"), F.lit(k)))
            .alias("top")).first()                # the sketch counts NULL as a key
    if row is None:
        return 0, 0, {}
    n, nulls = row["n"], row["nulls"]
    top = {r["item"]: r["count"] for r in row["top"] or [] if r["item"] is not None}
    return n, nulls, {key: count for key, count in top.items() if count >= at_least * n}


def repartition_hot(df: DataFrame, key: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """``df`` in ``n`` partitions by ``key``, rows of a hot key in several.

    Rows with one key share a partition unless the key holds more rows than a
    partition's share; those keys (and NULL) are dealt in turn over as many
    partitions as their rows need, ``PIECES`` times over, so that the largest
    partition stays near the average whatever one key holds. A caller that
    aggregates by ``key`` combines the pieces of hot keys afterwards.
    """
    rows, nulls, top = heavy_keys(df, key, 1 / n, tracked)
    share = max(1.0, rows / n)
    pieces = {k: min(n, math.ceil(PIECES * c / share)) for k, c in top.items() if c > share}
    home = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    turn = F.monotonically_increasing_id()
    target = home
    if pieces:
        split = F.try_element_at(F.create_map(*[F.lit(x) for kv in pieces.items() for x in kv]), F.col(key))
        target = F.when(split.isNotNull(), F.pmod(home + F.pmod(turn, split), F.lit(n))).otherwise(home)
    if nulls > share:
        target = F.when(F.col(key).isNull(), F.pmod(turn, F.lit(min(n, math.ceil(PIECES * nulls / share))))).otherwise(target)
    return df.repartitionById(n, target.cast("int"))
