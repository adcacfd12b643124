"""Percentiles of one numeric column: exact, sketch or approximate.

``sketch`` is one pass with a KLL sketch. It is merged as a two-level tree: rows are grouped by
``spark_partition_id() % fan_in``, a key that is constant within a task, so
every task emits exactly one partial sketch; those are merged by up to
``fan_in`` reducers, and only ``fan_in`` sketches reach the final merge.
No single task receives one sketch per input split, which is what a global
``percentile_approx`` does (hundreds of thousands of partial sketches of a
few hundred KB each at 100 TB).

``approx`` is the reference's ``percentile_approx`` (global merge), kept for
fidelity on moderate task counts.

``exact`` (default: the only one whose result is the same on every run) returns SQL ``percentile_disc`` values (the smallest v with
``#(x <= v) >= ceil(p * n)``) without gathering the values of the column in
any one task. It is a distributed selection:

1. one pass (the sketch tree above): n, min, max and an approximate bracket
   ``[q(p - d), q(p + d)]`` around each requested rank;
2. each later pass is a partial+final aggregation of an equal-width
   histogram of the rows inside the current bracket (``width_bucket``), with
   count, min and max per bucket. Only that histogram (at most
   ``targets * (buckets + 1)`` rows) comes back to the driver, which picks
   the bucket holding the rank and narrows the bracket to the bucket's
   actual min and max. The first pass also counts the rows below each
   bracket, which verifies the sketch's bracket; a bracket that misses is
   reset to the full range, so the result never depends on the sketch's
   error bound.
3. A bracket whose min equals its max is the answer. A hot value (one
   value holding a large share of rows) is collapsed by the map-side
   partial aggregation, so skew does not concentrate work.

Decimal columns keep their exact values: bounds are compared in the
column's own type and results are the column's values, never doubles.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# KLL parameter: k = 8000 gives a normalized rank error of about 1e-4, the
# accuracy of percentile_approx's default; sketches stay under ~0.5 MB.
SKETCH_K = 8000
FAN_IN = 128


def kll_family(dtype: T.DataType):
    """(sketch agg, merge agg, quantile getter, input cast) for a column type;
    integral columns keep exact 64-bit values, others go through double."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint, "bigint"
    if isinstance(dtype, T.FloatType):
        return F.kll_sketch_agg_float, F.kll_merge_agg_float, F.kll_sketch_get_quantile_float, "float"
    return F.kll_sketch_agg_double, F.kll_merge_agg_double, F.kll_sketch_get_quantile_double, "double"


def task_group(fan_in: int = FAN_IN) -> Column:
    """A grouping key constant within a task (stable across task retries)."""
    return (F.spark_partition_id() % F.lit(fan_in)).alias("_g")


def tree_agg(df: DataFrame, x: Column, dtype: T.DataType, aggs: dict[str, tuple[Column, str]],
             sketch_k: int = SKETCH_K, fan_in: int = FAN_IN) -> DataFrame:
    """A KLL sketch of ``x`` (as ``_sk``) plus ``aggs``, in one row.

    ``aggs`` maps a name to ``(partial aggregate, combiner)`` with combiner
    ``sum``, ``min`` or ``max``. The aggregation is a two-level tree: per task
    group, then across groups, so the final merge sees at most ``fan_in``
    sketches, whatever the number of input partitions.
    """
    agg, merge, _, cast = kll_family(dtype)
    sketch = agg(x.cast(cast), sketch_k).alias("_sk")
    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    grouped = df.groupBy(task_group(fan_in)).agg(sketch, *[c.alias(k) for k, (c, _) in aggs.items()])
    return grouped.agg(merge("_sk").alias("_sk"), *[combine[f](k).alias(k) for k, (_, f) in aggs.items()])


def sketch_get(dtype: T.DataType, probs) -> Column:
    """Quantiles of the merged ``_sk`` sketch at ``probs`` (an array). A sketch
    of no values cannot be read: guard with the count (CASE short-circuits)."""
    get = kll_family(dtype)[2]
    return get(F.col("_sk"), F.array(*[F.lit(float(p)) for p in probs]))


def sketch_quantiles(df: DataFrame, col: str, probs: Mapping[str, float], k: int = SKETCH_K,
                     fan_in: int = FAN_IN) -> DataFrame:
    """One row: ``n`` and one column per named probability, typed like ``col``."""
    typ = df.schema[col].dataType
    names = list(probs)
    merged = tree_agg(df, F.col(col), typ, {"n": (F.count(F.col(col)), "sum")}, k, fan_in)
    q = sketch_get(typ, [probs[n] for n in names])
    return merged.select(F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
                         *[F.when(F.col("n") > 0, q[i]).cast(typ).alias(n) for i, n in enumerate(names)])


def approx_quantiles(df: DataFrame, col: str, probs: Mapping[str, float],
                     accuracy: int = 10000) -> DataFrame:
    """One row: ``n`` (non-null count) and one column per named probability."""
    names = list(probs)
    q = F.percentile_approx(F.col(col), [float(probs[k]) for k in names], accuracy)
    wide = df.agg(F.count(F.col(col)).alias("n"), q.alias("_q"))
    return wide.select("n", *[F.col("_q")[i].alias(k) for i, k in enumerate(names)])


def _bucket_expr(x, lo, hi, buckets: int, with_below: bool, typ):
    """The bucket 1..``buckets`` of ``x`` in [lo, hi], by its distance from ``lo``
    in the column's own type: neighbours that a double can't tell apart are told
    apart once the bracket is narrow. 0 below it (if asked for), else null."""
    lo_l, hi_l = F.lit(lo).cast(typ), F.lit(hi).cast(typ)
    if lo == hi:
        inside = F.lit(1)
    else:
        exact = T.DecimalType(20, 0) if isinstance(typ, T.IntegralType) else typ
        width = float(hi - lo)
        if math.isinf(width):                              # doubles of both signs near the largest
            share = (x / 4 - lo_l / 4) / F.lit(hi / 4 - lo / 4)
        else:
            share = (x.cast(exact) - lo_l.cast(exact)).cast("double") / F.lit(width)
        inside = F.least(F.floor(share * buckets).cast("int") + 1, F.lit(buckets))
    below = F.lit(0) if with_below else F.lit(None).cast("int")
    return F.when(x < lo_l, below).when(x > hi_l, F.lit(None).cast("int")).otherwise(inside)


def to_column_type(v, typ):
    """A sketch value (double/bigint) as a value of the column's type."""
    if v is None:
        return None
    if isinstance(typ, T.DecimalType):
        from decimal import Context, Decimal
        return Decimal(repr(float(v))).quantize(Decimal(1).scaleb(-typ.scale), context=Context(prec=80))
    if isinstance(typ, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(v)
    return float(v)


def bracket_probs(probs: Mapping[str, float], accuracy: int = 10000) -> list[float]:
    """Ranks ``p - d, p + d`` (d = 2 / accuracy) around each probability."""
    d = 2.0 / accuracy
    out = []
    for p in probs.values():
        out += [max(0.0, float(p) - d), min(1.0, float(p) + d)]
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Mapping[str, float],
                    accuracy: int = 10000, buckets: int = 4096, sketch_k: int = SKETCH_K,
                    fan_in: int = FAN_IN, start: tuple | None = None) -> tuple[int, dict]:
    """Return ``(n, {name: value})`` with SQL ``percentile_disc`` semantics.

    NaN sorts last, infinities at the ends; both are only counted, and the
    selection runs over the finite values. Every round narrows each bracket to
    one bucket's own minimum and maximum, and the bracket's ends lie in
    different buckets, so it always gets smaller and the loop ends.

    ``accuracy`` sets the bracket half-width (2 / accuracy in rank).
    ``start = (n, min, max, bracket values)`` (values at ``bracket_probs``)
    skips the first pass when a caller's own pass over a column without NaN and
    infinities already produced them; the brackets are verified like the
    sketch's own."""
    typ = df.schema[col].dataType
    x = F.col("x")
    base = df.select(F.col(col).alias("x")).where(x.isNotNull())
    floating = isinstance(typ, (T.DoubleType, T.FloatType))
    inf = F.lit(float("inf"))
    finite = ~F.isnan(x) & (x > -inf) & (x < inf) if floating else F.lit(True)
    names = list(probs)
    brackets = bracket_probs(probs, accuracy)
    low = high = nans = 0
    if start is None:
        value = F.when(finite, x)
        aggs = {"n": (F.count(value), "sum"), "mn": (F.min(value), "min"), "mx": (F.max(value), "max")}
        if floating:
            aggs |= {"nan": (F.count_if(F.isnan(x)), "sum"), "low": (F.count_if(x == -inf), "sum"),
                     "high": (F.count_if(x == inf), "sum")}
        first = tree_agg(base, value, typ, aggs, sketch_k, fan_in)
        first = first.select(*aggs, F.when(F.col("n") > 0, sketch_get(typ, brackets)).alias("b")).first()
        start = (first["n"], first["mn"], first["mx"], first["b"])
        if floating:
            low, high, nans = (int(first[k] or 0) for k in ("low", "high", "nan"))
    n = int(start[0] or 0)
    total = low + n + high + nans
    if total == 0:
        return 0, {k: None for k in names}
    gmin, gmax = start[1], start[2]
    approx = [to_column_type(v, typ) for v in start[3] or [None] * len(brackets)]
    state, result = {}, {}
    for i, k in enumerate(names):
        rank = max(1, math.ceil(float(probs[k]) * total))
        if rank <= low:
            result[k] = float("-inf")
        elif rank > low + n:
            result[k] = float("inf") if rank <= low + n + high else float("nan")
        else:
            lo, hi = sorted((approx[2 * i], approx[2 * i + 1]))
            state[k] = {"rank": rank - low, "lo": max(lo, gmin), "hi": min(hi, gmax), "below": None}
    base = base.where(finite)
    while len(result) < len(names):
        active = [k for k in names if k not in result]
        parts, keep = [], []
        for i, k in enumerate(active):
            s = state[k]
            b = _bucket_expr(x, s["lo"], s["hi"], buckets, s["below"] is None, typ)
            parts.append(F.struct(F.lit(i).alias("t"), b.alias("b")))
            upper = x <= F.lit(s["hi"]).cast(typ)
            keep.append(upper if s["below"] is None else upper & (x >= F.lit(s["lo"]).cast(typ)))
        wanted = keep[0]
        for c in keep[1:]:
            wanted = wanted | c
        hist = (base.where(wanted)
                .select(F.explode(F.array(*parts)).alias("tb"), "x")
                .where(F.col("tb.b").isNotNull())
                .groupBy(F.col("tb.t").alias("t"), F.col("tb.b").alias("b"))
                .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx"))
                .collect())
        by_target = defaultdict(list)
        for r in hist:
            by_target[r["t"]].append(r)
        for i, k in enumerate(active):
            s = state[k]
            rows = sorted(by_target[i], key=lambda r: r["b"])
            below = s["below"] if s["below"] is not None else sum(r["c"] for r in rows if r["b"] == 0)
            inside = [r for r in rows if r["b"] >= 1]
            if not (below < s["rank"] <= below + sum(r["c"] for r in inside)):
                if s["below"] is not None:
                    raise RuntimeError(f"the counts of {col!r} changed between passes: the input is not stable")
                s.update(lo=gmin, hi=gmax, below=0)   # sketch bracket missed: full range
                continue
            cum = below
            for r in inside:
                if cum + r["c"] >= s["rank"]:
                    break
                cum += r["c"]
            lo, hi = r["mn"], r["mx"]
            if lo == hi:
                result[k] = lo
            elif (lo, hi) == (s["lo"], s["hi"]):
                raise RuntimeError(f"no progress selecting {k!r} of {col!r} between {lo!r} and {hi!r}")
            else:
                s.update(lo=lo, hi=hi, below=cum)
    return total, result


METHODS = ("sketch", "approx", "exact")


def quantiles(df: DataFrame, col: str, probs: Mapping[str, float], method: str = "exact",
              accuracy: int = 10000) -> DataFrame:
    """One-row frame ``n, <name>...`` for any method (same schema)."""
    if method == "sketch":
        return sketch_quantiles(df, col, probs)
    if method == "approx":
        return approx_quantiles(df, col, probs, accuracy)
    if method != "exact":
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    typ = df.schema[col].dataType
    n, vals = exact_quantiles(df, col, probs, accuracy)
    spark = df.sparkSession
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n"),
                                 *[F.lit(vals[k]).cast(typ).alias(k) for k in probs])
