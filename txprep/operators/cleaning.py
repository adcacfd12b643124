"""The four cleaning stages and their accounting.

validation -> outlier fence -> dedup by key -> label consistency.
Every stage is a DataFrame -> DataFrame transformation. The only action is
resolving the one-row outlier bounds (an aggregation whose result is a
handful of numbers); the bounds then enter the plan as literals typed like
the amount column, so the range filter is pushed to the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import all_of, is_valid, label_consistent, validation_rules
from ..schema import DEFAULT_COLUMNS, TxColumns
from ..scratch import scratch_path
from ._long import melt_row, ratio_pct
from .quantiles import quantiles

# The outlier fence of the reference job.
OUTLIER_PROBS = {"q1": 0.25, "q3": 0.75, "p1": 0.01, "p99": 0.99}
IQR_FACTOR = 3
#: The reference skips the fence below this many rows; pass it as ``min_rows`` to do the same.
MIN_ROWS_FOR_OUTLIERS = 1000

STAGES = ("input", "validation", "outliers", "dedup", "consistency")


# ---------------------------------------------------------------- stage 1
def validate(df: DataFrame, cols: TxColumns = DEFAULT_COLUMNS) -> DataFrame:
    return df.filter(all_of(validation_rules(cols)))


def rule_failures(df: DataFrame, cols: TxColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Rows failing each validation rule (NULL counts as failing), one pass.

    Columns: ``ordinal, rule, failed, rows``.
    """
    rules = validation_rules(cols)
    wide = df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(~F.coalesce(r, F.lit(False))).alias(f"_f{i}")
                    for i, r in enumerate(rules.values())])
    items = [{"ordinal": F.lit(i + 1), "rule": F.lit(name), "failed": F.col(f"_f{i}")}
             for i, name in enumerate(rules)]
    return melt_row(wide, items, keep=["rows"]).select("ordinal", "rule", "failed", "rows")


# ---------------------------------------------------------------- stage 2
def outlier_bounds(valid: DataFrame, cols: TxColumns = DEFAULT_COLUMNS, method: str = "exact",
                   accuracy: int = 10000, min_rows: int = 0, iqr_factor=IQR_FACTOR) -> DataFrame:
    """One row: ``n, q1, q3, p1, p99, lo, hi, applied`` over validated rows.

    ``lo = max(q1 - f*iqr, p1)``, ``hi = min(q3 + f*iqr, p99)``; the fence is
    applied when there are at least ``min_rows`` validated rows and a value. The
    clamp keeps lo/hi inside the data's range, so they fit the column type.
    """
    typ = valid.schema[cols.amount].dataType
    return fence(quantiles(valid, cols.amount, OUTLIER_PROBS, method=method, accuracy=accuracy), typ, min_rows,
                 iqr_factor)


def fence(q: DataFrame, typ: T.DataType, min_rows: int = 0, iqr_factor=IQR_FACTOR) -> DataFrame:
    """The fence of the one row ``n, q1, q3, p1, p99``, in the type ``typ``."""
    q1, q3, p1, p99 = (F.col(k) for k in OUTLIER_PROBS)
    f = F.lit(iqr_factor)
    return q.select(
        "n", "q1", "q3", "p1", "p99",
        F.greatest(q1 - f * (q3 - q1), p1).cast(typ).alias("lo"),
        F.least(q3 + f * (q3 - q1), p99).cast(typ).alias("hi"),
        ((F.col("n") >= F.lit(min_rows)) & q1.isNotNull()).alias("applied"),
    )


def resolve_bounds(bounds: DataFrame) -> Row:
    """Fetch the single bounds row (bounded: one row of scalars)."""
    return bounds.first()


def in_bounds(bounds: Row, cols: TxColumns, typ) -> "F.Column":
    if not bounds["applied"] or bounds["lo"] is None:
        return F.lit(True)
    return F.col(cols.amount).between(F.lit(bounds["lo"]).cast(typ), F.lit(bounds["hi"]).cast(typ))


def remove_outliers(valid: DataFrame, bounds: Row, cols: TxColumns = DEFAULT_COLUMNS) -> DataFrame:
    if not bounds["applied"]:
        return valid
    return valid.filter(in_bounds(bounds, cols, valid.schema[cols.amount].dataType))


# ---------------------------------------------------------------- stage 3
def _has_map(typ: T.DataType) -> bool:
    if isinstance(typ, T.ArrayType):
        return _has_map(typ.elementType)
    if isinstance(typ, T.StructType):
        return any(_has_map(f.dataType) for f in typ.fields)
    return isinstance(typ, T.MapType)


def dedup(df: DataFrame, key: str, order_by: Sequence[str] | None = None,
          deterministic: bool = True, count_as: str | None = None) -> DataFrame:
    """One row per ``key``; ``count_as`` adds the number of rows the key had.

    ``deterministic=False`` is ``dropDuplicates``: an arbitrary survivor.
    The default keeps the smallest row by ``order_by`` then the remaining
    columns, as ``min(struct(...))`` per key: an aggregate, so duplicates are
    combined map-side before the shuffle and a hot key costs one row per
    task, not a sort of all its rows in one task (as a row_number window
    would). The survivor is the same on every run and every retry.
    """
    if not deterministic and count_as is None:
        return df.dropDuplicates([key])
    unordered = [f.name for f in df.schema.fields if _has_map(f.dataType)]
    if unordered:
        raise ValueError(f"dedup orders rows by their columns; maps have no order: {unordered} "
                         "(drop them, cast them to arrays of entries, or pass deterministic=False)")
    others = [c for c in df.columns if c != key]
    first = [c for c in (order_by or []) if c != key]
    ordered = first + [c for c in others if c not in first]
    best = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_s")
    extra = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    out = [F.col(key) if c == key else F.col(f"_s.{c}").alias(c) for c in df.columns]
    return df.groupBy(key).agg(best, *extra).select(*out, *([count_as] if count_as else []))


#: Duplicated keys that are broadcast by ``dedup_known``: some 16 MB of longs.
BROADCAST_KEYS = 1_000_000


def dedup_known(df: DataFrame, key: str, order_by: Sequence[str] | None = None,
                max_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``dedup``'s rows, finding the duplicated keys first.

    One pass counts keys (a hash aggregate of the key column alone) and writes
    those that occur twice. If they are few enough to broadcast (they are
    counted first), rows with any other key pass as they are, without a shuffle
    or a sort, and only the rest go through ``dedup``. Beyond ``max_keys`` it is
    ``dedup`` for all rows. Reads ``df`` three times, so it pays for wide rows with
    few duplicates that are cheap to read again (a stored table), not for a
    costly plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "duplicated-keys")
    df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key").write.parquet(path)
    keys = spark.read.parquet(path)
    if keys.count() > max_keys:
        return dedup(df, key, order_by)
    twice = F.broadcast(keys)
    same = F.col(key).eqNullSafe(F.col("_key"))
    once = df.join(twice, same, "left_anti")
    return once.unionByName(dedup(df.join(twice, same, "left_semi"), key, order_by))


# ---------------------------------------------------------------- stage 4
def check_consistency(df: DataFrame, cols: TxColumns = DEFAULT_COLUMNS) -> DataFrame:
    return df.filter(label_consistent(cols))


# ---------------------------------------------------------------- composite
def clean(df: DataFrame, cols: TxColumns = DEFAULT_COLUMNS, method: str = "exact",
          bounds: Row | None = None, deterministic: bool = True, accuracy: int = 10000, min_rows: int = 0,
          iqr_factor=IQR_FACTOR) -> DataFrame:
    """validation -> outlier fence -> dedup -> consistency, as one plan."""
    valid = validate(df, cols)
    if bounds is None:
        bounds = resolve_bounds(outlier_bounds(valid, cols, method, accuracy, min_rows, iqr_factor))
    fenced = remove_outliers(valid, bounds, cols)
    return check_consistency(dedup(fenced, cols.id, deterministic=deterministic), cols)


def waterfall(df: DataFrame, bounds: Row | None = None, cols: TxColumns = DEFAULT_COLUMNS,
              method: str = "exact", deterministic: bool = True, min_rows: int = 0) -> DataFrame:
    """Rows after each cleaning stage, rows removed, and % of input kept.

    ``bounds`` are the fence used by ``clean`` (resolve them once and pass
    them to both); when omitted they are computed with ``method``.
    ``deterministic`` picks the dedup survivor rule, as in ``clean``.

    One scan: a per-key aggregation over all rows counts rows, validated
    rows and fenced rows, and keeps the survivor among the fenced rows
    (partial aggregation map-side, so a hot key, NULL ids included, is one
    row per task); one global aggregation then gives all five counts in a
    single row, and removed / % kept are column arithmetic on that row.
    """
    typ = df.schema[cols.amount].dataType
    if bounds is None:
        bounds = resolve_bounds(outlier_bounds(validate(df, cols), cols, method, min_rows=min_rows))
    s1 = is_valid(cols)
    s2 = s1 & F.coalesce(in_bounds(bounds, cols, typ), F.lit(False))
    others = [c for c in df.columns if c != cols.id]
    fenced_row = F.when(s2, F.struct(*[F.col(c) for c in others]))
    survivor = F.min(fenced_row) if deterministic else F.first(fenced_row, ignorenulls=True)
    per_key = df.groupBy(cols.id).agg(F.count(F.lit(1)).alias("n0"), F.count_if(s1).alias("n1"),
                                      F.count_if(s2).alias("n2"), survivor.alias("_s"))
    in_survivor = replace(cols, label=f"_s.{cols.label}", scenario=f"_s.{cols.scenario}")
    kept = F.col("n2") > 0
    totals = per_key.agg(F.sum("n0").alias("_0"), F.sum("n1").alias("_1"), F.sum("n2").alias("_2"),
                         F.count_if(kept).alias("_3"),
                         F.count_if(kept & label_consistent(in_survivor)).alias("_4"))
    items = [{"stage": F.lit(i), "step": F.lit(STAGES[i]), "rows": F.coalesce(F.col(f"_{i}"), F.lit(0)),
              "removed": (F.lit(None).cast("bigint") if i == 0
                          else F.coalesce(F.col(f"_{i - 1}"), F.lit(0)) - F.coalesce(F.col(f"_{i}"), F.lit(0))),
              "pct_of_input": ratio_pct(F.col(f"_{i}"), F.col("_0"))} for i in range(5)]
    return melt_row(totals, items)
