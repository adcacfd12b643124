"""Data-quality measures: row count, null/empty profile, sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import null_or_empty
from ._long import melt_row, ratio_pct

# Fixed value: the reference's sampling seed.
SAMPLE_SEED = 42


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def null_profile(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """NULL (and, for strings, empty) count per column in one aggregation over
    all rows.

    Columns: ``ordinal, column, nulls, rows, null_pct``; ``exclude`` names
    columns to leave out.
    """
    names = [c for c in df.columns if c not in set(exclude)]
    wide = df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(null_or_empty(df, c)).alias(f"_n{i}") for i, c in enumerate(names)])
    items = [{"ordinal": F.lit(i + 1), "column": F.lit(c), "nulls": F.col(f"_n{i}")}
             for i, c in enumerate(names)]
    long = melt_row(wide, items, keep=["rows"])
    return long.select("ordinal", "column", "nulls", "rows",
                       ratio_pct(F.col("nulls"), F.col("rows")).alias("null_pct"))


def sample(df: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """A Bernoulli sample (no replacement) of the fraction asked for, with a
    fixed seed, whatever the table's size."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
