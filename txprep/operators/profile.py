"""Dataset profile: schema, partitions, class balance, numeric statistics,
all as long-form metric rows ``section, item, metric, value, text``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._long import melt_row, ratio_pct

METRIC_SCHEMA = T.StructType([
    T.StructField("section", T.StringType(), False),
    T.StructField("item", T.StringType(), True),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("text", T.StringType(), True),
])

# Per-column statistics of the reference's numeric summary.
NUMERIC_STATS = ("count", "mean", "stddev", "min", "max")


def partition_count(df: DataFrame) -> DataFrame:
    """Number of non-empty partitions of ``df`` as read (no columns scanned)."""
    return df.select(F.spark_partition_id().alias("p")).agg(F.count_distinct("p").alias("partitions"))


def class_distribution(df: DataFrame, label: str = "tx_fraud") -> DataFrame:
    """Rows per label value and their share of all rows.

    One grouped aggregation (partial counts map-side); the total is the sum of
    its counts as a scalar subquery, which reuses its shuffle: the input is
    read once, and no task sees all classes of a label with many.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()
    return counts.select(label, "count", ratio_pct(F.col("count"), total).alias("pct"))


def numeric_columns(df: DataFrame, max_columns: int | None = None) -> list[str]:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return names if max_columns is None else names[:max_columns]


def numeric_stats(df: DataFrame, columns=None, max_columns: int | None = None,
                  digits: int | None = None) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column, one pass.

    Columns: ``ordinal, column, count, mean, stddev, min, max`` (doubles but
    count), and the exact ``min_text`` and ``max_text`` (null for floating columns; a double
    can't hold every long or decimal). Only numeric columns are passed to the aggregation, so no column
    can fail it. ``digits`` rounds mean and stddev.
    """
    names = list(columns) if columns is not None else numeric_columns(df, max_columns)
    aggs = []
    for i, c in enumerate(names):
        x = F.col(c)
        aggs += [F.count(x).alias(f"_c{i}"), F.avg(x).cast("double").alias(f"_a{i}"),
                 F.stddev_samp(x).cast("double").alias(f"_s{i}"),
                 F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    wide = df.agg(*aggs)

    def r(c):
        return c if digits is None else F.round(c, digits)

    def exact(c, stat):
        floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        return F.lit(None).cast("string") if floating else F.col(stat).cast("string")

    items = [{"ordinal": F.lit(i + 1), "column": F.lit(c), "count": F.col(f"_c{i}"),
              "mean": r(F.col(f"_a{i}")), "stddev": r(F.col(f"_s{i}")),
              "min": F.col(f"_lo{i}").cast("double"), "max": F.col(f"_hi{i}").cast("double"),
              "min_text": exact(c, f"_lo{i}"), "max_text": exact(c, f"_hi{i}")}
             for i, c in enumerate(names)]
    return melt_row(wide, items)


def _metric(section, item, metric, value=None, text=None):
    return F.struct(F.lit(section).alias("section"),
                    (item if not isinstance(item, str) else F.lit(item)).cast("string").alias("item"),
                    F.lit(metric).alias("metric"),
                    (value if value is not None else F.lit(None)).cast("double").alias("value"),
                    (text if text is not None else F.lit(None)).cast("string").alias("text"))


def schema_metrics(schema: T.StructType) -> list[tuple]:
    """Two metric rows per column: its type, and whether it may be NULL."""
    rows = [("schema", f.name, "type", float(i + 1), f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return rows + [("schema", f.name, "nullable", 1.0 if f.nullable else 0.0, None) for f in schema.fields]


def report_metrics(df: DataFrame, label: str | None = "tx_fraud", max_columns: int | None = None,
                   digits: int | None = None, include_partitions: bool = True) -> DataFrame:
    """Profile of a dataset as metric rows (sections: general, incl. the
    partition count; schema; class_distribution; numeric_statistics).

    The class section appears only when ``label`` is a column. Data metrics
    come from two aggregations (grouped by label, and global numeric stats)
    plus, optionally, the partition count; they are unioned, never joined.
    """
    spark = df.sparkSession
    parts = []
    parts.append(spark.createDataFrame(schema_metrics(df.schema), METRIC_SCHEMA))
    if include_partitions:
        parts.append(partition_count(df).select(
            F.inline(F.array(_metric("general", "", "partitions", F.col("partitions"))))))
    if label is not None and label in df.columns:
        dist = class_distribution(df, label)
        item = F.concat(F.lit("class_"), F.col(label).cast("string"))
        parts.append(dist.select(F.inline(F.array(
            _metric("class_distribution", item, "count", F.col("count")),
            _metric("class_distribution", item, "percentage", F.col("pct"))))))
        parts.append(dist.agg(F.sum("count").alias("n")).select(
            F.inline(F.array(_metric("general", "", "total_rows", F.col("n"))))))
    else:
        parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(
            F.inline(F.array(_metric("general", "", "total_rows", F.col("n"))))))
    stats = numeric_stats(df, max_columns=max_columns, digits=digits)
    parts.append(stats.select(F.inline(F.array(
        *[_metric("numeric_statistics", F.col("column"), s, F.col(s), F.col(f"{s}_text") if s in ("min", "max") else None)
          for s in NUMERIC_STATS]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
