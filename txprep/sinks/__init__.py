"""Writers: label-partitioned Parquet, JSON metrics, text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's output options.
MAX_RECORDS_PER_FILE = 1_000_000
COMPRESSION = "snappy"


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority, without a trailing slash; a glob
    keeps the folders above its first pattern."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    parts = path.rstrip("/").split("/")
    plain = parts[:next((i for i, p in enumerate(parts) if any(c in p for c in "*?[{")), len(parts))]
    p = jvm.org.apache.hadoop.fs.Path("/".join(plain) or "/")
    return p.getFileSystem(conf).makeQualified(p).toString().rstrip("/")


def refuse_overlap(spark: SparkSession, df: DataFrame, output_path: str, sources: Sequence[str] = ()) -> None:
    """Raise if ``output_path`` is, holds or lies in anything that ``df`` reads:
    an overwrite would delete the input before it is read. ``sources`` are the
    paths or globs that were asked for; the files of ``df`` are checked too."""
    out = _qualified(spark, output_path)
    inputs = {_qualified(spark, p) for p in sources} | {_qualified(spark, f) for f in df.inputFiles()}
    for path in inputs:
        if f"{path}/".startswith(f"{out}/") or f"{out}/".startswith(f"{path}/"):
            raise ValueError(f"output_path {output_path!r} overlaps the input {path!r}")


def write_partitioned(df: DataFrame, path: str, label: str = "tx_fraud", partitions: int | None = None,
                      max_records_per_file: int = MAX_RECORDS_PER_FILE,
                      compression: str = COMPRESSION, mode: str = "overwrite", rebalance: bool = False) -> None:
    """Parquet, Hive-partitioned by ``label``. ``partitions`` only ever
    coalesces (never shuffles), so it caps the file count of small outputs
    and is a no-op for outputs that already have fewer partitions; every task
    then writes a file of every label.

    ``rebalance`` shuffles the rows by label instead (adaptive execution must be
    on): a label with most of the rows is split by size, one with few is a single
    partition, so neither is shredded: about rows / ``max_records_per_file`` + 1
    files a label. It costs one shuffle of the output, and pays where the files
    are read often or labels are many."""
    if mode == "overwrite":
        refuse_overlap(df.sparkSession, df, path)
    if rebalance:
        df = df.hint("rebalance", label)
    elif partitions is not None:
        df = df.coalesce(partitions)
    (df.write.mode(mode)
       .option("compression", compression)
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(label)
       .parquet(path))


def write_json(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    metrics.write.mode(mode).json(path)


# Section order of the text report.
REPORT_SECTIONS = ("run", "general", "inventory", "waterfall", "outlier_bounds", "null_profile", "rule_failures",
                   "schema", "class_distribution", "numeric_statistics", "errors")


def report_lines(metrics: DataFrame, title: str | None = None) -> DataFrame:
    """Formatted text lines with sort keys: an optional title, a header per
    section present, then the section's lines. Schema rows become one line
    per column, in column order: ``name: type (NULL|NOT NULL)``."""
    order_of = F.array_position(F.array(*[F.lit(s) for s in REPORT_SECTIONS]), F.col("section"))
    order = F.coalesce(order_of, F.lit(len(REPORT_SECTIONS) + 1))
    value = F.when(F.col("value") == F.floor("value"), F.format_number("value", 0)).otherwise(
        F.format_number("value", 2))
    shown = F.when((F.col("section") == "numeric_statistics") & F.col("text").isNotNull(), F.col("text")).when(
        F.col("text").isNotNull() & F.col("value").isNotNull(),
                   F.concat_ws(" ", value, F.col("text"))).otherwise(F.coalesce(F.col("text"), value))
    line = F.format_string("  %-24s %-12s %s", F.coalesce(F.col("item"), F.lit("")), F.col("metric"), shown)
    is_schema = F.col("section") == "schema"
    body = metrics.filter(~is_schema).select(
        order.alias("_o"), F.lit(1).alias("_h"), F.coalesce(F.col("item"), F.lit("")).alias("_i"),
        F.col("metric").alias("_m"), line.alias("value"))
    schema = (metrics.filter(is_schema).groupBy("section", "item")
              .agg(F.max(F.when(F.col("metric") == "type", F.col("value"))).alias("_pos"),
                   F.max(F.when(F.col("metric") == "type", F.col("text"))).alias("_type"),
                   F.max(F.when(F.col("metric") == "nullable", F.col("value"))).alias("_null"))
              .select(order.alias("_o"), F.lit(1).alias("_h"),
                      F.lpad(F.coalesce(F.col("_pos"), F.lit(0)).cast("int").cast("string"), 6, "0").alias("_i"),
                      F.lit("").alias("_m"),
                      F.format_string("  %s: %s (%s)", F.col("item"), F.col("_type"),
                                      F.when(F.col("_null") == 1, F.lit("NULL")).otherwise(F.lit("NOT NULL")))
                      .alias("value")))
    heads = metrics.select("section").distinct().select(
        order.alias("_o"), F.lit(0).alias("_h"), F.lit("").alias("_i"), F.lit("").alias("_m"),
        F.concat(F.lit("== "), F.upper("section"), F.lit(" ==")).alias("value"))
    lines = heads.unionByName(body).unionByName(schema)
    if title is not None:
        top = metrics.sparkSession.createDataFrame([(0, 0, "", "", title)],
                                                   "_o int, _h int, _i string, _m string, value string")
        lines = top.unionByName(lines)
    return lines


def write_text_report(metrics: DataFrame, path: str, title: str | None = None, mode: str = "overwrite") -> None:
    """Text report, one header per section then its lines, in order over the
    part files. Rows go to the files by a range sort, so a section with a row
    per file of a large store is not one task."""
    lines = report_lines(metrics, title)
    (lines.sort("_o", "_h", "_i", "_m", "value").select("value").write.mode(mode).text(path))
