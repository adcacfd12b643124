"""Profiles that grow with their files: states per file, kept and merged.

A *store* is a folder of Parquet with one row per input file: rows, and per
column the NULLs, count, mean, sum of squared deviations, exact minimum and maximum, and
a quantile sketch, and one row per file and class. ``add_files`` reads
only the files that the store doesn't know, in one scan, and appends their
states; whatever asks later merges states and reads no data. So a table that
gets a file a day is profiled by reading that file, not the table.

Files must not change once they are known. Appends are whole files of the store,
committed by Spark: a job that fails leaves the store as it was.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import null_or_empty
from ..sources.inventory import listed_files, literal_path
from ._long import melt_row, ratio_pct
from .profile import METRIC_SCHEMA, NUMERIC_STATS, _metric, numeric_columns, schema_metrics
from .quantiles import SKETCH_K, kll_family

#: States that one task merges before the last merge, about.
MERGE_GROUPS = 128


def _read(spark: SparkSession, store: str, part: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{store}/{part}")
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return None
        raise


def _read_schema(spark: SparkSession, store: str) -> T.StructType | None:
    try:
        row = spark.read.text(f"{store}/schema", wholetext=True).first()
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return None
        raise
    return None if row is None else T.StructType.fromJson(json.loads(row["value"]))


def _moments(x: Column) -> dict[str, Column]:
    """Count, mean and sum of squared deviations of the values, as doubles."""
    value = x.cast("double")
    return {"n": F.count(x), "mean": F.avg(value), "m2": F.var_pop(value) * F.count(x)}


def add_files(spark: SparkSession, path: str, store: str, label: str | None = None,
              sketches: Sequence[str] = (), k: int = SKETCH_K) -> int:
    """Add the states of the Parquet files under ``path`` that ``store`` doesn't
    have; ``sketches`` names columns to keep a quantile sketch of. Returns the
    number of files added. The store keeps the schema of its first files, so
    later calls list the others and open only the new ones."""
    store = store.rstrip("/")
    kept = _read_schema(spark, store)
    df = (spark.read if kept is None else spark.read.schema(kept)).parquet(path)
    if kept is None:
        spark.createDataFrame([(df.schema.json(),)], "value string").write.mode("overwrite").text(f"{store}/schema")
    listed = set(listed_files(df))
    known = _read(spark, store, "files")
    if known is not None:
        done = known.select("file").filter(F.col("file").isin(*listed)) if len(listed) <= 1000 else known.select("file")
        listed -= {r["file"] for r in done.collect()}         # names of files, as the reader itself lists them
    if not listed:
        return 0
    new = df if known is None else spark.read.option("basePath", path).schema(df.schema).parquet(*map(literal_path, sorted(listed)))
    file = F.col("_metadata.file_path").alias("file")
    fields = new.schema.fields
    numeric = set(numeric_columns(new))
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(null_or_empty(new, f.name)).alias(f"nulls_{i}"))
        if f.name in numeric:
            x = F.col(f"`{f.name}`")
            aggs += [c.alias(f"{s}_{i}") for s, c in _moments(x).items()]
            aggs += [F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}")]
        if f.name in sketches:
            make, _, _, cast = kll_family(f.dataType)
            aggs.append(make(F.col(f"`{f.name}`").cast(cast), k).alias(f"sketch_{i}"))
    # classes first: a store without a file's row takes the file again, never a file without its classes
    if label is not None:
        new.groupBy(file, F.col(label).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("count")) \
            .write.mode("append").parquet(f"{store}/classes")
    new.groupBy(file).agg(*aggs).write.mode("append").parquet(f"{store}/files")
    return len(listed)


def _files(spark: SparkSession, store: str) -> DataFrame:
    files = _read(spark, store.rstrip("/"), "files")
    if files is None:
        raise ValueError(f"{store!r} is not a store of file states")
    return files.dropDuplicates(["file"])


def stored_quantiles(spark: SparkSession, store: str, schema: T.StructType, col: str, probs: Mapping[str, float]) -> DataFrame:
    """One row: ``n`` and one column per named probability, from the stored
    sketches alone, merged in two levels."""
    i = schema.names.index(col)
    typ = schema[col].dataType
    _, merge, get, _ = kll_family(typ)
    files = _files(spark, store).filter(F.col(f"n_{i}") > 0)
    group = F.pmod(F.xxhash64("file"), F.lit(MERGE_GROUPS)).alias("g")
    merged = files.groupBy(group).agg(merge(f"sketch_{i}").alias("s"), F.sum(f"n_{i}").alias("n")) \
        .agg(merge("s").alias("s"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    q = get(F.col("s"), F.array(*[F.lit(float(p)) for p in probs.values()]))
    return merged.select("n", *[F.when(F.col("n") > 0, q[j]).cast(typ).alias(name) for j, name in enumerate(probs)])


def stored_nulls(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """As ``null_profile``, from the stored states."""
    wide = _files(spark, store).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                                    *[F.coalesce(F.sum(f"nulls_{i}"), F.lit(0)).alias(f"nulls_{i}") for i in range(len(schema))])
    items = [{"ordinal": F.lit(i + 1), "column": F.lit(c), "nulls": F.col(f"nulls_{i}")} for i, c in enumerate(schema.names)]
    long = melt_row(wide, items, keep=["rows"])
    return long.select("ordinal", "column", "nulls", "rows", ratio_pct(F.col("nulls"), F.col("rows")).alias("null_pct"))


def stored_stats(spark: SparkSession, store: str, schema: T.StructType, digits: int | None = None) -> DataFrame:
    """As ``numeric_stats``, from the stored states. Squared deviations are
    moved to the merged mean file by file, so no large squares cancel."""
    files = _files(spark, store)
    numeric = [(i, f) for i, f in enumerate(schema.fields) if isinstance(f.dataType, T.NumericType)]
    means = files.agg(*[(F.sum(F.col(f"mean_{i}") * F.col(f"n_{i}")) / F.sum(f"n_{i}")).alias(f"m_{i}") for i, _ in numeric]).first()
    aggs = []
    for i, _ in numeric:
        off = F.col(f"mean_{i}") - F.lit(means[f"m_{i}"]).cast("double")
        aggs += [F.sum(f"n_{i}").alias(f"n_{i}"), F.sum(F.col(f"m2_{i}") + F.col(f"n_{i}") * off * off).alias(f"m2_{i}"),
                 F.min(f"min_{i}").alias(f"min_{i}"), F.max(f"max_{i}").alias(f"max_{i}")]
    wide = files.agg(*aggs)

    def shown(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    def text(f: T.StructField, c: str) -> Column:
        floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        return F.lit(None).cast("string") if floating else F.col(c).cast("string")

    items = []
    for j, (i, f) in enumerate(numeric):
        n = F.col(f"n_{i}")
        items.append({"ordinal": F.lit(j + 1), "column": F.lit(f.name), "count": n, "mean": shown(F.lit(means[f"m_{i}"]).cast("double")),
                      "stddev": shown(F.sqrt(F.when(n > 1, F.col(f"m2_{i}") / (n - 1)))),
                      "min": F.col(f"min_{i}").cast("double"), "max": F.col(f"max_{i}").cast("double"),
                      "min_text": text(f, f"min_{i}"), "max_text": text(f, f"max_{i}")})
    return melt_row(wide, items)


def stored_metrics(spark: SparkSession, store: str, schema: T.StructType, digits: int | None = None) -> DataFrame:
    """As ``report_metrics`` (without the partition count), from the stored
    states: no data file is read."""
    files = _files(spark, store)
    parts = [spark.createDataFrame(schema_metrics(schema), METRIC_SCHEMA),
             files.agg(F.sum("rows").alias("n")).select(F.inline(F.array(_metric("general", "", "total_rows", F.col("n")))))]
    classes = _read(spark, store.rstrip("/"), "classes")
    if classes is not None:
        per = classes.dropDuplicates(["file", "class"]).groupBy("class").agg(F.sum("count").alias("count"))
        total = per.agg(F.sum("count")).scalar()
        item = F.concat(F.lit("class_"), F.col("class"))
        parts.append(per.select(F.inline(F.array(_metric("class_distribution", item, "count", F.col("count")), _metric(
            "class_distribution", item, "percentage", ratio_pct(F.col("count"), total))))))
    stats = stored_stats(spark, store, schema, digits)
    parts.append(stats.select(F.inline(F.array(
        *[_metric("numeric_statistics", F.col("column"), s, F.col(s), F.col(f"{s}_text") if s in ("min", "max") else None)
          for s in NUMERIC_STATS]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
