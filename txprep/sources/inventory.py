"""Dataset inventory: rows per file under a location.

All formats are counted in one job. A file that can't be read fails that job; then
the files of each format are tried in groups that are halved until every
failing group is one file, which keeps its own reason. So a healthy location
costs one pass, and ``k`` bad files among ``n`` cost about ``k log n`` attempts
over ever fewer files. No session setting is changed and no file is skipped silently.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_path

# File kinds the inventory looks for, and how each is read.
INVENTORY_FORMATS = {
    "parquet": ("*.parquet", "parquet"),
    "txt": ("*.txt", "csv"),
    "csv": ("*.csv", "csv"),
    "json": ("*.json", "json"),
}
INVENTORY_SCHEMA = "format string, path string, file string, rows bigint, error string"
COUNT_SCHEMA = "format string, path string, rows bigint"
#: Attempts that run at a time while bad files are looked for.
ATTEMPTS = 8


def error_text(e: Exception) -> str:
    """The whole message of an error on one line, without the JVM's stack trace."""
    lines = [x for x in str(e).split("JVM stacktrace:")[0].splitlines() if not x.startswith(("\tat ", "\t..."))]
    text = re.sub(r"^An error occurred while calling \S+ : ", "", " ".join(" ".join(lines).split()))
    return text or type(e).__name__


def _file_rows(spark: SparkSession, fmt: str, paths: str | list[str]) -> DataFrame | None:
    """A row per row of the files (``format, path``), without reading data
    columns: a fixed read schema, none of it selected (Parquet: footers only).
    None where there is no such path."""
    glob, reader = INVENTORY_FORMATS[fmt]
    r = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).schema("_value string")
    if reader == "csv":
        r = r.option("header", True)
    try:
        return r.format(reader).load(paths).select(F.lit(fmt).alias("format"), F.col("_metadata.file_path").alias("path"))
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return None
        raise


def _count(spark: SparkSession, rows: list[DataFrame]) -> str:
    """Counts per file, written: whether all files can be read must be known now."""
    path = scratch_path(spark, "inventory")
    both = reduce(DataFrame.unionByName, rows)
    both.groupBy("format", "path").agg(F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return path


def listed_files(df: DataFrame) -> list[str]:
    """The files that ``df`` reads, by listing only, as ``_metadata.file_path`` names them."""
    return sorted(re.sub(r"^file:/+", "file:/", f) for f in df.inputFiles())


def _files(spark: SparkSession, fmt: str, root: str) -> list[str]:
    return listed_files(spark.read.format("binaryFile").option("recursiveFileLookup", True)
                        .option("pathGlobFilter", INVENTORY_FORMATS[fmt][0]).load(root))


def literal_path(path: str) -> str:
    """A listed path as a reader takes it: decoded, and without patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path))


def _isolate(spark: SparkSession, fmt: str, files: list[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """Written counts of the files that can be read, and the others with their reasons."""
    good: list[str] = []
    bad: list[tuple[str, str]] = []

    def attempt(group: list[str]) -> tuple[list[str], str | Exception]:
        try:
            return group, _count(spark, [_file_rows(spark, fmt, [literal_path(f) for f in group])])
        except Exception as e:          # any reason for which a file can't be read is kept as data
            return group, e

    groups = [files]
    with ThreadPoolExecutor(ATTEMPTS) as pool:
        while groups:
            split: list[list[str]] = []
            for group, result in pool.map(attempt, groups):
                if isinstance(result, str):
                    good.append(result)
                elif len(group) == 1:
                    bad.append((group[0], error_text(result)))
                else:
                    half = len(group) // 2
                    split += [group[:half], group[half:]]
            groups = split
    return good, bad


def inventory(spark: SparkSession, root: str, formats: Sequence[str] = tuple(INVENTORY_FORMATS)) -> DataFrame:
    """Rows per file under ``root``, each file counted once, format by extension.

    Columns: ``format, path, file, rows, error``. A file that can't be read is a
    row with its own ``error`` and null ``rows``, so a total can be seen to be
    partial; only the absence of files (or of ``root``) is silent, and files
    without rows are left out.
    """
    found = {fmt: rows for fmt in formats if (rows := _file_rows(spark, fmt, root)) is not None}
    if not found:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    bad: list[tuple[str, str, str]] = []
    try:
        counted = [_count(spark, list(found.values()))]
    except Exception:                   # some file; which ones, and why, is found format by format
        counted = []
        for fmt in found:
            files = _files(spark, fmt, root)
            if files:
                good, errors = _isolate(spark, fmt, files)
                counted += good
                bad += [(fmt, path, reason) for path, reason in errors]
    rows = spark.read.schema(COUNT_SCHEMA).parquet(*counted) if counted else spark.createDataFrame([], COUNT_SCHEMA)
    rows = rows.withColumn("error", F.lit(None).cast("string"))
    if bad:
        errors = spark.createDataFrame(bad, "format string, path string, error string")
        rows = rows.unionByName(errors, allowMissingColumns=True)
    return rows.select("format", "path", F.element_at(F.split("path", "/"), -1).alias("file"), "rows", "error")


def inventory_totals(files: DataFrame) -> DataFrame:
    """Per format: number of readable files and their rows."""
    good = files.filter(F.col("error").isNull())
    return good.groupBy("format").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
