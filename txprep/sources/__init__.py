"""Readers, the dataset inventory and the quarantine of lines that do not parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TX_SCHEMA
from .inventory import INVENTORY_FORMATS, error_text, inventory, inventory_totals
from .rejects import quarantine

__all__ = ["INVENTORY_FORMATS", "error_text", "footer_count", "inventory", "inventory_totals", "quarantine", "read_delimited", "read_json",
           "read_parquet", "read_untyped"]


def read_delimited(spark: SparkSession, path, schema: T.StructType = TX_SCHEMA,
                   sep: str = ",", header: bool = True,
                   corrupt_column: str | None = None) -> DataFrame:
    """Typed delimited text: header line skipped, columns by position,
    ``"`` escape, one record per line, permissive (bad fields -> NULL).

    ``path`` may be a glob or a list of paths; for a bounded dev read call
    ``.limit(n)`` on the result.
    ``corrupt_column`` adds a string column holding the raw text of lines
    that did not parse cleanly (NULL for clean lines). Spark parses only the
    columns a query reads, so the marker reflects those columns.
    """
    reader = spark.read
    if corrupt_column is not None:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return (reader.schema(schema)
          .option("sep", sep).option("header", header)
          .option("escape", '"').option("multiLine", False)
          .option("mode", "PERMISSIVE")
          .csv(path))


def read_untyped(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    """Header-named, all-string delimited text (no schema inference pass)."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_parquet(spark: SparkSession, path) -> DataFrame:
    """Parquet with Hive-style partition discovery."""
    return spark.read.parquet(path)


def footer_count(spark: SparkSession, path) -> DataFrame:
    """One row, ``rows``: the rows of Parquet files from their footers alone.

    The count is pushed into the reader, which opens no column chunk and loops
    over no rows. That needs the newer reader and a setting of it, so the
    frame belongs to a session of its own; the caller's settings stay."""
    own = spark.newSession()
    old = [x for x in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(old))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count("*").alias("rows"))


def read_json(spark: SparkSession, path, schema: T.StructType = TX_SCHEMA) -> DataFrame:
    """JSON lines with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).json(path)
