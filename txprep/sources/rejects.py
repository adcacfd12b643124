"""Delimited lines that do not parse, kept apart with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TX_SCHEMA

#: Names of the columns beside the schema's: the raw line, why it was rejected, its file.
LINE, CAUSE, FILE = "_line", "_cause", "_file"
FIELDS = "fields"


def cause_of(line: Column, schema: T.StructType, sep: str = ",") -> Column:
    """Why a line does not parse: the name of the first column whose text is
    not a value of its type, or ``fields`` if only their number is wrong."""
    texts = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = F.from_csv(line, texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                     {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    bad = [F.when(raw[f.name].isNotNull() & raw[f.name].try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]
    return F.coalesce(*bad, F.lit(FIELDS))


def quarantine(spark: SparkSession, path, out: str, schema: T.StructType = TX_SCHEMA, sep: str = ",",
               header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split delimited files into good rows and rejected lines, in one scan.

    Every line is parsed whole (no column is skipped, so no bad field goes
    unseen) and written once, to ``out``, under ``rejected=false`` or
    ``rejected=true``. Returns the good rows (columns of ``schema``) and the
    rejected ones: ``_file``, ``_line`` (the raw text) and ``_cause`` (the first
    column that does not parse, or ``fields``). An empty field is a NULL, not an
    error.
    """
    whole = T.StructType([*schema.fields, T.StructField(LINE, T.StringType(), True)])
    rows = (spark.read.schema(whole).option("columnNameOfCorruptRecord", LINE).option("columnPruning", False)
            .option("sep", sep).option("header", header).option("escape", '"').option("multiLine", False)
            .option("mode", "PERMISSIVE").csv(path))
    marked = rows.withColumns({
        FILE: F.when(F.col(LINE).isNotNull(), F.col("_metadata.file_path")),
        CAUSE: F.when(F.col(LINE).isNotNull(), cause_of(F.col(LINE), schema, sep)),
        "rejected": F.col(LINE).isNotNull()})
    marked.write.partitionBy("rejected").parquet(out)
    back = spark.read.schema(T.StructType([*marked.schema.fields])).parquet(out)
    good = back.filter(~F.col("rejected")).select(*schema.names)
    return good, back.filter("rejected").select(FILE, LINE, CAUSE)
