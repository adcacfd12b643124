"""Stored states: what is read, and that merging equals a fresh run."""

import math

import pytest
from pyspark.sql import functions as F

from txprep.operators import add_files, null_profile, numeric_stats, report_metrics, stored_metrics, stored_nulls, stored_quantiles, stored_stats
from txprep.operators import stored as module
from txprep.plans.catalog import stored_lineitem


def rows_of(df):
    return sorted(map(str, df.collect()))


def numbers(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.col("id"), (F.col("id") * F.lit(0.37) - 1e6).alias("x"), F.when(F.col("id") % 7 > 0, (F.col("id") % 5).cast("int")).alias("k"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("s"), F.col("id") % 3)).otherwise("").alias("s"),
        (F.col("id") % 3).cast("int").alias("label"))


def test_added_files_equal_a_fresh_run_and_old_ones_are_not_read(spark, tmp):
    path, store = f"{tmp}/data dir", f"{tmp}/store"
    numbers(spark, 0, 4000).repartition(3).write.parquet(path)
    assert add_files(spark, path, store, label="label", sketches=["x", "id"]) == 3
    assert add_files(spark, path, store, label="label", sketches=["x", "id"]) == 0
    before = {r["file"] for r in spark.read.parquet(f"{store}/files").collect()}
    numbers(spark, 4000, 9000).repartition(2).write.mode("append").parquet(path)
    # the old files are gone: whoever opens one fails
    import os
    from urllib.parse import unquote
    for f in before:
        os.truncate(unquote(f).removeprefix("file:"), 0)
    assert add_files(spark, path, store, label="label", sketches=["x", "id"]) == 2
    whole = numbers(spark, 0, 9000)
    schema = whole.schema
    assert rows_of(stored_nulls(spark, store, schema)) == rows_of(null_profile(whole))
    assert rows_of(stored_stats(spark, store, schema, digits=5)) == rows_of(numeric_stats(whole, digits=5))
    # written columns may all be null
    fresh = report_metrics(whole, label="label", digits=5, include_partitions=False)
    assert rows_of(stored_metrics(spark, store, schema, digits=5)) == rows_of(fresh)
    q = stored_quantiles(spark, store, schema, "x", {"q1": 0.25, "p99": 0.99}).first()
    assert q["n"] == 9000
    for name, p in (("q1", 0.25), ("p99", 0.99)):
        below = whole.filter(F.col("x") < q[name]).count()
        assert abs(below / 9000 - p) < 1e-3
    assert math.isclose(stored_quantiles(spark, store, schema, "id", {"m": 0.5}).first()["m"], 4500, abs_tol=10)


def test_a_store_must_exist(spark, tmp):
    with pytest.raises(ValueError, match="not a store"):
        module.stored_nulls(spark, f"{tmp}/none", numbers(spark, 0, 1).schema)


def test_a_batch_of_more_rows_has_more_files_not_larger_ones(spark, tmp):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    most = []
    try:
        for n in (40_000, 400_000):
            lineitem = spark.range(n).select(F.col("id").alias("l_orderkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"),
                                             F.rand(1).alias("l_extendedprice"))
            lineitem.write.parquet(f"{tmp}/{n}/lineitem.parquet")
            store, schema = stored_lineitem(spark, f"{tmp}/{n}")
            files = spark.read.parquet(f"{store}/files")
            assert files.agg(F.sum("rows")).first()[0] == n
            assert {r["rows"] for r in stored_nulls(spark, store, schema).collect()} == {n}
            assert stored_quantiles(spark, store, schema, "l_extendedprice", {"m": 0.5}).first()["n"] == n
            most.append(files.agg(F.max("rows")).first()[0])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert most[1] < 3 * most[0], most
