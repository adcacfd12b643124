"""Hot keys, rebalanced writes, quarantined lines, bad files, duplicates first."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from txprep import fixtures
from txprep.operators import class_distribution, dedup, dedup_known, heavy_keys, repartition_hot
from txprep.operators import cleaning
from txprep.plans import prepare
from txprep.sinks import write_partitioned
from txprep.sources import inventory, quarantine


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(df, label):
    rows = df.select(label, F.col("_metadata.file_path").alias("f")).groupBy(label).agg(F.count_distinct("f").alias("n"))
    return {r[label]: r["n"] for r in rows.collect()}


def sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.mark.parametrize("key", ["if(id % 3 = 0, 0L, id)", "if(id % 3 = 0, null, id)", "if(id % 3 = 0, 'hot', cast(id as string))",
                                 "if(id % 2 = 0, 1L, if(id % 3 = 0, 2L, id))", "0L", "cast(null as long)"])
def test_no_partition_is_overloaded(spark, key):
    df = spark.range(48_000).select(F.expr(key).alias("k"), "id").repartition(7)
    out = repartition_hot(df, "k", 16)
    n = sizes(out)
    assert out.rdd.getNumPartitions() == 16 and sum(n) == 48_000 and max(n) <= 2 * 48_000 / 16
    assert out.agg(F.sum("id")).first()[0] == 48_000 * 47_999 // 2


def test_cold_keys_stay_together(spark):
    df = spark.range(20_000).select((F.col("id") % 500).alias("k"))
    out = repartition_hot(df, "k", 8).withColumn("at", F.spark_partition_id()).groupBy("k").agg(F.count_distinct("at").alias("p"))
    assert out.filter("p > 1").count() == 0
    assert repartition_hot(df.limit(0), "k", 8).count() == 0


def test_heavy_keys(spark):
    df = spark.range(10_000).select(F.expr("if(id < 4000, 7L, if(id < 5000, null, id))").alias("k"))
    assert heavy_keys(df, "k", 0.1) == (10_000, 1000, {7: 4000})


def test_rebalanced_write_shreds_no_class(spark, tmp):
    df = spark.range(30_000).select("id", F.expr("if(id % 17 = 0, 1, 0)").alias("label")).repartition(12)
    files = {}
    for name, options in (("plain", {}), ("rebalanced", {"rebalance": True})):
        write_partitioned(df, f"{tmp}/{name}", label="label", max_records_per_file=10_000, **options)
        back = spark.read.parquet(f"{tmp}/{name}")
        assert back.count() == 30_000
        files[name] = files_of(back, "label")
    assert files["plain"] == {0: 12, 1: 12} and files["rebalanced"] == {0: 3, 1: 1}
    hinted = df.hint("rebalance", "label")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(hinted)


def test_prepare_rebalances_its_output(spark, tmp):
    raw = fixtures.tx(spark, SF["0.001"])
    a = prepare(spark, raw, f"{tmp}/a", rebalance=True)
    b = prepare(spark, raw, f"{tmp}/b")
    assert a.class_counts == b.class_counts and a.waterfall == b.waterfall
    assert files_of(spark.read.parquet(f"{tmp}/a"), "tx_fraud") == {0: 1, 1: 1}


def test_quarantine_keeps_every_line(spark, tmp):
    lines = ["a,b,c,d,e,f,g,h,i", "5,2024-01-01 10:00:00,1,2,10.55,3,4,1,0", "6,2024-01-01 11:00:00,abc,2,1.5,3,4,0,0", "7,short",
             "8,x,1,2,1.0,3,4,0,0,extra", "9,x,,2,1.0,3,4,0,300", '10,"x, ""y""",,2,1.0,3,4,0,', "", "11,x,1,2,1.0,3,4,0,zero"]
    (p := f"{tmp}/in").encode()
    import os
    os.makedirs(p)
    for name in ("a.txt", "b.txt"):
        with open(f"{p}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    good, bad = quarantine(spark, f"{p}/*.txt", f"{tmp}/out")
    assert sorted(r["transaction_id"] for r in good.collect()) == [5, 5, 10, 10]
    assert good.filter("transaction_id = 10").first()["tx_datetime"] == 'x, "y"'
    got = sorted((r["_line"], r["_cause"]) for r in bad.collect())
    want = [(lines[2], "customer_id"), (lines[3], "fields"), (lines[4], "fields"), (lines[5], "tx_fraud_scenario"),
            (lines[8], "tx_fraud_scenario")]
    assert got == sorted(want * 2)
    assert {r["_file"].rsplit("/", 1)[1] for r in bad.collect()} == {"a.txt", "b.txt"}
    # the text was read once: both sides are reads of what was written
    assert "FileScan csv" not in plan(good) + plan(bad) and "PartitionFilters: [isnotnull(rejected" in plan(bad)


def test_every_bad_file_has_its_own_reason(spark, tmp):
    before = spark.conf.get("spark.sql.files.ignoreCorruptFiles")
    import os
    os.makedirs(f"{tmp}/in/sub dir [1]")
    for i in range(9):
        spark.range(10 * (i + 1)).coalesce(1).write.parquet(f"{tmp}/in/t{i}")
    with open(f"{tmp}/in/short.parquet", "w") as f:
        f.write("x")
    with open(f"{tmp}/in/sub dir [1]/text.parquet", "w") as f:
        f.write("this is text\n" * 20)
    with open(f"{tmp}/in/a.csv", "w") as f:
        f.write("h\n1\n2\n")
    rows = inventory(spark, f"{tmp}/in").collect()
    bad = {r["file"]: r["error"] for r in rows if r["error"]}
    assert set(bad) == {"short.parquet", "text.parquet"}
    assert "length is too low" in bad["short.parquet"] and "magic number" in bad["text.parquet"]
    assert sum(r["rows"] or 0 for r in rows if r["format"] == "parquet") == 450
    assert [r["rows"] for r in rows if r["format"] == "csv"] == [2]
    assert spark.conf.get("spark.sql.files.ignoreCorruptFiles") == before


def test_inventory_of_good_files_is_one_pass(spark):
    sc = spark.sparkContext
    sc.setJobGroup("inventory-jobs", "")
    inventory(spark, SF["0.001"])
    jobs = len(sc.statusTracker().getJobIdsForGroup("inventory-jobs"))
    sc.setJobGroup("", "")
    assert jobs <= 4
    from txprep.sources.inventory import _file_rows
    text = plan(_file_rows(spark, "parquet", SF["0.001"]).groupBy("path").count())
    assert "ReadSchema: struct<>" in text                     # footers only


def test_footer_count_reads_no_column(spark, tmp):
    from txprep.sources import footer_count
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.range(1000).repartition(3).write.parquet(f"{tmp}/p")
    out = footer_count(spark, f"{tmp}/p")
    assert out.collect() == [(1000,)] and "PushedAggregation: [COUNT(*)]" in plan(out)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_duplicates_first_equals_dedup_and_sorts_no_unique_row(spark, tmp, monkeypatch):
    df = spark.range(3000).select(F.expr("if(id % 10 = 0, id - 10, if(id % 97 = 1, null, id))").alias("k"),
                                  F.xxhash64("id").alias("v"), F.concat(F.lit("t"), "id").alias("t"))
    df.write.parquet(f"{tmp}/d")
    df = spark.read.parquet(f"{tmp}/d")
    out = dedup_known(df, "k")
    want = sorted(map(str, dedup(df, "k").collect()))
    assert sorted(map(str, out.collect())) == want
    assert "LeftAnti, BuildRight" in plan(out) and "SortMergeJoin" not in plan(out)
    monkeypatch.setattr(cleaning, "BROADCAST_KEYS", 1)
    assert sorted(map(str, dedup_known(df, "k", max_keys=1).collect())) == want


def test_class_distribution_reads_its_input_once(spark, tmp):
    spark.range(1000).select((F.col("id") % 7).alias("label")).write.parquet(f"{tmp}/c")
    out = class_distribution(spark.read.parquet(f"{tmp}/c"), "label")
    assert sum(r["count"] for r in out.collect()) == 1000
    text = plan(out)
    assert text.split("== Initial Plan ==")[0].count("FileScan parquet") <= 2
    assert class_distribution(spark.read.parquet(f"{tmp}/c").limit(0), "label").count() == 0
