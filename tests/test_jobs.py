"""Profile-job routing and the streaming stages."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from txprep import fixtures
from txprep.operators import outlier_bounds, resolve_bounds, validate
from txprep.plans import analyze, is_dataset_path, ml_ready, write_reports
from txprep.schema import TX_SCHEMA
from txprep.sinks import write_partitioned
from txprep.streaming import stream_prepare, stream_rows


def test_routing_rule():
    assert is_dataset_path("s3a://b/ML_READY_DATA_production/")
    assert is_dataset_path("/x/y.parquet")
    assert not is_dataset_path("s3a://b/raw/")


def test_dataset_route(spark, tmp):
    path = f"{tmp}/ml_ready_data"
    write_partitioned(ml_ready(fixtures.tx(spark, SF["0.001"]), min_rows=1000), path, partitions=2)
    m = analyze(spark, path)
    got = {(r["section"], r["item"], r["metric"]): r for r in m.collect()}
    assert got[("general", "", "total_rows")]["value"] == 934
    assert got[("class_distribution", "class_0", "count")]["value"] == 751
    assert got[("general", path, "dataset")]["text"] == "ML_PARQUET"
    assert got[("general", "", "partitions")]["value"] >= 1
    assert got[("schema", "tx_fraud", "type")]["text"] == "int"
    cols = {k[1] for k in got if k[0] == "numeric_statistics"}
    assert cols == set(ml_ready(fixtures.tx(spark, SF["0.001"])).columns)       # all of them are numeric
    paths = write_reports(m, f"{tmp}/report")
    sections = m.select("section").distinct().count()
    columns = m.filter("section = 'schema'").select("item").distinct().count()
    lines = [r["value"] for r in spark.read.text(paths["text"]).collect()]
    assert len(lines) == m.filter("section != 'schema'").count() + columns + sections
    at = lines.index("== SCHEMA ==")
    assert lines[at + 1] == "  transaction_id: bigint (NULL)" and lines[at + 15] == "  tx_fraud: int (NULL)"


def test_empty_dataset_falls_through_to_inventory(spark, tmp):
    path = f"{tmp}/ml_ready_data"
    spark.createDataFrame([], TX_SCHEMA).write.parquet(path)
    m = analyze(spark, path)
    got = {(r["section"], r["item"], r["metric"]): r["value"] for r in m.collect()}
    assert got[("general", "", "total_rows")] == 0
    assert got[("general", "", "files_processed")] == 0


def test_inventory_route(spark):
    m = analyze(spark, SF["0.001"])
    got = {(r["section"], r["metric"], r["item"]): r["value"] for r in m.collect()}
    assert got[("general", "files_processed", "")] == 14
    assert got[("general", "total_rows", "")] == sum(
        fixtures.table(spark, SF["0.001"], t).count() for t in fixtures.TABLES)


def test_stream_matches_batch_stages(spark, tmp):
    tx = fixtures.tx(spark, SF["0.001"])
    src = f"{tmp}/in"
    tx.repartition(3).write.option("header", True).csv(src)
    bounds = resolve_bounds(outlier_bounds(validate(tx), method="exact"))
    q = stream_prepare(spark, src, f"{tmp}/out", bounds=bounds, checkpoint=f"{tmp}/ckpt",
                       max_files_per_trigger=1)
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp}/out")
    batch = stream_rows(tx, bounds)
    assert out.count() == batch.count() > 0
    key = ["transaction_id", "tx_amount", "tx_hour"]
    assert out.select(*key).exceptAll(batch.select(*key)).count() == 0
    # restart: the checkpoint says everything is done, nothing is appended twice
    q2 = stream_prepare(spark, src, f"{tmp}/out", bounds=bounds, checkpoint=f"{tmp}/ckpt")
    q2.awaitTermination()
    assert spark.read.parquet(f"{tmp}/out").count() == batch.count()
    # a file that arrives after a restart is not lost
    tx.write.mode("append").option("header", True).csv(src)
    stream_prepare(spark, src, f"{tmp}/out", bounds=bounds, checkpoint=f"{tmp}/ckpt").awaitTermination()
    assert spark.read.parquet(f"{tmp}/out").count() == 2 * batch.count()
    with pytest.raises(TypeError):
        stream_prepare(spark, src, f"{tmp}/out", bounds=bounds)
    assert out.filter(F.col("tx_fraud").isNull()).count() == 0


def test_unreadable_dataset_reports_error(spark, tmp):
    path = f"{tmp}/ml_ready_data"
    import os
    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "w") as f:
        f.write("not parquet")
    import warnings
    with warnings.catch_warnings(record=True):
        warnings.simplefilter("always")
        rows = analyze(spark, path).collect()
    errs = [r for r in rows if r["section"] == "errors"]
    assert sorted(r["item"].rsplit("/", 1)[1] for r in errs) == ["ml_ready_data", "part-0.parquet"]
    assert any(r["text"].startswith(f"reading {path}") for r in errs)
    assert [r["value"] for r in rows if r["metric"] == "total_rows"] == [0]


def test_sample_is_the_fraction_asked_for(spark):
    from txprep.operators import sample
    tx = fixtures.tx(spark, SF["0.01"])
    assert 700 < sample(tx, 0.1).count() < 1300


def test_command_line(spark, tmp):
    from txprep.__main__ import main
    src = f"{tmp}/raw"
    fixtures.tx(spark, SF["0.001"]).write.option("header", True).csv(src)
    out = main(["prepare", "--input", f"{src}/*.csv", "--output", f"{tmp}/ml_ready_data", "--min-rows", "1000",
                "--report", f"{tmp}/r1"], spark=spark)
    assert out["output_rows"] == 934 and [w[2] for w in out["waterfall"]] == [1020, 971, 971, 953, 934]
    lines = [r["value"] for r in spark.read.text(out["report"]["text"]).collect()]
    assert lines[0].startswith("PREPARE") and "== RUN ==" in lines and "== WATERFALL ==" in lines
    prof = main(["profile", "--path", f"{tmp}/ml_ready_data", "--report", f"{tmp}/r2"], spark=spark)
    got = {(r["section"], r["item"], r["metric"]): r["value"]
           for r in spark.read.json(prof["report"]["json"]).collect()}
    assert got[("general", "", "total_rows")] == 934


def test_prepare_from_json_input(spark, tmp):
    from txprep.plans import prepare
    fixtures.tx(spark, SF["0.001"]).write.json(f"{tmp}/raw")
    res = prepare(spark, f"{tmp}/raw", f"{tmp}/out", min_rows=1000, source_format="json")
    assert [w[2] for w in res.waterfall] == [1020, 971, 971, 953, 934]


def test_prepare_with_nothing_valid_and_with_no_rows(spark, tmp):
    from txprep.plans import prepare
    tx = fixtures.tx(spark, SF["0.001"])
    for name, src in (("invalid", tx.withColumn("tx_fraud", F.lit(2).cast("tinyint"))), ("empty", tx.limit(0))):
        for method in ("sketch", "exact", "approx"):
            res = prepare(spark, src, f"{tmp}/{name}-{method}", method=method)
            assert res.output_rows == 0 and res.bounds["applied"] is False
            assert res.waterfall[0][2] == (0 if name == "empty" else 1020)
            assert [w[2] for w in res.waterfall[1:]] == [0, 0, 0, 0]
            assert res.to_metrics(spark).count() > 0
