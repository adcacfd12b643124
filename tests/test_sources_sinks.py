"""Readers, inventory, writers."""

import warnings
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF
from txprep import fixtures
from txprep.operators import report_metrics
from txprep.schema import TX_SCHEMA
from txprep.sinks import write_json, write_partitioned, write_text_report
from txprep.sources import inventory, inventory_totals, read_delimited, read_json, read_untyped


def test_delimited_is_permissive_and_positional(spark, tmp):
    p = f"{tmp}/a.txt"
    with open(p, "w") as f:
        f.write("x,y,z,a,b,c,d,e,f\n")                                  # names ignored: positional
        f.write('5,"2024-01-01 10:00:00",1,2,10.555,3,4,1,300\n')       # rounding, byte overflow
        f.write("6,2024-01-01 11:00:00,abc,2,1.5,3,4,0,0,extra\n")      # bad int, extra field
        f.write("7,short\n")                                            # short row
    rows = {r["transaction_id"]: r for r in read_delimited(spark, p).collect()}
    assert rows[5]["tx_amount"] == Decimal("10.56") and rows[5]["tx_fraud_scenario"] is None
    assert rows[6]["customer_id"] is None and rows[6]["tx_fraud_scenario"] == 0
    assert rows[7]["tx_datetime"] == "short" and rows[7]["customer_id"] is None
    assert read_untyped(spark, p).columns[:2] == ["x", "y"]
    full = read_delimited(spark, p, corrupt_column="_corrupt_record").collect()   # every column parsed
    bad = {r["transaction_id"]: r["_corrupt_record"] for r in full}
    assert bad[5].startswith("5,") and bad[6].startswith("6,") and bad[7] == "7,short"


def test_json_reader(spark, tmp):
    fixtures.tx(spark, SF["0.001"]).write.json(f"{tmp}/j")
    df = read_json(spark, f"{tmp}/j")
    assert df.schema == TX_SCHEMA and df.count() == 1020


def test_inventory_counts_each_file_once(spark, tmp):
    tx = fixtures.tx(spark, SF["0.001"])
    tx.write.partitionBy("tx_fraud").parquet(f"{tmp}/ds")              # nested parquet
    tx.coalesce(1).write.option("header", True).csv(f"{tmp}/c")         # csv with header
    with open(f"{tmp}/notes.txt", "w") as f:
        f.write("h\n1\n2\n3\n")
    tx.coalesce(2).write.json(f"{tmp}/j")
    inv = inventory(spark, tmp)
    by_fmt = {r["format"]: (r["files"], r["rows"]) for r in inventory_totals(inv).collect()}
    assert by_fmt["parquet"][1] == 1020 and by_fmt["csv"] == (1, 1020) and by_fmt["txt"] == (1, 3)
    assert by_fmt["json"][1] == 1020
    assert inv.filter(F.col("format") == "parquet").count() == by_fmt["parquet"][0]


def test_inventory_missing_path_is_empty(spark, tmp):
    with warnings.catch_warnings():
        warnings.simplefilter("error")            # a missing path is not worth a warning
        assert inventory(spark, f"{tmp}/nope").count() == 0


def test_partitioned_write_label_last_as_int(spark, tmp):
    df = fixtures.tx(spark, SF["0.001"]).filter("tx_fraud IN (0, 1)")
    write_partitioned(df, f"{tmp}/o", partitions=2, max_records_per_file=100)
    back = spark.read.parquet(f"{tmp}/o")
    assert back.columns[-1] == "tx_fraud" and dict(back.dtypes)["tx_fraud"] == "int"
    assert back.count() == df.count()
    files = back.select(F.input_file_name()).distinct().count()
    assert files >= df.count() // 100


def test_report_sinks(spark, tmp):
    m = report_metrics(fixtures.tx(spark, SF["0.001"]), label="tx_fraud")
    write_json(m, f"{tmp}/j")
    assert spark.read.json(f"{tmp}/j").count() == m.count()
    write_text_report(m, f"{tmp}/t", title="REPORT")
    lines = [r["value"] for r in spark.read.text(f"{tmp}/t").collect()]
    sections = m.select("section").distinct().count()
    columns = m.filter("section = 'schema'").select("item").distinct().count()
    assert len(lines) == m.filter("section != 'schema'").count() + columns + sections + 1
    assert lines[:2] == ["REPORT", "== GENERAL =="]
    at = lines.index("== CLASS_DISTRIBUTION ==")
    assert "class_0" in lines[at + 1]


def test_inventory_names_a_bad_file_and_counts_the_good_ones(spark, tmp):
    from txprep.plans import analyze
    spark.range(50).write.option("header", True).csv(f"{tmp}/a")
    spark.range(100).coalesce(1).write.parquet(f"{tmp}/b")
    with open(f"{tmp}/b/broken.parquet", "wb") as f:
        f.write(b"PAR1 this is no parquet file PAR1")
    rows = inventory(spark, tmp).collect()
    bad = [r for r in rows if r["error"] is not None]
    assert [r["file"] for r in bad] == ["broken.parquet"] and bad[0]["rows"] is None and len(bad[0]["error"]) > 20
    assert sum(r["rows"] for r in rows if r["format"] == "parquet" and r["rows"]) == 100
    assert sum(r["rows"] for r in rows if r["format"] == "csv") == 50
    m = analyze(spark, tmp).collect()
    assert [r["item"].rsplit("/", 1)[1] for r in m if r["section"] == "errors"] == ["broken.parquet"]
    assert [r["value"] for r in m if r["metric"] == "total_rows"] == [150.0]
