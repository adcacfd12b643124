"""Golden values of FIXTURES.md section 6, at two scale factors."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from txprep import fixtures
from txprep.operators import outlier_bounds, resolve_bounds, validate, waterfall
from txprep.plans import ml_ready, prepare
from txprep.sinks import write_partitioned

GOLDEN = {
    "0.001": dict(stages=[1020, 971, 971, 953, 934], q=("14.81", "71.74", "0.53", "253.94"), applied=False,
                  classes=(751, 183), sums=(10824, 3691, 252, 326, 347, 907), log=3159.1399, with_hour=926,
                  nulls=(9, 10, 10)),
    "0.01": dict(stages=[10200, 9756, 9533, 9347, 9179], q=("14.48", "69.58", "0.31", "258.37"), applied=True,
                 bounds=("0.31", "234.88"), classes=(7335, 1844), sums=(104530, 35859, 2400, 3386, 3428, 8721),
                 log=30761.295, with_hour=9108, nulls=(79, 101, 94)),
}


@pytest.mark.parametrize("sf", list(GOLDEN))
def test_waterfall_and_bounds(spark, sf):
    g = GOLDEN[sf]
    tx = fixtures.tx(spark, SF[sf])
    b = resolve_bounds(outlier_bounds(validate(tx), min_rows=1000))
    assert [str(b[k]) for k in ("q1", "q3", "p1", "p99")] == list(g["q"])
    assert b["applied"] is g["applied"]
    if "bounds" in g:
        assert (str(b["lo"]), str(b["hi"])) == g["bounds"]
    rows = [r["rows"] for r in waterfall(tx, b).orderBy("stage").collect()]
    assert rows == g["stages"]


@pytest.mark.parametrize("sf", list(GOLDEN))
def test_ml_ready_features(spark, sf):
    g = GOLDEN[sf]
    df = ml_ready(fixtures.tx(spark, SF[sf]), min_rows=1000)
    cols = ["tx_hour", "tx_day_of_week", "is_weekend", "is_night", "is_business_hours", "amount_category"]
    r = df.agg(*[F.sum(c).alias(c) for c in cols], F.sum("tx_amount_log").alias("log"),
               F.count("tx_hour").alias("h"), F.count_if(F.col("tx_fraud") == 0).alias("c0"),
               F.count_if(F.col("tx_fraud") == 1).alias("c1")).first()
    assert tuple(r[c] for c in cols) == g["sums"]
    assert round(r["log"], 4) == pytest.approx(g["log"], abs=1e-4)
    assert r["h"] == g["with_hour"]
    assert (r["c0"], r["c1"]) == g["classes"]


@pytest.mark.parametrize("sf", list(GOLDEN))
def test_prepare_job(spark, sf, tmp):
    g = GOLDEN[sf]
    src = f"{tmp}/in"
    fixtures.tx(spark, SF[sf]).write.option("header", True).csv(src)
    res = prepare(spark, src, f"{tmp}/out", min_rows=1000)
    assert [w[2] for w in res.waterfall] == g["stages"]
    assert (res.class_counts[0], res.class_counts[1]) == g["classes"]
    n = res.null_profile
    assert (n["customer_id"], n["tx_amount"], n["tx_fraud_scenario"]) == g["nulls"]
    c = res.clean_null_profile
    assert c["customer_id"] == c["tx_amount"] == c["tx_fraud_scenario"] == 0
    assert c["tx_datetime"] == 0 and set(c) == set(n)
    back = spark.read.parquet(f"{tmp}/out")
    assert back.columns[-1] == "tx_fraud" and dict(back.dtypes)["tx_fraud"] == "int"
    assert back.count() == g["stages"][-1] == res.output_rows
    assert res.partitions == 50
    assert res.retention_pct == pytest.approx(100.0 * g["stages"][-1] / g["stages"][0])
    m = {(r["section"], r["item"], r["metric"]): r for r in res.to_metrics(spark).collect()}
    assert m[("waterfall", "consistency", "rows")]["value"] == g["stages"][-1]
    assert m[("waterfall", "dedup", "removed")]["value"] == g["stages"][2] - g["stages"][3]
    assert m[("null_profile", "customer_id", "nulls")]["value"] == g["nulls"][0]
    assert m[("general", "", "output_path")]["text"] == f"{tmp}/out"


@pytest.mark.parametrize("method", ["sketch", "approx"])
def test_prepare_sketch_methods_near_exact(spark, tmp, method):
    from decimal import Decimal
    src = f"{tmp}/in"
    fixtures.tx(spark, SF["0.01"]).write.option("header", True).csv(src)
    res = prepare(spark, src, f"{tmp}/out", method=method)
    assert [w[2] for w in res.waterfall[:2]] == [10200, 9756]
    assert abs(res.bounds["lo"] - Decimal("0.31")) <= Decimal("0.05")
    assert abs(res.bounds["hi"] - Decimal("234.88")) <= Decimal("3")
    assert abs(res.waterfall[2][2] - 9533) <= 25 and abs(res.output_rows - 9179) <= 25


def test_prepare_refuses_any_overlap_of_output_and_input(spark, tmp):
    import glob
    raw = f"{tmp}/p/raw"
    fixtures.tx(spark, SF["0.001"]).repartition(2).write.option("header", True).csv(raw)
    fixtures.tx(spark, SF["0.001"]).write.parquet(f"{tmp}/q/raw")
    before = sorted(glob.glob(f"{tmp}/[pq]/raw/part-*"))
    frame = spark.read.parquet(f"{tmp}/q/raw")
    for source, out in [(raw, raw), (raw, raw + "/"), (raw + "/", f"file://{raw}"), (raw + "/*.csv", raw), ([raw], raw),
                        (raw, f"{tmp}/p"), (raw, f"{raw}/inside"), (f"{tmp}/p/*/part-*.csv", f"{tmp}/p/raw"),
                        (frame, f"{tmp}/q/raw"), (frame, f"{tmp}/q"), (frame.filter("transaction_id > 5"), f"{tmp}/q/raw/")]:
        with pytest.raises(ValueError, match="overlaps"):
            prepare(spark, source, out)
    with pytest.raises(ValueError, match="overlaps"):
        write_partitioned(frame, f"{tmp}/q/raw")
    assert sorted(glob.glob(f"{tmp}/[pq]/raw/part-*")) == before
    assert prepare(spark, raw, f"{tmp}/p/raw2").output_rows > 0           # a name that only begins alike


def test_prepare_is_reproducible_and_takes_its_parameters(spark, tmp):
    src = f"{tmp}/in"
    fixtures.tx(spark, SF["0.001"]).write.option("header", True).csv(src)
    a, b = prepare(spark, src, f"{tmp}/a"), prepare(spark, src, f"{tmp}/b")
    assert a.waterfall == b.waterfall and a.bounds == b.bounds and a.bounds["applied"]
    more = prepare(spark, src, f"{tmp}/c", label_classes=(0, 1, 2), iqr_factor=1)
    assert set(more.class_counts) == {0, 1, 2} and more.class_counts[2] > 0
    assert more.bounds["hi"] < a.bounds["hi"]
