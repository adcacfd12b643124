"""The stages take their columns from TxColumns: a renamed table gives the
same results as the original layout."""

from pyspark.sql import functions as F

from conftest import SF
from txprep import fixtures
from txprep.operators import outlier_bounds, resolve_bounds, validate, waterfall
from txprep.plans import ml_ready, prepare
from txprep.schema import TxColumns

RENAME = {"transaction_id": "id", "tx_datetime": "at", "customer_id": "buyer", "terminal_id": "device",
          "tx_amount": "amt", "tx_fraud": "y", "tx_fraud_scenario": "why"}
ROLES = TxColumns(id="id", datetime="at", customer="buyer", terminal="device", amount="amt", label="y",
                  scenario="why")


def renamed(df):
    return df.select(*[F.col(c).alias(RENAME.get(c, c)) for c in df.columns])


def test_waterfall_with_other_names(spark):
    tx = fixtures.tx(spark, SF["0.01"])
    other = renamed(tx)
    b = resolve_bounds(outlier_bounds(validate(other, ROLES), ROLES, method="exact"))
    assert (str(b["lo"]), str(b["hi"])) == ("0.31", "234.88")
    assert [r["rows"] for r in waterfall(other, b, ROLES).orderBy("stage").collect()] == \
        [10200, 9756, 9533, 9347, 9179]


def test_ml_ready_with_other_names(spark):
    tx = fixtures.tx(spark, SF["0.001"])
    out = ml_ready(renamed(tx), ROLES, min_rows=1000)
    ref = renamed(ml_ready(tx, min_rows=1000))
    assert out.columns == ref.columns and out.columns[:4] == ["id", "buyer", "device", "amt"]
    assert out.count() == ref.count() == 934
    assert out.exceptAll(ref).count() == 0 and ref.exceptAll(out).count() == 0


def test_prepare_with_other_names(spark, tmp):
    res = prepare(spark, renamed(fixtures.tx(spark, SF["0.01"])), f"{tmp}/o", cols=ROLES, method="exact")
    assert [w[2] for w in res.waterfall] == [10200, 9756, 9533, 9347, 9179]
    back = spark.read.parquet(f"{tmp}/o")
    assert back.columns[-1] == "y" and back.count() == 9179
    assert len(back.columns) == 15
