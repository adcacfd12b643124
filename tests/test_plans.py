"""Physical-plan guardrails for the scale design."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import Row

from conftest import SF
from txprep import fixtures
from txprep.operators import add_features, clean, dedup, null_profile, validate
from txprep.plans.catalog import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def full_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # untruncated scan details
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def tx_parquet(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("txpq"))
    fixtures.tx(spark, SF["0.01"]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_fence_and_rules_reach_the_parquet_reader(tx_parquet):
    b = Row(applied=True, lo=Decimal("0.31"), hi=Decimal("234.88"))
    plan = plan_of(clean(tx_parquet, bounds=b))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    for f in ("GreaterThanOrEqual(tx_amount,0.31)", "LessThanOrEqual(tx_amount,234.88)",
              "In(tx_fraud, [0,1])", "GreaterThan(transaction_id,0)"):
        assert f in pushed


def test_dedup_is_a_partial_aggregate_not_a_window(tx_parquet):
    plan = plan_of(dedup(validate(tx_parquet), "transaction_id"))
    assert "Window" not in plan
    assert plan.count("Exchange hashpartitioning(transaction_id") == 1
    # partial aggregation below the exchange: duplicates combine map-side
    below = plan.split("Exchange hashpartitioning(transaction_id")[1]
    assert "partial_min" in below


def test_features_prune_columns(spark):
    df = add_features(fixtures.tx(spark, SF["0.001"])).select("transaction_id", "tx_hour")
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(df))
    assert scans and all(len(s.split(",")) <= 3 for s in scans)


def test_profile_is_one_aggregation(tx_parquet):
    plan = plan_of(null_profile(tx_parquet))
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan


@pytest.mark.parametrize("name", ["clean", "ml_ready", "clean_waterfall", "report_metrics", "inventory",
                                  "validate_rule_counts", "class_distribution"])
def test_no_pairwise_or_broadcast_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF["0.001"]))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BroadcastExchange"):
        assert bad not in plan


def test_bucketed_input_needs_no_key_shuffle(spark):
    fixtures.tx(spark, SF["0.001"]).write.mode("overwrite").bucketBy(8, "transaction_id") \
        .saveAsTable("tx_bucketed_by_id")
    df = dedup(validate(spark.table("tx_bucketed_by_id")), "transaction_id")
    assert "Exchange hashpartitioning(transaction_id" not in plan_of(df)
    assert df.count() == 953


def test_waterfall_is_one_scan_without_window(spark, tx_parquet):
    from txprep.operators import waterfall
    b = Row(applied=True, lo=Decimal("0.31"), hi=Decimal("234.88"))
    plan = plan_of(waterfall(tx_parquet, b))
    assert "Window" not in plan and plan.count("FileScan") == 1
    empty = waterfall(tx_parquet.limit(0), b).orderBy("stage").collect()
    assert [r["rows"] for r in empty] == [0] * 5 and all(r["pct_of_input"] is None for r in empty)
