"""Exact distributed percentiles against a brute-force sort."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from txprep.operators import exact_quantiles, quantiles

PROBS = {"p0": 0.0, "p1": 0.01, "q1": 0.25, "med": 0.5, "q3": 0.75, "p99": 0.99, "p100": 1.0}


def brute(values, p):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    return v[max(1, math.ceil(p * len(v))) - 1]


def check(spark, values, typ, **kw):
    df = spark.createDataFrame([(x,) for x in values], f"x {typ}")
    n, got = exact_quantiles(df, "x", PROBS, **kw)
    assert n == sum(x is not None for x in values)
    for k, p in PROBS.items():
        assert got[k] == brute(values, p), (k, p)


def test_decimal_with_hot_value(spark):
    rnd = random.Random(1)
    vals = [Decimal(rnd.randint(0, 100000)) / 100 for _ in range(3000)] + [Decimal("12.34")] * 2000
    vals += [None] * 50
    check(spark, vals, "decimal(10,2)")


def test_doubles_wide_range(spark):
    rnd = random.Random(2)
    vals = [rnd.lognormvariate(0, 6) for _ in range(4000)] + [-1e300, 1e300, 0.0, 1e-300]
    check(spark, vals, "double")


def test_longs_that_collide_as_doubles(spark):
    base = 2 ** 60
    vals = [base + i for i in range(0, 40)] * 3 + [1, 2, 3]
    check(spark, vals, "bigint")


def test_tiny_sketch_forces_full_range_fallback(spark):
    # accuracy 1 gives a useless bracket: the verification must reset it
    rnd = random.Random(3)
    vals = [rnd.randint(-50, 50) for _ in range(500)]
    check(spark, vals, "int", accuracy=1, buckets=4)


def test_empty_and_single(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", {"m": 0.5}) == (0, {"m": None})
    check(spark, [7.5], "double")


def test_matches_percentile_disc(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.randint(0, 997),) for _ in range(2500)], "x int")
    exact = quantiles(df, "x", {"a": 0.1, "b": 0.9}, method="exact").first()
    ref = df.select(F.expr("percentile_disc(0.1) WITHIN GROUP (ORDER BY x)").alias("a"),
                    F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY x)").alias("b")).first()
    assert (exact["a"], exact["b"]) == (int(ref["a"]), int(ref["b"]))


def test_approx_and_exact_share_a_schema(spark):
    df = spark.createDataFrame([(Decimal(i) / 10,) for i in range(100)], "x decimal(10,2)")
    a = quantiles(df, "x", {"m": 0.5}, method="approx")
    e = quantiles(df, "x", {"m": 0.5}, method="exact")
    assert a.dtypes == e.dtypes == [("n", "bigint"), ("m", "decimal(10,2)")]
    with pytest.raises(ValueError):
        quantiles(df, "x", {"m": 0.5}, method="nope")


def test_sketch_tree_accuracy_and_plan(spark):
    import bisect
    from conftest import SF
    li = spark.read.parquet(f"{SF['0.01']}/lineitem.parquet").repartition(16)
    probs = {"p1": 0.01, "q1": 0.25, "q3": 0.75, "p99": 0.99}
    df = quantiles(li, "l_extendedprice", probs, method="sketch")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_g") == 1   # per task group, then once more, at every size
    many = li.repartition(300)
    tree = quantiles(many, "l_extendedprice", probs, method="sketch")
    plan = tree._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_g" in plan        # merged per task group, then once more
    assert tree.first()["n"] == li.count()
    got = df.first()
    vals = sorted(r[0] for r in li.select("l_extendedprice").collect())
    assert got["n"] == len(vals)
    for k, p in probs.items():
        rank = bisect.bisect_right(vals, got[k]) / len(vals)
        assert abs(rank - p) < 2e-3, (k, rank, p)
    dec = spark.createDataFrame([(Decimal(i) / 100,) for i in range(1, 2001)], "x decimal(10,2)")
    q = quantiles(dec, "x", {"m": 0.5}, method="sketch").first()
    assert isinstance(q["m"], Decimal) and abs(q["m"] - Decimal("10.00")) <= Decimal("0.05")
    assert quantiles(dec.limit(0), "x", {"m": 0.5}, method="sketch").first() == (0, None)


def test_nan_and_infinities_are_ranked_and_cheap(spark):
    import math
    x = [float("nan")] * 50 + [float("-inf")] * 20 + [float("inf")] * 30 + [i / 7 for i in range(900)]
    df = spark.createDataFrame([(v,) for v in x], "x double").repartition(4)
    probs = {"a": 0.01, "b": 0.02, "c": 0.5, "d": 0.93, "e": 0.96}
    want = sorted(v for v in x if not math.isnan(v))
    spark.sparkContext.setJobGroup("nan", "")
    n, got = exact_quantiles(df, "x", probs)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("nan")
    spark.sparkContext.setJobGroup("", "")
    assert n == 1000 and len(jobs) <= 12          # each pass over the data is a job per shuffle stage and one for the result
    for k, p in probs.items():
        r = math.ceil(p * 1000)
        assert math.isnan(got[k]) if r > len(want) else got[k] == want[r - 1], k
    n, got = exact_quantiles(spark.createDataFrame([(float("nan"),)] * 3, "x double"), "x", {"m": 0.5})
    assert n == 3 and math.isnan(got["m"])


def test_wide_decimals_and_extreme_doubles(spark):
    from decimal import Decimal
    vals = [Decimal("1500000000000.000000000000000001") + i for i in range(50)]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(38,18)")
    assert exact_quantiles(df, "x", {"m": 0.5})[1]["m"] == vals[24]
    xs = [-1.7e308, -1.0, 0.0, 5e-324, 1e-300, 2e-300, 1.0, 1.7e308]
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    got = exact_quantiles(df, "x", {str(i): (i + 1) / 8 for i in range(8)})[1]
    assert [got[str(i)] for i in range(8)] == xs
