"""Results stay whole and exact when one key holds a third of the rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF
from txprep import fixtures
from txprep.operators import class_distribution, dedup, exact_quantiles


def hot_lineitem(spark):
    li = fixtures.table(spark, SF["0.01"], "lineitem")
    # lines 1-2 of every order go to one key: about a third of all rows
    return li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_orderkey")))


def test_dedup_with_a_hot_key_matches_brute_force(spark):
    df = hot_lineitem(spark).repartition(8)
    hot = df.filter("l_orderkey = 1").count()
    assert hot > df.count() / 4
    got = dedup(df, "l_orderkey")
    others = [c for c in df.columns if c != "l_orderkey"]
    w = Window.partitionBy("l_orderkey").orderBy(*[F.col(c).asc_nulls_first() for c in others])
    ref = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    assert got.count() == ref.count() == df.select("l_orderkey").distinct().count()
    assert got.exceptAll(ref).count() == 0


def test_counts_and_quantiles_with_a_hot_value(spark):
    df = hot_lineitem(spark).repartition(8)
    n, q = exact_quantiles(df, "l_orderkey", {"med": 0.5, "p10": 0.1})
    keys = sorted(r[0] for r in df.select("l_orderkey").collect())
    assert q["p10"] == 1 and q["med"] == keys[len(keys) // 2 - (0 if len(keys) % 2 else 1)]
    dist = {r["l_returnflag"]: r["count"] for r in class_distribution(df, "l_returnflag").collect()}
    assert sum(dist.values()) == n == len(keys)
