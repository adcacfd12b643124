"""Run as a script (own JVM, retries allowed): the result stage after the
observe() node fails its first attempt once; the observed counts must still
equal the true counts, i.e. the failed attempt's metrics are not added."""

from pyspark import TaskContext
from pyspark.sql import SparkSession, Observation, functions as F
spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.sql.adaptive.enabled", "true").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")

@F.udf("boolean")
def flaky(x):   # test only: fail the first attempt of partition 0
    tc = TaskContext.get()
    if tc.partitionId() == 0 and tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True

keyed = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
obs = Observation("o")
out = keyed.observe(obs, F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows")).filter(flaky(F.col("n")))
out.write.format("noop").mode("overwrite").save()
truth = (li.select("l_orderkey").distinct().count(), li.count())
print("observed", obs.get, "truth", truth, "equal", (obs.get["keys"], obs.get["rows"]) == truth)
