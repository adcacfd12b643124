"""Registered queries: one Spark callable per operator key, with the
equivalent DuckDB SQL where one exists.

Every query reads the test tables of ``sf_dir`` (the ``tx`` fixture is
derived from ``events`` by Spark), whole, so its work grows with them.
Oracle SQL sees the same tables as views and rebuilds ``tx`` as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..fixtures import oracle_with_tx
from ..operators import (add_features, add_files, check_consistency, class_distribution, clean, dedup, dedup_known,
                         null_profile, numeric_stats, outlier_bounds, partition_count,
                         plan_partitions_col, quantiles, remove_outliers, repartition_hot, report_metrics,
                         resolve_bounds, row_count, rule_failures, sample, stored_metrics, stored_nulls, stored_quantiles,
                         validate, waterfall)
from ..operators.cleaning import OUTLIER_PROBS
from ..operators.profile import METRIC_SCHEMA
from ..schema import DEFAULT_COLUMNS as C
from ..schema import ML_READY_COLUMNS, TX_SCHEMA
from ..scratch import scratch_path
from ..sinks import write_json, write_partitioned, write_text_report
from ..sources import (footer_count, inventory, inventory_totals, quarantine, read_delimited, read_json, read_parquet,
                       read_untyped)
from .prepare import ml_ready, prepare
from .report import analyze

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ SQL parts
TX_COLS = ("transaction_id, tx_datetime, customer_id, terminal_id, tx_amount, "
           "tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario")
V = ("v", """SELECT * FROM tx WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL
  AND terminal_id IS NOT NULL AND tx_amount IS NOT NULL AND tx_fraud IS NOT NULL
  AND tx_amount >= 0 AND tx_fraud IN (0, 1) AND customer_id >= 0 AND terminal_id >= 0
  AND transaction_id > 0""")
Q = ("q", """SELECT count(*) AS n, quantile_disc(tx_amount, 0.25) AS q1,
  quantile_disc(tx_amount, 0.75) AS q3, quantile_disc(tx_amount, 0.01) AS p1,
  quantile_disc(tx_amount, 0.99) AS p99 FROM v""")
B = ("b", """SELECT n, q1, q3, p1, p99,
  CAST(greatest(q1 - 3 * (q3 - q1), p1) AS DECIMAL(10,2)) AS lo,
  CAST(least(q3 + 3 * (q3 - q1), p99) AS DECIMAL(10,2)) AS hi,
  q1 IS NOT NULL AS applied FROM q""")
FENCE = ("f", """SELECT * FROM v WHERE (SELECT NOT applied FROM b)
  OR tx_amount BETWEEN (SELECT lo FROM b) AND (SELECT hi FROM b)""")
DEDUP = ("d", f"""SELECT {TX_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY tx_datetime NULLS FIRST,
    customer_id NULLS FIRST, terminal_id NULLS FIRST, tx_amount NULLS FIRST,
    tx_time_seconds NULLS FIRST, tx_time_days NULLS FIRST, tx_fraud NULLS FIRST,
    tx_fraud_scenario NULLS FIRST) AS rn FROM f) WHERE rn = 1""")
CONSISTENT = "NOT (tx_fraud = 1 AND tx_fraud_scenario = 0) AND NOT (tx_fraud = 0 AND tx_fraud_scenario > 0)"
CLEAN = ("c", f"SELECT * FROM d WHERE {CONSISTENT}")
CLEAN_CTES = [V, Q, B, FENCE, DEDUP, CLEAN]


def feature_ctes(src: str):
    return [("t0", f"SELECT *, try_cast(tx_datetime AS TIMESTAMP) AS ts FROM {src}"),
            ("t1", """SELECT *, CAST(hour(ts) AS INTEGER) AS tx_hour,
  CAST(dayofweek(ts) + 1 AS INTEGER) AS tx_day_of_week FROM t0"""),
            ("fe", """SELECT *,
  CASE WHEN tx_day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN tx_hour >= 22 OR tx_hour <= 6 THEN 1 ELSE 0 END AS is_night,
  CASE WHEN tx_hour >= 9 AND tx_hour <= 17 THEN 1 ELSE 0 END AS is_business_hours,
  CASE WHEN tx_amount > 0 THEN ln(tx_amount) ELSE CAST(0 AS DOUBLE) END AS tx_amount_log,
  CASE WHEN tx_amount <= 10 THEN 0 WHEN tx_amount <= 100 THEN 1
       WHEN tx_amount <= 1000 THEN 2 ELSE 3 END AS amount_category
FROM t1""")]


ML_SELECT = ", ".join(ML_READY_COLUMNS)
ML_READY_CTES = CLEAN_CTES + feature_ctes("c") + [
    ("ml", f"SELECT {ML_SELECT} FROM fe WHERE tx_amount_log IS NOT NULL")]


def pct(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({whole} AS DOUBLE)"


# ------------------------------------------------------------------ helpers
def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.tx(spark, sf_dir)


def exact_bounds(spark, sf_dir):
    valid = validate(tx(spark, sf_dir))
    return resolve_bounds(outlier_bounds(valid, method="exact"))


def cleaned(spark, sf_dir) -> DataFrame:
    return clean(tx(spark, sf_dir), method="exact")


def ml(spark, sf_dir) -> DataFrame:
    return ml_ready(tx(spark, sf_dir), method="exact")


def written_ml_ready(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "ml_ready")
    out = ml(spark, sf_dir)
    write_partitioned(out, path, label="tx_fraud")
    return read_parquet(spark, path)


# ------------------------------------------------------------------ scans
@register("row_count", oracle_with_tx("SELECT count(*) AS rows FROM tx"))
def q_row_count(spark, sf_dir):
    return row_count(tx(spark, sf_dir))


@register("row_count_footers", "SELECT count(*) AS rows FROM lineitem")
def q_row_count_footers(spark, sf_dir):
    return footer_count(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")


@register("src_csv_typed", oracle_with_tx(f"SELECT {TX_COLS} FROM tx"))
def q_src_csv_typed(spark, sf_dir):
    path = scratch_path(spark, "tx_csv")
    tx(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)
    return read_delimited(spark, path, TX_SCHEMA)


@register("src_csv_untyped", oracle_with_tx(
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in TX_COLS.split(", ")) + " FROM tx"))
def q_src_csv_untyped(spark, sf_dir):
    path = scratch_path(spark, "tx_csv")
    tx(spark, sf_dir).write.option("header", True).csv(path)
    return read_untyped(spark, path)


@register("src_parquet", oracle_with_tx(
    "SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, "
    "tx_time_days, tx_fraud_scenario, CAST(tx_fraud AS INTEGER) AS tx_fraud FROM tx"))
def q_src_parquet(spark, sf_dir):
    path = scratch_path(spark, "tx_parquet")
    tx(spark, sf_dir).write.partitionBy("tx_fraud").parquet(path)
    return read_parquet(spark, path)


@register("src_glob", oracle_with_tx(f"SELECT {TX_COLS} FROM tx"))
def q_src_glob(spark, sf_dir):
    path = scratch_path(spark, "tx_glob")
    tx(spark, sf_dir).repartition("transaction_id").write.option("header", True).csv(path)
    return read_delimited(spark, f"{path}/part-*.csv", TX_SCHEMA)


@register("src_json", oracle_with_tx(f"SELECT {TX_COLS} FROM tx"))
def q_src_json(spark, sf_dir):
    path = scratch_path(spark, "tx_json")
    tx(spark, sf_dir).write.json(path)
    return read_json(spark, path, TX_SCHEMA)


INVENTORY_FILES = [(t, f"{t}.parquet") for t in fixtures.TABLES]
INVENTORY_SQL = " UNION ALL ".join(
    f"SELECT 'parquet' AS format, '{f}' AS file, count(*) AS rows FROM {t}" for t, f in INVENTORY_FILES)


@register("inventory", INVENTORY_SQL)
def q_inventory(spark, sf_dir):
    return inventory(spark, sf_dir).select("format", "file", "rows")


@register("inventory_totals",
          f"SELECT format, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows FROM ({INVENTORY_SQL}) i "
          "GROUP BY format")
def q_inventory_totals(spark, sf_dir):
    return inventory_totals(inventory(spark, sf_dir))


@register("plan_partitions", f"""SELECT file, rows,
  CAST(greatest(CASE WHEN rows > 1000000 THEN rows // 1000000 ELSE 50 END, 50) AS BIGINT) AS partitions,
  CAST(greatest(least(CASE WHEN rows > 1000 THEN rows // 1000 ELSE 50 END, 200), 50) AS BIGINT) AS partitions_per_1k
FROM ({INVENTORY_SQL}) i""")
def q_plan_partitions(spark, sf_dir):
    inv = inventory(spark, sf_dir)
    return inv.select("file", "rows", plan_partitions_col(F.col("rows")).alias("partitions"),
                      plan_partitions_col(F.col("rows"), rows_per_partition=1000, max_partitions=200).alias("partitions_per_1k"))


@register("repartition", oracle_with_tx(f"SELECT {TX_COLS} FROM tx"))
def q_repartition(spark, sf_dir):
    return tx(spark, sf_dir).repartition("transaction_id")


HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END"
HOT_PARTS = 16


@register("repartition_hot", f"""SELECT count(*) AS rows, CAST(sum(k) AS BIGINT) AS keys, count(*) FILTER (WHERE k = 0) AS hot_rows,
  count(*) > 0 AS spread FROM (SELECT {HOT} AS k FROM lineitem) s""")
def q_repartition_hot(spark, sf_dir):
    # a third of the rows have one key; no partition may hold twice its share all the same
    li = fixtures.table(spark, sf_dir, "lineitem").select(F.expr(HOT).alias("k"))
    parts = repartition_hot(li, "k", HOT_PARTS).groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("s"), F.count_if(F.col("k") == 0).alias("hot"))
    return parts.agg(F.sum("n").alias("rows"), F.sum("s").alias("keys"), F.sum("hot").alias("hot_rows"),
                     (F.max("n") * HOT_PARTS <= 2 * F.sum("n")).alias("spread"))


REJECT_COLS = TX_COLS.split(", ")


def reject_line() -> str:
    """A line of the fixture, as text: some with a bad amount, a bad scenario, a
    field too many or too few, by the number of the transaction. Runs in both engines."""
    amount = "CASE WHEN transaction_id % 17 = 3 THEN 'n/a' ELSE coalesce(CAST(tx_amount AS VARCHAR(40)), '') END"
    scenario = "CASE WHEN transaction_id % 19 = 4 THEN '300' ELSE coalesce(CAST(tx_fraud_scenario AS VARCHAR(40)), '') END"
    texts = [amount if c == "tx_amount" else scenario if c == "tx_fraud_scenario" else f"coalesce(CAST({c} AS VARCHAR(40)), '')"
             for c in REJECT_COLS]
    whole = " || ',' || ".join(texts)
    return (f"CASE WHEN transaction_id % 23 = 5 THEN {whole} || ',more' "
            f"WHEN transaction_id % 29 = 6 THEN CAST(transaction_id AS VARCHAR(40)) || ',short' ELSE {whole} END")


REJECT_CAUSE = """CASE WHEN transaction_id % 23 <> 5 AND transaction_id % 29 = 6 THEN 'fields'
  WHEN transaction_id % 17 = 3 THEN 'tx_amount' WHEN transaction_id % 19 = 4 THEN 'tx_fraud_scenario'
  WHEN transaction_id % 23 = 5 THEN 'fields' END"""


def quarantined(spark, sf_dir):
    path = scratch_path(spark, "tx_lines")
    lines = tx(spark, sf_dir).select(F.expr(reject_line()).alias("value"))
    lines.write.text(path)
    return quarantine(spark, path, scratch_path(spark, "quarantine"), TX_SCHEMA, header=False)


@register("src_csv_rejects", oracle_with_tx(
    f"SELECT * FROM (SELECT {reject_line()} AS line, {REJECT_CAUSE} AS cause FROM tx) s WHERE cause IS NOT NULL"))
def q_src_csv_rejects(spark, sf_dir):
    return quarantined(spark, sf_dir)[1].select(F.col("_line").alias("line"), F.col("_cause").alias("cause"))


@register("src_csv_accepted", oracle_with_tx(
    f"SELECT {TX_COLS} FROM (SELECT *, {REJECT_CAUSE} AS cause FROM tx) s WHERE cause IS NULL"))
def q_src_csv_accepted(spark, sf_dir):
    return quarantined(spark, sf_dir)[0]


def renamed(spark, folder: str, name: str) -> None:
    """The one part file of ``folder`` under another name."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    part = next(f.getPath() for f in fs.listStatus(fs_path(folder)) if f.getPath().getName().startswith("part-"))
    fs.rename(part, fs_path(f"{folder}/{name}"))


@register("inventory_errors", """SELECT 'orders.parquet' AS file, count(*) AS rows, CAST(NULL AS VARCHAR) AS reason FROM orders
UNION ALL SELECT 'text.parquet', NULL, CASE WHEN count(*) > 3 THEN 'no magic number' END FROM region
UNION ALL SELECT 'short.parquet', NULL, CASE WHEN min(r_regionkey) < 10 THEN 'too short' END FROM region""")
def q_inventory_errors(spark, sf_dir):
    # two files of one format that can't be read, each for its own reason, beside a good one
    root = scratch_path(spark, "inventory-errors")
    fixtures.table(spark, sf_dir, "orders").coalesce(1).write.parquet(f"{root}/good")
    renamed(spark, f"{root}/good", "orders.parquet")
    region = fixtures.table(spark, sf_dir, "region")
    region.select(F.concat_ws(",", *region.columns).alias("value")).coalesce(1).write.text(f"{root}/text")
    renamed(spark, f"{root}/text", "text.parquet")
    region.agg(F.min("r_regionkey").cast("string").alias("value")).write.text(f"{root}/short")
    renamed(spark, f"{root}/short", "short.parquet")
    files = inventory(spark, root)
    reason = F.when(F.col("error").contains("length is too low"), "too short").when(
        F.col("error").contains("magic number"), "no magic number").otherwise(F.col("error"))
    return files.select("file", "rows", reason.alias("reason"))


@register("inventory_missing", f"SELECT format, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows FROM ({INVENTORY_SQL}) i "
          "GROUP BY format")
def q_inventory_missing(spark, sf_dir):
    # a location that isn't there adds nothing, and says nothing
    there, missing = inventory(spark, sf_dir), inventory(spark, f"{sf_dir.rstrip('/')}/no/such/folder")
    return inventory_totals(there.unionByName(missing))


@register("sample_rows", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS foreign_rows, count(*) > 0 AS share_kept, "
          "count(*) > 0 AS same_again FROM orders")
def q_sample_rows(spark, sf_dir):
    # a tenth of the rows, within five standard deviations; rows of the table only; the same in a second run
    orders = fixtures.table(spark, sf_dir, "orders")
    kept = sample(orders, 0.1)
    rows = orders.join(kept.select(F.col("o_orderkey").alias("k"), F.lit(1).alias("one")), F.col("o_orderkey") == F.col("k"), "full")
    again = sample(orders, 0.1).agg(F.sum("o_orderkey")).scalar()
    n, m = F.count("o_orderkey"), F.count("one")
    return rows.agg(n.alias("rows"), F.count_if(F.col("o_orderkey").isNull()).alias("foreign_rows"),
                    (F.abs(m - 0.1 * n) <= 5 * F.sqrt(0.09 * n)).alias("share_kept"),
                    (F.sum(F.when(F.col("one") == 1, F.col("o_orderkey"))) == again).alias("same_again"))


# ------------------------------------------------------------------ quality
@register("null_profile_exclude", oracle_with_tx(
    "SELECT ordinal, column_name AS \"column\", nulls, rows, " + pct("nulls", "rows") + " AS null_pct FROM ("
    + " UNION ALL ".join(
        f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL"
        + (f" OR {c} = ''" if c == "tx_datetime" else "") + ") AS nulls, count(*) AS rows FROM tx"
        for i, c in enumerate(x for x in TX_COLS.split(", ") if not x.startswith("tx_time_"))) + ") s"))
def q_null_profile_exclude(spark, sf_dir):
    # all columns but those with a prefix
    raw = tx(spark, sf_dir)
    return null_profile(raw, exclude=[c for c in raw.columns if c.startswith("tx_time_")])


@register("null_profile", oracle_with_tx(
    "SELECT ordinal, column_name AS \"column\", nulls, rows, " + pct("nulls", "rows") + " AS null_pct FROM ("
    + " UNION ALL ".join(
        f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL"
        + (f" OR {c} = ''" if c == "tx_datetime" else "") + ") AS nulls, count(*) AS rows FROM tx"
        for i, c in enumerate(TX_COLS.split(", "))) + ") s"))
def q_null_profile(spark, sf_dir):
    return null_profile(tx(spark, sf_dir))


RULES_SQL = [
    ("transaction_id_not_null", "transaction_id IS NOT NULL"),
    ("customer_id_not_null", "customer_id IS NOT NULL"),
    ("terminal_id_not_null", "terminal_id IS NOT NULL"),
    ("tx_amount_not_null", "tx_amount IS NOT NULL"),
    ("tx_fraud_not_null", "tx_fraud IS NOT NULL"),
    ("tx_amount_non_negative", "tx_amount >= 0"),
    ("tx_fraud_in_classes", "tx_fraud IN (0, 1)"),
    ("customer_id_non_negative", "customer_id >= 0"),
    ("terminal_id_non_negative", "terminal_id >= 0"),
    ("transaction_id_positive", "transaction_id > 0"),
]


@register("validate_rule_counts", oracle_with_tx(
    "SELECT ordinal, rule, failed, rows FROM (" + " UNION ALL ".join(
        f"SELECT {i + 1} AS ordinal, '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({cond}, false)) "
        "AS failed, count(*) AS rows FROM tx"
        for i, (name, cond) in enumerate(RULES_SQL)) + ") s"))
def q_validate_rule_counts(spark, sf_dir):
    return rule_failures(tx(spark, sf_dir))


# ------------------------------------------------------------------ cleaning
@register("clean_validate", oracle_with_tx("SELECT * FROM v", [V]))
def q_clean_validate(spark, sf_dir):
    return validate(tx(spark, sf_dir))


@register("amount_percentiles", oracle_with_tx("SELECT n, q1, q3, p1, p99 FROM q", [V, Q]))
def q_amount_percentiles(spark, sf_dir):
    return quantiles(validate(tx(spark, sf_dir)), C.amount, OUTLIER_PROBS, method="exact")


@register("outlier_bounds", oracle_with_tx("SELECT * FROM b", [V, Q, B]))
def q_outlier_bounds(spark, sf_dir):
    return outlier_bounds(validate(tx(spark, sf_dir)), method="exact")


@register("clean_outliers", oracle_with_tx("SELECT * FROM f", [V, Q, B, FENCE]))
def q_clean_outliers(spark, sf_dir):
    valid = validate(tx(spark, sf_dir))
    return remove_outliers(valid, exact_bounds(spark, sf_dir))


@register("clean_dedup", oracle_with_tx("SELECT * FROM d", [V, Q, B, FENCE, DEDUP]))
def q_clean_dedup(spark, sf_dir):
    valid = validate(tx(spark, sf_dir))
    return dedup(remove_outliers(valid, exact_bounds(spark, sf_dir)), C.id)


@register("clean_dedup_any", oracle_with_tx("SELECT * FROM d", [V, Q, B, FENCE, DEDUP]))
def q_clean_dedup_any(spark, sf_dir):
    # the fixture's duplicates are exact copies, so any survivor gives these rows
    valid = validate(tx(spark, sf_dir))
    return dedup(remove_outliers(valid, exact_bounds(spark, sf_dir)), C.id, deterministic=False)


@register("clean_dedup_known", oracle_with_tx("SELECT * FROM d", [V, Q, B, FENCE, DEDUP]))
def q_clean_dedup_known(spark, sf_dir):
    path = scratch_path(spark, "dedup-input")
    valid = validate(tx(spark, sf_dir))
    remove_outliers(valid, exact_bounds(spark, sf_dir)).write.parquet(path)
    return dedup_known(read_parquet(spark, path), C.id)


@register("clean_consistency", oracle_with_tx(f"SELECT * FROM tx WHERE {CONSISTENT}"))
def q_clean_consistency(spark, sf_dir):
    return check_consistency(tx(spark, sf_dir))


@register("clean", oracle_with_tx("SELECT * FROM c", CLEAN_CTES))
def q_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)


WATERFALL_SQL = oracle_with_tx(f"""SELECT stage, step, rows,
  lag(rows) OVER (ORDER BY stage) - rows AS removed,
  {pct('rows', 'first_value(rows) OVER (ORDER BY stage)')} AS pct_of_input
FROM (SELECT 0 AS stage, 'input' AS step, (SELECT count(*) FROM tx) AS rows
  UNION ALL SELECT 1, 'validation', (SELECT count(*) FROM v)
  UNION ALL SELECT 2, 'outliers', (SELECT count(*) FROM f)
  UNION ALL SELECT 3, 'dedup', (SELECT count(*) FROM d)
  UNION ALL SELECT 4, 'consistency', (SELECT count(*) FROM c)) s""", CLEAN_CTES)


@register("clean_waterfall", WATERFALL_SQL)
def q_clean_waterfall(spark, sf_dir):
    return waterfall(tx(spark, sf_dir), exact_bounds(spark, sf_dir))


@register("retention", oracle_with_tx(
    f"SELECT (SELECT count(*) FROM tx) AS input_rows, (SELECT count(*) FROM c) AS output_rows, "
    f"{pct('(SELECT count(*) FROM c)', '(SELECT count(*) FROM tx)')} AS retention_pct", CLEAN_CTES))
def q_retention(spark, sf_dir):
    w = waterfall(tx(spark, sf_dir), exact_bounds(spark, sf_dir))
    return w.agg(F.sum(F.when(F.col("stage") == 0, F.col("rows"))).alias("input_rows"),
                 F.sum(F.when(F.col("stage") == 4, F.col("rows"))).alias("output_rows"),
                 F.sum(F.when(F.col("stage") == 4, F.col("pct_of_input"))).alias("retention_pct"))


# ------------------------------------------------------------------ features
FEATURE_TX = feature_ctes("tx")


@register("features_temporal", oracle_with_tx(
    "SELECT transaction_id, tx_datetime, tx_hour, tx_day_of_week FROM fe", FEATURE_TX))
def q_features_temporal(spark, sf_dir):
    return add_features(tx(spark, sf_dir)).select("transaction_id", "tx_datetime", "tx_hour", "tx_day_of_week")


@register("features_flags", oracle_with_tx(
    "SELECT transaction_id, tx_datetime, is_weekend, is_night, is_business_hours FROM fe", FEATURE_TX))
def q_features_flags(spark, sf_dir):
    return add_features(tx(spark, sf_dir)).select("transaction_id", "tx_datetime", "is_weekend", "is_night",
                                                  "is_business_hours")


@register("features_log", oracle_with_tx(
    "SELECT transaction_id, tx_amount, round(tx_amount_log, 9) AS tx_amount_log FROM fe", FEATURE_TX))
def q_features_log(spark, sf_dir):
    return add_features(tx(spark, sf_dir)).select("transaction_id", "tx_amount",
                                                  F.round("tx_amount_log", 9).alias("tx_amount_log"))


@register("features_bins", oracle_with_tx(
    "SELECT transaction_id, tx_amount, amount_category FROM fe", FEATURE_TX))
def q_features_bins(spark, sf_dir):
    return add_features(tx(spark, sf_dir)).select("transaction_id", "tx_amount", "amount_category")


# ------------------------------------------------------------------ flagship
ML_READY_SQL = oracle_with_tx(
    f"SELECT {ML_SELECT.replace('tx_amount_log', 'round(tx_amount_log, 9) AS tx_amount_log')} FROM ml",
    ML_READY_CTES)


@register("ml_ready", ML_READY_SQL)
def q_ml_ready(spark, sf_dir):
    return ml(spark, sf_dir).withColumn("tx_amount_log", F.round("tx_amount_log", 9))


@register("class_distribution", oracle_with_tx(
    f"SELECT tx_fraud, count(*) AS count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct "
    "FROM ml GROUP BY tx_fraud", ML_READY_CTES))
def q_class_distribution(spark, sf_dir):
    return class_distribution(ml(spark, sf_dir), "tx_fraud")


@register("class_distribution_valid", oracle_with_tx(
    f"SELECT tx_fraud, count(*) AS count, {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct "
    "FROM v GROUP BY tx_fraud", [V]))
def q_class_distribution_valid(spark, sf_dir):
    return class_distribution(validate(tx(spark, sf_dir)), "tx_fraud")


# ------------------------------------------------------------------ sinks
ROUNDTRIP_COLS = [c for c in ML_READY_COLUMNS if c != "tx_fraud"]
ROUNDTRIP_SQL = oracle_with_tx(
    "SELECT " + ", ".join("round(tx_amount_log, 9) AS tx_amount_log" if c == "tx_amount_log" else c
                          for c in ROUNDTRIP_COLS)
    + ", CAST(tx_fraud AS INTEGER) AS tx_fraud FROM ml", ML_READY_CTES)


@register("sink_parquet_roundtrip", ROUNDTRIP_SQL)
def q_sink_parquet_roundtrip(spark, sf_dir):
    return written_ml_ready(spark, sf_dir).withColumn("tx_amount_log", F.round("tx_amount_log", 9))


@register("sink_rebalanced", oracle_with_tx(
    "SELECT CAST(tx_fraud AS INTEGER) AS tx_fraud, count(*) AS rows, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS files "
    "FROM ml GROUP BY tx_fraud", ML_READY_CTES))
def q_sink_rebalanced(spark, sf_dir):
    # a class with most of the rows and one with few: neither has more files than its rows need
    path = scratch_path(spark, "ml_rebalanced")
    write_partitioned(ml(spark, sf_dir), path, label="tx_fraud", max_records_per_file=1000, rebalance=True)
    rows = read_parquet(spark, path).select("tx_fraud", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("tx_fraud").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))


FLOATING = ("tx_amount_log", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice")


def exact_text(c: str, stat: str) -> str:
    return "CAST(NULL AS VARCHAR)" if c in FLOATING else f"CAST({stat}({c}) AS VARCHAR)"


def numeric_stats_sql(src: str, cols, digits: int = 6) -> str:
    parts = []
    for i, c in enumerate(cols):
        parts.append(
            f"SELECT {i + 1} AS ordinal, '{c}' AS column_name, count({c}) AS count, "
            f"round(CAST(avg({c}) AS DOUBLE), {digits}) AS mean, "
            f"round(CAST(stddev_samp({c}) AS DOUBLE), {digits}) AS stddev, "
            f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
            f"{exact_text(c, 'min')} AS min_text, {exact_text(c, 'max')} AS max_text FROM {src}")
    return ("SELECT ordinal, column_name AS \"column\", count, mean, stddev, min, max, min_text, max_text FROM ("
            + " UNION ALL ".join(parts) + ") s")


@register("numeric_stats", oracle_with_tx(numeric_stats_sql(
    "tx", [c for c in TX_COLS.split(", ") if c != "tx_datetime"])))
def q_numeric_stats(spark, sf_dir):
    return numeric_stats(tx(spark, sf_dir), digits=6)


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedup_lineitem", "SELECT " + ", ".join(LINEITEM_COLS) + " FROM (SELECT *, row_number() OVER ("
          "PARTITION BY l_orderkey ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in LINEITEM_COLS[1:])
          + ") AS rn FROM lineitem) s WHERE rn = 1")
def q_dedup_lineitem(spark, sf_dir):
    # several different lines per order: the survivor is the smallest by the
    # remaining columns in order, the same rule as the SQL window
    return dedup(fixtures.table(spark, sf_dir, "lineitem"), "l_orderkey")


LINEITEM_PROBS = {"p1": 0.01, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}


@register("percentiles_lineitem", "SELECT count(l_extendedprice) AS n, " + ", ".join(
    f"quantile_disc(l_extendedprice, {p}) AS {k}" for k, p in LINEITEM_PROBS.items()) + " FROM lineitem")
def q_percentiles_lineitem(spark, sf_dir):
    return quantiles(fixtures.table(spark, sf_dir, "lineitem"), "l_extendedprice", LINEITEM_PROBS, method="exact")


@register("numeric_stats_lineitem", numeric_stats_sql(
    "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax"]))
def q_numeric_stats_lineitem(spark, sf_dir):
    return numeric_stats(fixtures.table(spark, sf_dir, "lineitem"), digits=6)


def metrics_sql(src: str, schema_rows, label: str | None, numeric, digits: int = 6) -> str:
    """Oracle for ``report_metrics`` (without the partition metric)."""
    rows = [f"SELECT 'schema' AS section, '{n}' AS item, 'type' AS metric, CAST({i + 1} AS DOUBLE) AS value, "
            f"'{t}' AS text" for i, (n, t, _) in enumerate(schema_rows)]
    rows += [f"SELECT 'schema', '{n}', 'nullable', CAST({1 if nl else 0} AS DOUBLE), NULL"
             for n, _, nl in schema_rows]
    rows.append(f"SELECT 'general', '', 'total_rows', CAST(count(*) AS DOUBLE), NULL FROM {src}")
    if label is not None:
        rows.append(f"SELECT 'class_distribution', 'class_' || CAST({label} AS VARCHAR), 'count', "
                    f"CAST(count(*) AS DOUBLE), NULL FROM {src} GROUP BY {label}")
        rows.append(f"SELECT 'class_distribution', 'class_' || CAST({label} AS VARCHAR), 'percentage', "
                    f"{pct('count(*)', 'sum(count(*)) OVER ()')}, NULL FROM {src} GROUP BY {label}")
    for c in numeric:
        for m, e in (("count", f"CAST(count({c}) AS DOUBLE)"),
                     ("mean", f"round(CAST(avg({c}) AS DOUBLE), {digits})"),
                     ("stddev", f"round(CAST(stddev_samp({c}) AS DOUBLE), {digits})"),
                     ("min", f"CAST(min({c}) AS DOUBLE)"), ("max", f"CAST(max({c}) AS DOUBLE)")):
            text = exact_text(c, m) if m in ("min", "max") else "NULL"
            rows.append(f"SELECT 'numeric_statistics', '{c}', '{m}', {e}, {text} FROM {src}")
    return " UNION ALL ".join(rows)


ML_READ_BACK_SCHEMA = [(c, t, True) for c, t in [
    ("transaction_id", "bigint"), ("customer_id", "int"), ("terminal_id", "int"),
    ("tx_amount", "decimal(10,2)"), ("tx_amount_log", "double"), ("amount_category", "int"),
    ("tx_hour", "int"), ("tx_day_of_week", "int"), ("is_weekend", "int"), ("is_night", "int"),
    ("is_business_hours", "int"), ("tx_time_days", "int"), ("tx_time_seconds", "int"),
    ("tx_fraud_scenario", "tinyint"), ("tx_fraud", "int")]]

PROFILE_SQL = oracle_with_tx(
    metrics_sql("ml", ML_READ_BACK_SCHEMA, "tx_fraud",
                [c for c, _, _ in ML_READ_BACK_SCHEMA]),
    ML_READY_CTES)


@register("profile_dataset", PROFILE_SQL)
def q_profile_dataset(spark, sf_dir):
    return report_metrics(written_ml_ready(spark, sf_dir), label="tx_fraud", digits=6,
                          include_partitions=False)


@register("profile_partitions", "SELECT count(DISTINCT o_orderkey % 13) AS partitions FROM orders")
def q_profile_partitions(spark, sf_dir):
    # rows dealt to partitions by a number of their own, so the count of non-empty ones follows from the rows
    dealt = fixtures.table(spark, sf_dir, "orders").repartitionById(16, (F.col("o_orderkey") % 13).cast("int"))
    return partition_count(dealt)


BIG = "CAST(9007199254740993 + 2 * o_orderkey AS BIGINT)"


@register("numeric_stats_exact", numeric_stats_sql(f"(SELECT {BIG} AS big FROM orders) o", ["big"], digits=-6))
def q_numeric_stats_exact(spark, sf_dir):
    # ids above 2^53: the exact minimum and maximum are in the text columns
    return numeric_stats(fixtures.table(spark, sf_dir, "orders").select(F.expr(BIG).alias("big")), digits=-6)


SPECIAL = """CASE WHEN l_orderkey % 20 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_orderkey % 100 = 1 THEN CAST('Infinity' AS DOUBLE)
  WHEN l_orderkey % 100 = 2 THEN CAST('-Infinity' AS DOUBLE) ELSE l_extendedprice END"""
SPECIAL_PROBS = {"p2": 0.02, "q1": 0.25, "median": 0.5, "p90": 0.9, "p99": 0.99}


@register("percentiles_special", f"""WITH s AS (SELECT {SPECIAL} AS x FROM lineitem)
SELECT count(x) AS n, """ + ", ".join(f"quantile_disc(x, {p}) AS {k}" for k, p in SPECIAL_PROBS.items() if k != "p99")
          + ", isnan(quantile_disc(x, 0.99)) AS p99_is_nan FROM s")
def q_percentiles_special(spark, sf_dir):
    # NaN sorts last; infinities are values
    x = fixtures.table(spark, sf_dir, "lineitem").select(F.expr(SPECIAL).alias("x"))
    q = quantiles(x, "x", SPECIAL_PROBS)
    return q.select("n", "p2", "q1", "median", "p90", F.isnan("p99").alias("p99_is_nan"))


#: Documented bounds of the rank error: KLL with k = 8000, and percentile_approx with accuracy 10,000.
RANK_BOUND = 1e-3


def _near_probs() -> dict[str, float]:
    """Ranks a bound below and above each of ``LINEITEM_PROBS``."""
    return {f"{end}_{name}": min(1.0, max(0.0, p + sign * RANK_BOUND)) for name, p in LINEITEM_PROBS.items()
            for end, sign in (("lo", -1), ("hi", 1))}


@register("percentiles_rank_error", "SELECT count(l_extendedprice) AS n, " + ", ".join(
    f"quantile_disc(l_extendedprice, {p}) AS {k}" for k, p in _near_probs().items())
          + ", count(*) > 0 AS sketch_within, count(*) > 0 AS approx_within FROM lineitem")
def q_percentiles_rank_error(spark, sf_dir):
    # the exact values a bound below and above each rank, and whether the estimates lie between them
    x = fixtures.table(spark, sf_dir, "lineitem").select("l_extendedprice")
    exact = quantiles(x, "l_extendedprice", _near_probs())
    for method in ("sketch", "approx"):
        row = quantiles(x, "l_extendedprice", LINEITEM_PROBS, method=method).first()
        near = F.lit(True)
        for name in LINEITEM_PROBS:
            near = near & F.lit(row[name]).between(F.col(f"lo_{name}"), F.col(f"hi_{name}"))
        exact = exact.withColumn(f"{method}_within", near)
    return exact


# ------------------------------------------------------------------ stored states
def stored_lineitem(spark, sf_dir):
    """A store over two batches of files, the second added after the first; a
    batch is dealt evenly to files of a bounded size, so they grow in number."""
    path, store = scratch_path(spark, "stored-lineitem"), scratch_path(spark, "store")
    li = fixtures.table(spark, sf_dir, "lineitem")
    for half in (0, 1):
        li.filter(F.col("l_linenumber") % 2 == half).hint("rebalance").write.mode("append").parquet(path)
        add_files(spark, path, store, sketches=["l_extendedprice"])
    return store, li.schema


@register("stored_percentiles", "SELECT count(l_extendedprice) AS n, " + ", ".join(
    f"quantile_disc(l_extendedprice, {p}) AS {k}" for k, p in _near_probs().items())
          + ", count(*) > 0 AS stored_within FROM lineitem")
def q_stored_percentiles(spark, sf_dir):
    store, schema = stored_lineitem(spark, sf_dir)
    row = stored_quantiles(spark, store, schema, "l_extendedprice", LINEITEM_PROBS).first()
    exact = quantiles(fixtures.table(spark, sf_dir, "lineitem"), "l_extendedprice", _near_probs())
    near = F.col("n") == row["n"]
    for name in LINEITEM_PROBS:
        near = near & F.lit(row[name]).between(F.col(f"lo_{name}"), F.col(f"hi_{name}"))
    return exact.withColumn("stored_within", near)


@register("stored_nulls", " UNION ALL ".join(
    f"SELECT {i + 1} AS ordinal, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR CAST({c} AS VARCHAR) = ''" if c in ("l_returnflag", "l_linestatus") else "")
    + f") AS nulls, count(*) AS rows, {pct('count(*) FILTER (WHERE ' + c + ' IS NULL)', 'count(*)')} AS null_pct FROM lineitem"
    for i, c in enumerate(LINEITEM_COLS)))
def q_stored_nulls(spark, sf_dir):
    store, schema = stored_lineitem(spark, sf_dir)
    return stored_nulls(spark, store, schema)


@register("profile_stored", PROFILE_SQL)
def q_profile_stored(spark, sf_dir):
    # the same profile, from states of files that were added in two batches
    path, store = scratch_path(spark, "stored-ml"), scratch_path(spark, "store")
    out = ml(spark, sf_dir)
    for half in (0, 1):
        write_partitioned(out.filter(F.col("transaction_id") % 2 == half), path, label="tx_fraud", mode="append")
        add_files(spark, path, store, label="tx_fraud")
    return stored_metrics(spark, store, read_parquet(spark, path).schema, digits=6)


ORDERS_SCHEMA = [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True),
                 ("o_orderstatus", "string", True), ("o_totalprice", "double", True),
                 ("o_orderdate", "timestamp_ntz", True), ("o_orderpriority", "string", True)]
ORDERS_METRICS_SQL = metrics_sql("orders", ORDERS_SCHEMA, "o_orderstatus",
                                 ["o_orderkey", "o_custkey", "o_totalprice"])


def orders_metrics(spark, sf_dir):
    return report_metrics(fixtures.table(spark, sf_dir, "orders"), label="o_orderstatus", digits=6,
                          include_partitions=False)


@register("report_metrics", ORDERS_METRICS_SQL)
def q_report_metrics(spark, sf_dir):
    return orders_metrics(spark, sf_dir)


@register("sink_json_roundtrip", ORDERS_METRICS_SQL)
def q_sink_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report_json")
    write_json(orders_metrics(spark, sf_dir), path)
    return spark.read.schema(METRIC_SCHEMA).json(path)


SHOWN = """CASE WHEN section = 'numeric_statistics' AND text IS NOT NULL THEN text
  WHEN text IS NOT NULL AND value IS NOT NULL THEN num || ' ' || text ELSE coalesce(text, num) END"""
TEXT_REPORT_SQL = f"""WITH m AS ({ORDERS_METRICS_SQL}),
f AS (SELECT *, CASE WHEN value = floor(value) THEN format('{{:,}}', CAST(value AS BIGINT))
  ELSE format('{{:,.2f}}', value) END AS num FROM m)
SELECT '== ' || upper(section) || ' ==' AS value FROM m GROUP BY section
UNION ALL SELECT printf('  %-24s %-12s %s', coalesce(item, ''), metric, {SHOWN}) FROM f WHERE section <> 'schema'
UNION ALL SELECT '  ' || item || ': ' || max(text) || CASE WHEN max(CASE WHEN metric = 'nullable' THEN value END) = 1
  THEN ' (NULL)' ELSE ' (NOT NULL)' END FROM m WHERE section = 'schema' GROUP BY item"""


@register("sink_text_report", TEXT_REPORT_SQL)
def q_sink_text_report(spark, sf_dir):
    path = scratch_path(spark, "report_txt")
    write_text_report(orders_metrics(spark, sf_dir), path)
    return spark.read.text(path)


# ------------------------------------------------------------------ preparation job
def prepared(spark, sf_dir):
    src, out = scratch_path(spark, "prepare-in"), scratch_path(spark, "prepare-out")
    tx(spark, sf_dir).write.option("header", True).option("escape", '"').csv(src)
    return prepare(spark, src, out), out


@register("prepare_job", ROUNDTRIP_SQL)
def q_prepare_job(spark, sf_dir):
    _, out = prepared(spark, sf_dir)
    return read_parquet(spark, out).withColumn("tx_amount_log", F.round("tx_amount_log", 9))


def _metric_sql(section: str, item: str, metric: str, value: str, text: str = "NULL") -> str:
    return (f"SELECT '{section}' AS section, '{item}' AS item, '{metric}' AS metric, CAST({value} AS DOUBLE) AS value, "
            f"CAST({text} AS VARCHAR) AS text")


STEPS = {"input": "tx", "validation": "v", "outliers": "f", "dedup": "d", "consistency": "c"}
_count = {k: f"(SELECT count(*) FROM {t})" for k, t in STEPS.items()}
_nulls = {c: f"count(*) FILTER (WHERE {c} IS NULL" + (f" OR {c} = ''" if c == "tx_datetime" else "") + ")"
          for c in TX_COLS.split(", ")}
PREPARE_REPORT_SQL = oracle_with_tx(" UNION ALL ".join(
    [_metric_sql("general", "", "input_rows", _count["input"]), _metric_sql("general", "", "output_rows", _count["consistency"]),
     _metric_sql("general", "", "retention_pct", f"CAST(100 AS DOUBLE) * {_count['consistency']} / {_count['input']}")]
    + [_metric_sql("waterfall", k, "rows", _count[k]) for k in STEPS]
    + [_metric_sql("waterfall", k, "removed", f"{_count[j]} - {_count[k]}") for j, k in zip(list(STEPS), list(STEPS)[1:])]
    + [_metric_sql("outlier_bounds", k, "value", f"(SELECT CAST({k} AS DOUBLE) FROM b)")
       for k in ("n", "q1", "q3", "p1", "p99", "lo", "hi")]
    + [_metric_sql("outlier_bounds", "applied", "value", "(SELECT CASE WHEN applied THEN 1 ELSE 0 END FROM b)")]
    + [_metric_sql("null_profile", c, "nulls", f"(SELECT {e} FROM tx)", "'input'") for c, e in _nulls.items()]
    + [_metric_sql("null_profile", c, "nulls_clean", f"(SELECT {e} FROM c)", "'cleaned'") for c, e in _nulls.items()]
    + [_metric_sql("rule_failures", name, "failed",
                   f"(SELECT count(*) FILTER (WHERE NOT coalesce({cond}, false)) FROM tx)") for name, cond in RULES_SQL]
    + [_metric_sql("class_distribution", f"class_{k}", "count", f"(SELECT count(*) FROM c WHERE tx_fraud = {k})")
       for k in (0, 1)]
    + [_metric_sql("class_distribution", f"class_{k}", "percentage",
                   f"CAST(100 AS DOUBLE) * (SELECT count(*) FROM c WHERE tx_fraud = {k}) / {_count['consistency']}")
       for k in (0, 1)]), CLEAN_CTES)


@register("prepare_report", PREPARE_REPORT_SQL)
def q_prepare_report(spark, sf_dir):
    # the run's own path and partition count say nothing about the data
    result, _ = prepared(spark, sf_dir)
    return result.to_metrics(spark).filter(~F.col("metric").isin("output_path", "partitions"))


# ------------------------------------------------------------------ profile job
def basename_items(metrics: DataFrame) -> DataFrame:
    """Paths in ``item`` reduced to their last segment (paths depend on sf_dir)."""
    item = F.col("item")
    return metrics.withColumn("item", F.when(item.contains("/"), F.element_at(F.split(F.rtrim(item), "/"), -1))
                              .otherwise(item))


ANALYZE_INVENTORY_SQL = f"""WITH i AS ({INVENTORY_SQL})
SELECT 'inventory' AS section, file AS item, 'rows' AS metric, CAST(rows AS DOUBLE) AS value, format AS text FROM i
UNION ALL SELECT 'general', format, 'rows', CAST(sum(rows) AS DOUBLE), NULL FROM i GROUP BY format
UNION ALL SELECT 'general', format, 'files', CAST(count(*) AS DOUBLE), NULL FROM i GROUP BY format
UNION ALL SELECT 'general', '', 'total_rows', CAST(sum(rows) AS DOUBLE), NULL FROM i
UNION ALL SELECT 'general', '', 'files_processed', CAST(count(*) AS DOUBLE), NULL FROM i"""


@register("analyze_inventory", ANALYZE_INVENTORY_SQL)
def q_analyze_inventory(spark, sf_dir):
    return basename_items(analyze(spark, sf_dir))


ANALYZE_DATASET_SQL = PROFILE_SQL + \
    "\nUNION ALL SELECT 'general', 'ml_ready_data', 'dataset', CAST(1 AS DOUBLE), 'ML_PARQUET'"


@register("analyze_dataset", ANALYZE_DATASET_SQL)
def q_analyze_dataset(spark, sf_dir):
    path = scratch_path(spark, "job") + "/ml_ready_data"
    write_partitioned(ml(spark, sf_dir), path, label="tx_fraud")
    return basename_items(analyze(spark, path, digits=6, include_partitions=False))


# ------------------------------------------------------------------ streaming
STREAM_CTES = [V, Q, B, FENCE, ("c", f"SELECT * FROM f WHERE {CONSISTENT}")] + feature_ctes("c") + [
    ("ml", f"SELECT {ML_SELECT} FROM fe WHERE tx_amount_log IS NOT NULL")]
STREAM_SQL = oracle_with_tx(
    "SELECT " + ", ".join("round(tx_amount_log, 9) AS tx_amount_log" if c == "tx_amount_log" else c
                          for c in ROUNDTRIP_COLS)
    + ", CAST(tx_fraud AS INTEGER) AS tx_fraud FROM ml", STREAM_CTES)


@register("stream_ready", STREAM_SQL)
def q_stream_ready(spark, sf_dir):
    from ..streaming import stream_prepare
    src = scratch_path(spark, "stream-in")
    tx(spark, sf_dir).repartition("transaction_id").write.option("header", True).csv(src)
    out = scratch_path(spark, "stream-out")
    q = stream_prepare(spark, src, out, bounds=exact_bounds(spark, sf_dir), max_files_per_trigger=2,
                       checkpoint=scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return read_parquet(spark, out).withColumn("tx_amount_log", F.round("tx_amount_log", 9))


@register("stream_dedup", ROUNDTRIP_SQL)
def q_stream_dedup(spark, sf_dir):
    # the stream stops after the first files and goes on with the same checkpoint when others have come
    from ..streaming import stream_prepare
    src, out, ckpt = (scratch_path(spark, f"stream-{x}") for x in ("dedup-in", "dedup-out", "dedup-ckpt"))
    rows, bounds = scratch_path(spark, "stream-rows"), exact_bounds(spark, sf_dir)
    tx(spark, sf_dir).withColumn("half", F.monotonically_increasing_id() % 2).write.parquet(rows)
    for half in (0, 1):
        read_parquet(spark, rows).filter(F.col("half") == half).drop("half").write.mode("append").option("header", True).csv(src)
        stream_prepare(spark, src, out, bounds=bounds, checkpoint=ckpt, dedup_within="7 days").awaitTermination()
    return read_parquet(spark, out).withColumn("tx_amount_log", F.round("tx_amount_log", 9))
