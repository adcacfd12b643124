"""Test-data views and the ``tx`` transaction fixture.

``TX_FIXTURE_SQL`` is one SQL text that runs unchanged in Spark and DuckDB
over the ``events`` table and yields the raw transaction layout with every
defect the cleaning stages look for planted in it (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

TX_FIXTURE_SQL = """
WITH base AS (
  SELECT event_id, ts, user_id, value,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fr
  FROM events
), tx0 AS (
  SELECT
    CAST(event_id AS BIGINT) AS transaction_id,
    CASE WHEN event_id % 127 = 5 THEN 'not-a-date'
         ELSE substr(CAST(ts AS VARCHAR(64)), 1, 19) END AS tx_datetime,
    CAST(CASE WHEN event_id % 131 = 7 THEN NULL ELSE user_id END AS INT) AS customer_id,
    CAST(CASE WHEN event_id % 137 = 9 THEN -1 ELSE event_id % 997 END AS INT) AS terminal_id,
    CAST(CASE WHEN event_id % 101 = 3 THEN NULL
              WHEN event_id % 103 = 4 THEN -value
              WHEN event_id % 211 = 8 THEN 0
              WHEN event_id % 199 = 6 THEN value + 5000
              ELSE value END AS DECIMAL(10,2)) AS tx_amount,
    CAST((dayofyear(ts) - 1) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INT) AS tx_time_seconds,
    CAST(dayofyear(ts) - 1 AS INT) AS tx_time_days,
    CAST(CASE WHEN event_id % 107 = 2 THEN 2 ELSE fr END AS TINYINT) AS tx_fraud,
    CAST(CASE WHEN event_id % 109 = 1 THEN NULL
              WHEN event_id % 113 = 10 THEN 1 - fr
              WHEN fr = 1 THEN 1 + event_id % 3 ELSE 0 END AS TINYINT) AS tx_fraud_scenario,
    event_id
  FROM base
)
SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_amount,
       tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario FROM tx0
UNION ALL
SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_amount,
       tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario FROM tx0
WHERE event_id % 50 = 0
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw transaction fixture derived from ``events`` of ``sf_dir``.

    The ``events`` DataFrame is bound to the SQL text as a parameter, so no
    session-global view is created or replaced (safe for concurrent callers
    on one session).
    """
    text = TX_FIXTURE_SQL.replace("FROM events", "FROM {events}")
    return spark.sql(text, events=table(spark, sf_dir, "events"))


def oracle_with_tx(body: str, ctes=()) -> str:
    """An oracle query over the fixture: ``tx`` and then each ``(name, sql)``
    of ``ctes`` become CTEs ahead of ``body``."""
    fixture = TX_FIXTURE_SQL.strip()
    # the fixture opens with its own WITH list; splice ``tx`` in after it
    inner = fixture[len("WITH "):]
    head, _, tail = inner.partition("\nSELECT transaction_id")
    parts = [head, f"tx AS (\nSELECT transaction_id{tail}\n)"]
    parts += [f"{name} AS (\n{text.strip()}\n)" for name, text in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
