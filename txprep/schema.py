"""Column roles and the fixed transaction schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TxColumns:
    """Names of the columns each stage relies on.

    Defaults are the transaction layout; pass other names to run the same
    stages on any fact table with an id, an amount and a 0/1 label.
    """

    id: str = "transaction_id"
    datetime: str = "tx_datetime"
    customer: str = "customer_id"
    terminal: str = "terminal_id"
    amount: str = "tx_amount"
    label: str = "tx_fraud"
    scenario: str = "tx_fraud_scenario"


DEFAULT_COLUMNS = TxColumns()

# The raw delimited input layout (names, order and types).
TX_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType(), True),
    T.StructField("tx_datetime", T.StringType(), True),
    T.StructField("customer_id", T.IntegerType(), True),
    T.StructField("terminal_id", T.IntegerType(), True),
    T.StructField("tx_amount", T.DecimalType(10, 2), True),
    T.StructField("tx_time_seconds", T.IntegerType(), True),
    T.StructField("tx_time_days", T.IntegerType(), True),
    T.StructField("tx_fraud", T.ByteType(), True),
    T.StructField("tx_fraud_scenario", T.ByteType(), True),
])

# The ML-ready output columns, in output order.
ML_READY_COLUMNS = [
    "transaction_id", "customer_id", "terminal_id",
    "tx_amount", "tx_amount_log", "amount_category",
    "tx_hour", "tx_day_of_week",
    "is_weekend", "is_night", "is_business_hours",
    "tx_time_days", "tx_time_seconds",
    "tx_fraud",
    "tx_fraud_scenario",
]
