"""Feature columns appended in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import features as fx
from ..schema import DEFAULT_COLUMNS, ML_READY_COLUMNS, TxColumns


def add_features(df: DataFrame, cols: TxColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Append tx_timestamp, tx_hour, tx_day_of_week, is_weekend, is_night,
    is_business_hours, tx_amount_log, amount_category.

    Unparseable datetimes give NULL hour/day and 0 flags; Catalyst collapses
    the two projections into one, evaluated inside whole-stage codegen.
    """
    amount = F.col(cols.amount)
    ts = fx.parse_timestamp(cols.datetime)
    timed = df.withColumns({
        "tx_timestamp": ts,
        "tx_hour": F.hour(ts),
        "tx_day_of_week": F.dayofweek(ts),
    })
    hour, dow = F.col("tx_hour"), F.col("tx_day_of_week")
    return timed.withColumns({
        "is_weekend": fx.is_weekend(dow),
        "is_night": fx.is_night(hour),
        "is_business_hours": fx.is_business_hours(hour),
        "tx_amount_log": fx.log_amount(amount),
        "amount_category": fx.amount_bin(amount),
    })


def ml_ready_columns(cols: TxColumns, available) -> list[str]:
    """The output layout with role columns renamed through ``cols``; plain
    pass-through columns are kept when the input has them."""
    role = {"transaction_id": cols.id, "customer_id": cols.customer, "terminal_id": cols.terminal,
            "tx_amount": cols.amount, "tx_fraud": cols.label, "tx_fraud_scenario": cols.scenario}
    out = [role.get(c, c) for c in ML_READY_COLUMNS]
    return [c for c in out if c in available]


def select_ml_ready(features: DataFrame, cols: TxColumns = DEFAULT_COLUMNS) -> DataFrame:
    """Fixed output columns; rows without a log amount are dropped (a contract:
    the log is never NULL after validation)."""
    return (features.select(*ml_ready_columns(cols, features.columns))
            .filter(F.col("tx_amount_log").isNotNull()))
