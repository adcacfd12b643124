"""txprep: transaction-table quality, cleaning, features and profiling on
Spark DataFrames."""

from .plans import PrepareResult, analyze, ml_ready, prepare, write_reports
from .schema import DEFAULT_COLUMNS, ML_READY_COLUMNS, TX_SCHEMA, TxColumns

__all__ = ["DEFAULT_COLUMNS", "ML_READY_COLUMNS", "TX_SCHEMA", "TxColumns", "PrepareResult", "analyze",
           "ml_ready", "prepare", "write_reports"]
