from .prepare import PrepareResult, ml_ready, prepare
from .report import analyze, inventory_metrics, is_dataset_path, write_reports

__all__ = ["PrepareResult", "ml_ready", "prepare", "analyze", "inventory_metrics", "is_dataset_path",
           "write_reports"]
