from .cleaning import (check_consistency, clean, dedup, dedup_known, outlier_bounds, remove_outliers,
                       resolve_bounds, rule_failures, validate, waterfall)
from .features import add_features, select_ml_ready
from .partitioning import heavy_keys, plan_partitions, plan_partitions_col, repartition_hot
from .profile import class_distribution, numeric_stats, partition_count, report_metrics
from .quality import null_profile, row_count, sample
from .quantiles import approx_quantiles, exact_quantiles, quantiles
from .stored import add_files, stored_metrics, stored_nulls, stored_quantiles, stored_stats

__all__ = [
    "check_consistency", "clean", "dedup", "dedup_known", "outlier_bounds", "remove_outliers", "resolve_bounds",
    "rule_failures", "validate", "waterfall", "add_features", "select_ml_ready",
    "heavy_keys", "plan_partitions", "plan_partitions_col", "repartition_hot", "class_distribution", "numeric_stats",
    "partition_count", "report_metrics", "null_profile", "row_count",
    "sample", "approx_quantiles", "exact_quantiles", "quantiles",
    "add_files", "stored_metrics", "stored_nulls", "stored_quantiles", "stored_stats",
]
