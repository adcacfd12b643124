from .features import (amount_bin, flag, is_business_hours, is_night, is_weekend,
                       log_amount, parse_timestamp)
from .predicates import (all_of, is_valid, label_consistent, null_or_empty,
                         validation_rules)

__all__ = [
    "amount_bin", "flag", "is_business_hours", "is_night", "is_weekend", "log_amount",
    "parse_timestamp", "all_of", "is_valid", "label_consistent",
    "null_or_empty", "validation_rules",
]
