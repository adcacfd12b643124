"""Feature expressions: temporal parts, flags, log amount, amount bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Feature definitions of the reference job.
WEEKEND_DAYS = (1, 7)          # dayofweek: 1 = Sunday ... 7 = Saturday
NIGHT_FROM_HOUR = 22           # night: hour >= 22 or hour <= 6
NIGHT_TO_HOUR = 6
BUSINESS_HOURS = (9, 17)       # business: 9 <= hour <= 17
AMOUNT_BREAKS = (10, 100, 1000)  # category k: amount <= AMOUNT_BREAKS[k]; else len


def parse_timestamp(col: str) -> Column:
    """String to ``timestamp_ntz``; unparseable text gives NULL, not an error."""
    return F.col(col).try_cast("timestamp_ntz")


def flag(predicate: Column) -> Column:
    """0/1 integer flag; a NULL predicate counts as 0."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def is_weekend(day_of_week: Column, days: Sequence[int] = WEEKEND_DAYS) -> Column:
    return flag(day_of_week.isin(*days))


def is_night(hour: Column, from_hour: int = NIGHT_FROM_HOUR, to_hour: int = NIGHT_TO_HOUR) -> Column:
    return flag((hour >= from_hour) | (hour <= to_hour))


def is_business_hours(hour: Column, hours: Sequence[int] = BUSINESS_HOURS) -> Column:
    return flag((hour >= hours[0]) & (hour <= hours[1]))


def log_amount(amount: Column) -> Column:
    """Natural log for positive amounts, 0.0 otherwise (incl. NULL)."""
    return F.when(amount > 0, F.ln(amount)).otherwise(F.lit(0.0))


def amount_bin(amount: Column, breaks: Sequence[int] = AMOUNT_BREAKS) -> Column:
    """Ordered right-closed bins: first k with amount <= breaks[k], else len(breaks)."""
    expr = None
    for k, b in enumerate(breaks):
        expr = F.when(amount <= b, F.lit(k)) if expr is None else expr.when(amount <= b, F.lit(k))
    return expr.otherwise(F.lit(len(breaks)))
