"""Turn one wide row of aggregates into long-form rows, inside the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt_row(wide: DataFrame, items: Sequence[dict[str, Column]], keep: Sequence[str] = ()) -> DataFrame:
    """Explode a fixed list of structs built from ``wide``'s columns.

    ``items`` holds one dict per output row (field name -> Column over
    ``wide``); every dict must have the same keys. The array size is fixed
    by the caller, so the output is bounded by ``len(items)`` per input row.
    """
    structs = [F.struct(*[c.alias(k) for k, c in item.items()]) for item in items]
    return wide.select(*keep, F.explode(F.array(*structs)).alias("_r")).select(*keep, "_r.*")


def ratio_pct(part: Column, whole: Column) -> Column:
    """100 * part / whole in double; NULL when whole is 0 or NULL."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
