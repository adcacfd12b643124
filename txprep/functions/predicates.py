"""Row predicates used by the cleaning stages, as JVM-side Columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DEFAULT_COLUMNS, TxColumns

# The label classes a valid row may carry.
LABEL_CLASSES = (0, 1)


def validation_rules(cols: TxColumns = DEFAULT_COLUMNS,
                     label_classes: Sequence[int] = LABEL_CLASSES) -> dict[str, Column]:
    """Named validation rules, in the order the reference applies them.

    A row is valid when every rule is TRUE; a NULL rule result rejects the
    row, as a ``filter`` does. Literals are integers so comparisons stay in
    the column's own type and reach the Parquet reader as pushed filters.
    """
    c = F.col
    return {
        f"{cols.id}_not_null": c(cols.id).isNotNull(),
        f"{cols.customer}_not_null": c(cols.customer).isNotNull(),
        f"{cols.terminal}_not_null": c(cols.terminal).isNotNull(),
        f"{cols.amount}_not_null": c(cols.amount).isNotNull(),
        f"{cols.label}_not_null": c(cols.label).isNotNull(),
        f"{cols.amount}_non_negative": c(cols.amount) >= F.lit(0),
        f"{cols.label}_in_classes": c(cols.label).isin(*label_classes),
        f"{cols.customer}_non_negative": c(cols.customer) >= F.lit(0),
        f"{cols.terminal}_non_negative": c(cols.terminal) >= F.lit(0),
        f"{cols.id}_positive": c(cols.id) > F.lit(0),
    }


def all_of(rules) -> Column:
    rules = list(rules.values()) if isinstance(rules, dict) else list(rules)
    return reduce(and_, rules)


def is_valid(cols: TxColumns = DEFAULT_COLUMNS) -> Column:
    """TRUE only for rows that pass every validation rule (never NULL)."""
    return F.coalesce(all_of(validation_rules(cols)), F.lit(False))


def label_consistent(cols: TxColumns = DEFAULT_COLUMNS) -> Column:
    """Label/scenario agreement: fraud needs a scenario, legit rows none.

    Kept as plain negated conjunctions: a NULL scenario on a 0/1 label makes
    one conjunct NULL and the filter drops the row, which is the reference's
    behaviour (a null-safe rewrite would keep such rows).
    """
    label, scenario = F.col(cols.label), F.col(cols.scenario)
    return (~((label == 1) & (scenario == 0))) & (~((label == 0) & (scenario > 0)))


def null_or_empty(df: DataFrame, name: str) -> Column:
    """NULL test that also counts the empty string, for string columns only.

    Comparing a numeric column with ``""`` fails under ANSI casting, and with
    ANSI off ``""`` casts to NULL, so only strings get the extra test.
    """
    field = df.schema[name]
    c = F.col(name)
    if isinstance(field.dataType, T.StringType):
        return c.isNull() | (c == F.lit(""))
    return c.isNull()
