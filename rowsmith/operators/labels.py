"""Two-valued labels derived from a condition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import checks, names
from rowsmith.functions.registry import PREDICATES, pick


def threshold(
    df: DataFrame,
    column: str,
    limit: float = names.LABEL_THRESHOLD,
    below: str = names.LOW_LABEL,
    otherwise: str = names.HIGH_LABEL,
    null_label: str | None = None,
) -> DataFrame:
    """Label rows below ``limit``; nulls get the other label unless ``null_label`` is given."""
    checks.require_numeric(df, [column])
    output = names.derived(names.THRESHOLD, column)
    checks.require_new_names(df, [output])
    label = F.when(F.col(column) < limit, below)
    if null_label is not None:
        label = label.when(F.col(column).isNull(), null_label)
    return df.withColumn(output, label.otherwise(otherwise))


def threshold_if_present(df: DataFrame, column: str, **options: Any) -> DataFrame:
    """``threshold`` where the table has the column, else the table as it is."""
    return threshold(df, column, **options) if column in df.columns else df


def sql_predicates(df: DataFrame, predicates: Sequence[str], then: str, otherwise: str) -> DataFrame:
    """Label by SQL conditions of the form ``<column> <operator> <value>``."""
    labels = {}
    for text in predicates:
        tokens = text.split()
        if len(tokens) != 3:
            raise ValueError(f"predicate must read '<column> <operator> <value>': {text!r}")
        checks.require_numeric(df, tokens[:1])
        output = names.derived(names.CATEGORY, tokens[0])
        if output in labels:
            raise ValueError(f"two predicates for column {tokens[0]}")
        labels[output] = F.when(F.expr(text), then).otherwise(otherwise)
    checks.require_new_names(df, list(labels))
    return df.withColumns(labels)


def named_predicates(
    df: DataFrame, predicates: Mapping[str, str], then: str, otherwise: str
) -> DataFrame:
    """Label by conditions chosen by name, one per column."""
    checks.require_columns(df, predicates)
    labels = {
        names.derived(names.CATEGORY, column): F.when(
            pick(PREDICATES, name)(F.col(column)), then
        ).otherwise(otherwise)
        for column, name in predicates.items()
    }
    checks.require_new_names(df, list(labels))
    return df.withColumns(labels)
