"""Grouped and whole-table aggregates.

All of them aggregate partially before the shuffle, so a key that holds most of the rows costs no
more than any other. Grouped sums of no values are null; whole-column totals of none are 0. Spark
orders NaN above all numbers, so a grouped maximum with a NaN is NaN.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import checks, exact, names
from rowsmith.functions.registry import AGGREGATES, pick
from rowsmith.operators.filters import equal_to


def group(
    df: DataFrame, by: Sequence[str], column: str, op: str, name: str | None = None, exactly: bool = False
) -> DataFrame:
    """One row per group. With ``exactly``, sums and means of doubles are exact sums, rounded once.

    Plain sums of doubles depend on the order in which partial sums meet. Exact ones do not; they need
    a job that measures the column first.
    """
    checks.require_columns(df, by)
    checks.require_numeric(df, [column])
    output = name or names.derived(names.BY_OPERATION, column, op)
    aggregate = pick(AGGREGATES, op)
    if not exactly or op not in ("sum", "mean") or not exact.inexact(df.schema[column].dataType):
        return df.groupBy(*by).agg(aggregate(F.col(column)).alias(output))
    digits = exact.measure(df, [column])[column]
    sums = [f"__sum_{i}" for i in range(digits.parts())]
    parts = [F.sum(p).alias(n) for p, n in zip(exact.parts(F.col(column), digits), sums)]
    found = exact.totals(df.groupBy(*by).agg(*parts, F.count(column).alias("__n")), {output: (sums, digits)})
    if op == "mean":
        found = found.withColumn(output, F.col(output) / F.col("__n"))
    return found.drop(*sums, "__n")


def filter_then_group(
    df: DataFrame,
    where: str,
    value: Any,
    by: Sequence[str],
    column: str,
    op: str = "sum",
    name: str = names.FILTERED_TOTAL,
) -> DataFrame:
    return group(equal_to(df, where, value), by, column, op, name)


def spread_map(df: DataFrame, ops: Mapping[str, str]) -> DataFrame:
    """Repeat whole-table aggregates, one operation per column, on every row.

    The aggregates are one scalar subquery: its single row is computed once and reaches the tasks
    as a constant, without moving the table's rows.
    """
    checks.require_numeric(df, ops)
    outputs = {names.derived(names.BY_OPERATION, c, op): (c, op) for c, op in ops.items()}
    checks.require_new_names(df, list(outputs))
    stats = F.struct(*(pick(AGGREGATES, op)(F.col(c)).alias(n) for n, (c, op) in outputs.items()))
    found = df.agg(stats.alias("stats")).scalar()
    return df.withColumns({n: found[n] for n in outputs})


def spread(df: DataFrame, columns: Sequence[str], op: str) -> DataFrame:
    """``spread_map`` with the same operation for all columns."""
    checks.require_unique(columns)
    return spread_map(df, {c: op for c in columns})


def column_mean(df: DataFrame, column: str) -> DataFrame:
    """One row with the column's mean; the job fails on a column without values."""
    checks.require_numeric(df, [column])
    mean = F.when(F.count(column) == 0, F.raise_error(F.lit(f"column {column} has no values")))
    output = names.derived(names.BY_OPERATION, column, "mean")
    return df.agg(mean.otherwise(F.avg(column)).alias(output))


def guarded_sum(df: DataFrame, column: str, limit: float = names.SUM_LIMIT) -> DataFrame:
    """One row with the column's total, 0 if it has no values; the job fails where it exceeds ``limit``."""
    checks.require_numeric(df, [column])
    total = F.coalesce(F.sum(column), F.lit(0))
    message = F.concat(F.lit(f"sum of {column} exceeds {limit}: "), total.cast("string"))
    output = names.derived(names.BY_OPERATION, column, "sum")
    return df.agg(F.when(total > limit, F.raise_error(message)).otherwise(total).alias(output))


def sum_times(df: DataFrame, column: str, factor: float = 0) -> DataFrame:
    """One row with the column's total, 0 if it has no values, times ``factor``."""
    checks.require_numeric(df, [column])
    return df.agg((F.coalesce(F.sum(column), F.lit(0)) * F.lit(factor)).alias(f"sum_times_{column}"))


def summarize_samples(df: DataFrame, metric: str, value: str) -> DataFrame:
    """Mean, maximum, minimum and number of the samples of each metric that has any."""
    checks.require_columns(df, [metric])
    checks.require_numeric(df, [value])
    sampled = df.filter(F.col(value).isNotNull())
    return sampled.groupBy(metric).agg(
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.count(value).alias("samples"),
    )
