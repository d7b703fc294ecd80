"""Combinations of the basic operators into one feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rowsmith.functions import names
from rowsmith.operators import aggregates, filters, ranks, windows


def feature_bundle(
    df: DataFrame,
    columns: Sequence[str],
    window_sizes: Sequence[int],
    lags: Sequence[int],
    rank_method: str,
    order_by: Sequence[str],
    partition_by: Sequence[str],
    rows_per_block: int | None = None,
) -> DataFrame:
    """For every column: whole-table rolling sum, running total per key, and rank."""
    features = windows.rolling_list(columns, window_sizes, lags, "rolling_sum", names.ROLLING)
    rolled = windows.rolling(df, features, order_by, rows_per_block=rows_per_block)
    summed = windows.cumulative_sum(rolled, columns, order_by, partition_by, rows_per_block, df)
    return ranks.rank(summed, columns, rank_method, rows_per_block, df)


def clean_roll_group(
    df: DataFrame,
    not_null: str,
    feature: windows.Rolling,
    over: Sequence[str],
    order_by: Sequence[str],
    group_by: Sequence[str],
    aggregate_column: str,
    aggregate_op: str,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Drop rows without a value, add a rolling feature per key, then aggregate per group.

    The aggregate may use the rolling feature or a source column. Grouping by the window's key
    needs no second shuffle of the rows.
    """
    clean = filters.not_null(df, not_null)
    rolled = windows.rolling(clean, [feature], order_by, over, rows_per_block)
    return aggregates.group(rolled, group_by, aggregate_column, aggregate_op)
