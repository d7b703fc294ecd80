"""Flows: read tables, transform them with the operators, write Parquet.

Each function takes paths and parameters, runs one write and returns the written path.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from rowsmith.functions import checks, names
from rowsmith.operators import aggregates, features, joins, scaling, windows
from rowsmith.sources import readers, writers

Schema = readers.Schema
Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RollingStrategy:
    """Rolling features where each column is its own key."""

    op: str
    columns: Sequence[str]
    window_sizes: Sequence[int]
    lags: Sequence[int]
    order_by: Sequence[str]
    rows_per_block: int | None = None

    def apply(self, tables: Sequence[DataFrame]) -> DataFrame:
        (table,) = _exactly(tables, 1)
        wanted = windows.rolling_list(self.columns, self.window_sizes, self.lags, self.op)
        return windows.rolling_over_self(table, wanted, self.order_by, self.rows_per_block)


@dataclass(frozen=True)
class MlStrategy:
    """Scaling by ``minmax`` or ``standard``, or whole-table aggregates by ``aggregate``."""

    scaler: str
    columns: Sequence[str] = ()
    aggregations: Mapping[str, str] | None = None

    def apply(self, tables: Sequence[DataFrame]) -> DataFrame:
        (table,) = _exactly(tables, 1)
        if self.scaler == "minmax":
            return scaling.minmax(table, self.columns)
        if self.scaler == "standard":
            return scaling.zscore(table, self.columns)
        if self.scaler == "aggregate":
            return aggregates.spread_map(table, self.aggregations or {})
        raise ValueError(f"unknown scaler {self.scaler!r}")


@dataclass(frozen=True)
class JoinStrategy:
    """Label the first table by SQL predicates, then join the second."""

    on: str
    how: str
    predicates: Sequence[str] = ()
    then: str = names.HIGH_LABEL
    otherwise: str = names.LOW_LABEL
    join_filter: bool = True

    def apply(self, tables: Sequence[DataFrame]) -> DataFrame:
        left, right = checks.require_two_tables(tables)
        return joins.label_then_join(
            left, right, self.on, self.how, self.predicates, self.then, self.otherwise,
            self.join_filter,
        )


Strategy = RollingStrategy | MlStrategy | JoinStrategy


def _exactly(tables: Sequence[DataFrame], n: int) -> Sequence[DataFrame]:
    if len(tables) != n:
        raise ValueError(f"this strategy takes {n} table, got {len(tables)}")
    return tables


def _asserted(result: DataFrame, require_rows: bool, *sources: DataFrame) -> DataFrame:
    """With ``require_rows`` the flow's own job fails if a source is empty, and the target stays as it was."""
    return checks.asserting_rows(result, *sources) if require_rows else result


def transform_table(
    spark: SparkSession,
    source: str,
    target: str,
    transform: Transform,
    schema: Schema = None,
    require_rows: bool = False,
) -> str:
    """Read one table, transform it, replace the target."""
    df = readers.read_table(spark, source, schema)
    return writers.write_parquet(_asserted(transform(df), require_rows, df), target)


def filter_group(
    spark: SparkSession,
    source: str,
    target: str,
    where: str,
    value: Any,
    by: Sequence[str],
    column: str,
    op: str = "sum",
    schema: Schema = None,
    require_rows: bool = False,
) -> str:
    return transform_table(
        spark, source, target,
        lambda df: aggregates.filter_then_group(df, where, value, by, column, op), schema, require_rows,
    )


def rolling_columns(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    window: int,
    lag: int,
    order_by: Sequence[str],
    schema: Schema = None,
    rows_per_block: int | None = None,
    require_rows: bool = False,
) -> str:
    """Whole-table rolling mean of each column, with one window and lag for all."""
    n = len(columns)
    wanted = windows.rolling_list(columns, [window] * n, [lag] * n, "rolling_mean", names.ROLLING)
    return transform_table(
        spark, source, target,
        lambda df: windows.rolling(df, wanted, order_by, rows_per_block=rows_per_block), schema, require_rows,
    )


def normalize_column(
    spark: SparkSession,
    source: str,
    target: str,
    column: str,
    schema: Schema = None,
    require_rows: bool = False,
) -> str:
    return transform_table(
        spark, source, target, lambda df: scaling.normalize(df, column), schema, require_rows
    )


def join_tables(
    spark: SparkSession,
    sources: Sequence[str],
    target: str,
    on: str,
    how: str = "inner",
    missing: str = "error",
    schemas: Sequence[Schema] | None = None,
    require_rows: bool = False,
) -> str:
    tables = readers.read_tables(spark, sources, schemas, missing)
    left, right = checks.require_two_tables(tables)
    return writers.write_parquet(_asserted(joins.join(left, right, on, how), require_rows, left, right), target)


def features_by_strategy(
    spark: SparkSession,
    sources: Sequence[str],
    target: str,
    strategy: Strategy,
    partition_by: str | None = None,
    schemas: Sequence[Schema] | None = None,
    require_rows: bool = False,
) -> str:
    """Apply one strategy and write zstd Parquet, in folders of ``partition_by`` if given."""
    tables = readers.read_tables(spark, sources, schemas)
    result = _asserted(strategy.apply(tables), require_rows, *tables)
    if partition_by:
        return writers.write_partitioned(result, target, [partition_by])
    return writers.write_parquet(result, target, compression="zstd")


def rolling_cumulative(
    spark: SparkSession,
    source: str,
    target: str,
    op: str,
    columns: Sequence[str],
    window_sizes: Sequence[int],
    lags: Sequence[int],
    order_by: Sequence[str],
    partition_by: Sequence[str],
    rows_per_file: int | None = None,
    parts: int | None = None,
    rows_per_group: int | None = None,
    schema: Schema = None,
    require_rows: bool = False,
) -> str:
    """Running totals of rolling features, as ``parts`` files or files of ``rows_per_file`` rows.

    Files have row groups of ``rows_per_group`` rows.
    """
    df = readers.read_table(spark, source, schema)
    wanted = windows.rolling_list(columns, window_sizes, lags, op)
    result = windows.rolling_cumulative(df, wanted, order_by, partition_by)
    result = _asserted(result, require_rows, df)
    if parts:
        return writers.write_parts(result, target, parts, rows_per_file=rows_per_file, rows_per_group=rows_per_group)
    return writers.write_zstd(result, target, rows_per_file, rows_per_group=rows_per_group)


def feature_bundle(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    window_sizes: Sequence[int],
    lags: Sequence[int],
    rank_method: str,
    order_by: Sequence[str],
    partition_by: Sequence[str],
    schema: Schema = None,
    require_rows: bool = False,
) -> str:
    return transform_table(
        spark, source, target,
        lambda df: features.feature_bundle(
            df, columns, window_sizes, lags, rank_method, order_by, partition_by
        ),
        schema,
        require_rows,
    )


def label_and_join(
    spark: SparkSession,
    sources: Sequence[str],
    target: str,
    on: str,
    how: str,
    label_column: str,
    rows_per_file: int | None = None,
    partitioned: bool = False,
    num_partitions: int | None = None,
    schemas: Sequence[Schema] | None = None,
    require_rows: bool = False,
) -> str:
    """Threshold-label, join (``partitioned``: into a fixed number of partitions), and write a new table."""
    left, right = checks.require_two_tables(readers.read_tables(spark, sources, schemas))
    checks.require_numeric(left, [label_column])
    joined = joins.label_both_then_join(
        left, right, on, how, label_column, num_partitions, partitioned
    )
    joined = _asserted(joined, require_rows, left, right)
    return writers.write_parquet(joined, target, "errorifexists", "zstd", rows_per_file)


def scale_or_aggregate(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    scaler: str | None = None,
    aggregate: str | None = None,
    rows_per_file: int | None = None,
    schema: Schema = None,
    require_rows: bool = False,
) -> str:
    """Guarded scaling by ``scaler``, or one whole-table ``aggregate`` of all columns."""
    if (scaler is None) == (aggregate is None):
        raise ValueError("choose either a scaler or an aggregate")
    df = readers.read_table(spark, source, schema)
    if scaler:
        result = scaling.guarded(df, columns, scaler)
    else:
        result = aggregates.spread(df, columns, aggregate)
    result = _asserted(result, require_rows, df)
    return writers.write_parquet(result, target, compression="zstd", rows_per_file=rows_per_file)


def multi_stage(
    spark: SparkSession,
    source: str,
    target: str,
    not_null: str,
    feature: windows.Rolling,
    over: Sequence[str],
    order_by: Sequence[str],
    group_by: Sequence[str],
    aggregate_column: str,
    aggregate_op: str,
    schema: Schema = None,
    require_rows: bool = False,
) -> str:
    """Drop nulls, roll over a key, aggregate per group, and write a table that must not exist yet."""
    df = readers.read_table(spark, source, schema)
    result = features.clean_roll_group(
        df, not_null, feature, over, order_by, group_by, aggregate_column, aggregate_op
    )
    result = _asserted(result, require_rows, df)
    return writers.write_parquet(result, target, "errorifexists")
