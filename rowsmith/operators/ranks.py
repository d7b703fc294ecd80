"""Rank of a column's values over the whole table.

A rank depends on the value alone, so it is computed on the distinct values with their counts and
joined back. The only full-size shuffle is the join's, which the planner turns into a broadcast
when the distinct values are few, and whose repeated values adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions import checks, names
from rowsmith.functions.registry import RANK_METHODS
from rowsmith.operators.blocks import BLOCK, assign_blocks, carry_in, find_cuts

_VALUE, _COUNT, _PLACE, _BELOW = "__value", "__count", "__place", "__below"


def _ranked_values(df: DataFrame, column: str, method: str, rows_per_block: int | None) -> DataFrame:
    present = df.select(F.col(column).alias(_VALUE)).filter(F.col(_VALUE).isNotNull())
    cuts = find_cuts(present, [], [_VALUE], rows_per_block)
    values = present.groupBy(_VALUE).agg(F.count(F.lit(1)).alias(_COUNT))
    if cuts:
        values = assign_blocks(values, cuts)
        earlier = {"__values_before": F.count(F.lit(1)), "__rows_before": F.sum(_COUNT)}
        values = carry_in(values, cuts, earlier).fillna(0, list(earlier))
        spec = Window.partitionBy(BLOCK).orderBy(_VALUE)
    else:
        values = values.withColumns({"__values_before": F.lit(0), "__rows_before": F.lit(0)})
        spec = Window.orderBy(_VALUE)
    below = F.sum(_COUNT).over(spec.rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumns(
        {
            _PLACE: F.row_number().over(spec) + F.col("__values_before"),
            _BELOW: F.coalesce(below, F.lit(0)) + F.col("__rows_before"),
        }
    )
    ranks: dict[str, Column] = {
        "dense": F.col(_PLACE).cast("bigint"),
        "min": (F.col(_BELOW) + 1).cast("bigint"),
        "average": F.col(_BELOW) + (F.col(_COUNT) + 1) / 2,
    }
    return values.select(_VALUE, ranks[method].alias(names.derived(names.RANK, column)))


def rank(
    df: DataFrame,
    columns: Sequence[str],
    method: str,
    rows_per_block: int | None = None,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Add the ascending rank of each column; a null has no rank.

    ``measured`` is a cheaper table with the same values, to rank instead of ``df``'s own columns.
    """
    if method not in RANK_METHODS:
        raise ValueError(f"unknown rank method {method!r}, expected one of {', '.join(RANK_METHODS)}")
    checks.require_columns(df, columns)
    checks.require_new_names(df, [names.derived(names.RANK, c) for c in columns])
    source = measured or df
    for column in columns:
        ranked = _ranked_values(source, column, method, rows_per_block)
        df = df.join(ranked, F.col(column) == F.col(_VALUE), "left").drop(_VALUE)
    return df
