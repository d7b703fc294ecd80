"""Min-max and z-score scaling by whole-column statistics.

The statistics of all columns come from one aggregate in one scalar subquery, so scaling never
shuffles the table. NaN takes no part in the statistics, and stays NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import checks, names

# What a column without spread is scaled to.
ON_CONSTANT = {"zero": 0.0, "nan": float("nan"), "null": None}

SCALERS = ("minmax", "scaler")


def _scale(
    df: DataFrame,
    columns: Sequence[str],
    kind: str,
    pattern: str,
    on_constant: str,
    replace: bool,
) -> DataFrame:
    if on_constant not in ON_CONSTANT:
        raise ValueError(f"on_constant must be one of {', '.join(ON_CONSTANT)}, got {on_constant!r}")
    checks.require_one_table(df)
    checks.require_unique(columns)
    checks.require_numeric(df, columns)
    outputs = {c: c if replace else names.derived(pattern, c) for c in columns}
    if not replace:
        checks.require_new_names(df, list(outputs.values()))

    parts: list[Column] = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        if kind == "minmax":
            parts += [F.min(x).alias(f"shift_{i}"), (F.max(x) - F.min(x)).alias(f"spread_{i}")]
        else:
            parts += [F.avg(x).alias(f"shift_{i}"), F.stddev_samp(x).alias(f"spread_{i}")]
    stats = df.agg(F.struct(*parts).alias("stats")).scalar()
    flat = F.lit(ON_CONSTANT[on_constant]).cast("double")

    def scaled(i: int, c: str) -> Column:
        x, shift, spread = F.col(c), stats[f"shift_{i}"], stats[f"spread_{i}"]
        # The divisor is guarded in every case: ANSI mode raises on a division by zero.
        constant = F.when(x.isNotNull(), flat) if on_constant == "nan" else flat
        return F.when(spread == 0, constant).otherwise((x - shift) / spread)

    return df.withColumns({outputs[c]: scaled(i, c) for i, c in enumerate(columns)})


def minmax(
    df: DataFrame,
    columns: Sequence[str],
    pattern: str = names.MINMAX,
    on_constant: str = "nan",
    replace: bool = False,
) -> DataFrame:
    """Scale each column to 0..1 by its minimum and maximum."""
    return _scale(df, columns, "minmax", pattern, on_constant, replace)


def normalize(df: DataFrame, column: str) -> DataFrame:
    """``minmax`` of one column."""
    return minmax(df, [column], names.NORMALIZED)


def zscore(
    df: DataFrame,
    columns: Sequence[str],
    pattern: str = names.ZSCORE,
    on_constant: str = "nan",
    replace: bool = False,
) -> DataFrame:
    """Centre each column on its mean and divide by its sample standard deviation."""
    return _scale(df, columns, "zscore", pattern, on_constant, replace)


def guarded(df: DataFrame, columns: Sequence[str], scaler: str) -> DataFrame:
    """Scale by a named method; a constant column becomes 0."""
    if scaler == "minmax":
        return minmax(df, columns, names.GUARDED_MINMAX, "zero")
    if scaler == "scaler":
        return zscore(df, columns, names.GUARDED_ZSCORE, "zero")
    raise ValueError(f"unknown scaler {scaler!r}, expected one of {', '.join(SCALERS)}")
