"""Argument checks made while a plan is built, before any data is read."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def folding(df: DataFrame) -> Callable[[str], str]:
    """How names compare in the table's session: by case only where ``spark.sql.caseSensitive`` is set."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    return str if sensitive else str.lower


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    fold = folding(df)
    there = {fold(c) for c in df.columns}
    missing = [c for c in columns if fold(c) not in there]
    if missing:
        raise ValueError(f"columns not in the table: {', '.join(missing)}")


def require_numeric(df: DataFrame, columns: Iterable[str]) -> None:
    columns = list(columns)
    require_columns(df, columns)
    other = [c for c in columns if not isinstance(df.schema[c].dataType, NumericType)]
    if other:
        raise ValueError(f"columns must be numeric: {', '.join(other)}")


def require_unique(columns: Sequence[str], df: DataFrame | None = None) -> None:
    """Reject repeated names; those of a table's columns compare as its session does."""
    fold = folding(df) if df is not None else str
    if len({fold(c) for c in columns}) != len(columns):
        raise ValueError(f"columns must be unique: {', '.join(columns)}")


def require_same_length(**lists: Sequence[Any]) -> None:
    if len({len(v) for v in lists.values()}) > 1:
        sizes = ", ".join(f"{k}={len(v)}" for k, v in lists.items())
        raise ValueError(f"lists must have the same length: {sizes}")


def require_window(window: int) -> None:
    if window < 1:
        raise ValueError(f"window must be at least 1, got {window}")


def require_lag(lag: int, lead_allowed: bool = False) -> None:
    if lag < 0 and not lead_allowed:
        raise ValueError(f"lag must be at least 0, got {lag}")


def require_order(order_by: Sequence[str]) -> None:
    if not order_by:
        raise ValueError("a positional operator needs order_by columns that order the rows totally")


def require_new_names(df: DataFrame, names: Sequence[str]) -> None:
    require_unique(names, df)
    fold = folding(df)
    there = {fold(c) for c in df.columns}
    clash = [n for n in names if fold(n) in there]
    if clash:
        raise ValueError(f"derived columns already exist: {', '.join(clash)}")


def require_one_table(table: Any) -> DataFrame:
    if isinstance(table, (list, tuple)):
        raise TypeError("this operator takes one table, not a list of tables")
    return table


def require_two_tables(tables: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    if len(tables) != 2:
        raise ValueError(f"a join takes exactly two tables, got {len(tables)}")
    return tables[0], tables[1]


def require_rows(df: DataFrame) -> DataFrame:
    """Reject an empty table; runs a job that stops at the first row."""
    if df.isEmpty():
        raise ValueError("the table has no rows")
    return df


def asserting_rows(result: DataFrame, *sources: DataFrame) -> DataFrame:
    """The same result, failing the job that computes it if one of its sources has no rows; no job of its own.

    The assertion is a branch of the plan without rows, which looks at the first row of each part of a source. To
    be evaluated in any case it comes last: a filter on top of it could make it superfluous.
    """
    none = F.raise_error(F.lit("the table has no rows")).cast("boolean")
    for source in sources:
        rows = source.select(F.lit(1).alias("one")).limit(1).agg(F.count("one").alias("n"))
        empty = rows.filter(F.when(F.col("n") == 0, none).otherwise(F.col("n") > 1))
        result = result.union(empty.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema)))
    return result


def require_suffix(path: str, allowed: Sequence[str]) -> None:
    if not path.rstrip("/").endswith(tuple(allowed)):
        raise ValueError(f"{path} must end in {' or '.join(allowed)}")
