"""Row filters and filters inside list columns."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import checks


def equal_to(df: DataFrame, column: str, value: Any) -> DataFrame:
    checks.require_columns(df, [column])
    return df.filter(F.col(column) == F.lit(value))


def not_null(df: DataFrame, column: str) -> DataFrame:
    checks.require_columns(df, [column])
    return df.filter(F.col(column).isNotNull())


def even_rows(df: DataFrame, column: str) -> DataFrame:
    checks.require_numeric(df, [column])
    return df.filter(F.col(column) % 2 == 0)


def even_values(values: Column, ordered: bool = False) -> Column:
    """The even members of a list, in place or ascending; a list without any stays, empty."""
    kept = F.filter(values, lambda v: v % 2 == 0)
    return F.sort_array(kept) if ordered else kept


def latest_lists(df: DataFrame, name: str, section: str, values: str) -> DataFrame:
    """One list per name: the one of the highest section replaces the earlier ones.

    Of several lists of the highest section it is the one with the greatest hash, and of equal hashes the
    greatest list: always the same one, in whatever order the rows come.
    """
    checks.require_columns(df, [name, section, values])
    order = F.struct(F.col(section), F.xxhash64(values), F.col(values))
    return df.groupBy(name).agg(F.max_by(values, F.when(F.col(section).isNotNull(), order)).alias(values))
