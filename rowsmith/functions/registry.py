"""Operators that can be chosen by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}

ROLLING_OPS = ("rolling_mean", "rolling_sum", "rolling_min", "rolling_max")

PREDICATES: dict[str, Callable[[Column], Column]] = {
    "is_null": F.isnull,
    "is_not_null": F.isnotnull,
    "is_nan": F.isnan,
    "is_not_nan": lambda c: ~F.isnan(c),
}

RANK_METHODS = ("average", "dense", "min")


def pick(table: Mapping[str, Callable[[Column], Column]], name: str) -> Callable[[Column], Column]:
    if name not in table:
        raise ValueError(f"unknown operator {name!r}, expected one of {', '.join(table)}")
    return table[name]


def rolling_aggregate(op: str) -> str:
    if op not in ROLLING_OPS:
        raise ValueError(f"unknown operator {op!r}, expected one of {', '.join(ROLLING_OPS)}")
    return op.removeprefix("rolling_")
