"""Window expressions for positional features."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, LongType

from rowsmith.functions import exact
from rowsmith.functions.registry import AGGREGATES

# From this window on, rolling features are computed in runs unless a caller says otherwise.
RUNS_FROM = 64

_ROW, _RUN = "__row", "__run"


class Frame(NamedTuple):
    """One rolling feature: its output, column, type, aggregate, window and lag, and the digits of an exact sum."""

    output: str
    column: str
    dtype: DataType
    aggregate: str
    window: int
    lag: int
    digits: exact.Digits | None = None


def _summed(f: Frame) -> Column:
    """The value as it is added up: exact for exact types, whatever the window."""
    value = F.col(f.column)
    return value.cast("decimal(20,0)") if f.aggregate == "mean" and isinstance(f.dtype, IntegralType) else value


def _finished(f: Frame, total: Column) -> Column:
    if f.aggregate == "mean":
        if isinstance(f.dtype, DecimalType):
            p, s = f.dtype.precision, f.dtype.scale
            return (total / f.window).cast(DecimalType(min(38, p + 4), min(38, s + 4)))
        return total.cast("double") / f.window
    if f.aggregate == "sum":
        if isinstance(f.dtype, DecimalType):
            return total.cast(DecimalType(min(38, f.dtype.precision + 10), f.dtype.scale))
        if isinstance(f.dtype, IntegralType):
            return total.cast(LongType())
    return total


def _function(f: Frame):
    return F.sum if f.aggregate in ("sum", "mean") else AGGREGATES[f.aggregate]


def _pieces(f: Frame) -> list[Column]:
    """What is aggregated for the feature: its value, or the digits of a double."""
    if f.digits is None:
        return [_function(f)(_summed(f))]
    return [F.sum(p) for p in exact.parts(F.col(f.column), f.digits)]


def _put_together(df: DataFrame, frames: Sequence[Frame], outputs: Sequence[str], pieces: Sequence[list[str]]) -> DataFrame:
    """The features' values from their aggregated pieces, which are dropped."""
    digits = {o: (names, f.digits) for f, o, names in zip(frames, outputs, pieces) if f.digits}
    if digits:
        df = exact.totals(df, digits)
    values = {o: _finished(f, F.col(o if f.digits else names[0])) for f, o, names in zip(frames, outputs, pieces)}
    return df.withColumns(values).drop(*(n for names in pieces for n in names))


def rolling(
    df: DataFrame, by: Sequence[str], order: Sequence[str], frames: Sequence[Frame], runs_from: int = RUNS_FROM
) -> DataFrame:
    """Add aggregates of ``window`` rows ending ``lag`` rows back; null unless all of them hold a value.

    Spark evaluates a sliding frame anew for every row, at a cost that grows with the window. So
    windows of ``runs_from`` rows or more are put together from two parts: the ordered group is
    cut into runs as long as the window, and a window is the end of one run and the start of the
    next. Both parts are running aggregates within a run, so the cost does not depend on the
    window, nothing is added up beyond it, and any aggregate and type works. The results equal
    those of sliding frames bit for bit: doubles with ``digits`` are added exactly.
    """
    spec = Window.partitionBy(*by).orderBy(*order)
    near = [f for f in frames if f.window < runs_from]
    far = [f for f in frames if f.window >= runs_from]
    if near:
        columns, pieces = {}, []
        for k, f in enumerate(near):
            frame = spec.rowsBetween(-(f.window - 1) - f.lag, -f.lag)
            full = F.count(f.column).over(frame) >= f.window
            pieces.append([f"__near_{k}_{i}" for i in range(len(_pieces(f)))])
            columns |= {n: F.when(full, p.over(frame)) for n, p in zip(pieces[-1], _pieces(f))}
        df = _put_together(df.withColumns(columns), near, [f.output for f in near], pieces)
    if not far:
        return df
    df = df.withColumn(_ROW, F.row_number().over(spec) - 1)
    for window in sorted({f.window for f in far}):
        df = _in_runs(df, by, order, spec, window, [f for f in far if f.window == window])
    return df.drop(_ROW)


def _in_runs(
    df: DataFrame, by: Sequence[str], order: Sequence[str], spec: WindowSpec, window: int, frames: Sequence[Frame]
) -> DataFrame:
    df = df.withColumn(_RUN, F.floor(F.col(_ROW) / window))
    upto = (Window.unboundedPreceding, Window.currentRow)
    runs = Window.partitionBy(*by, _RUN)
    ahead, back = runs.orderBy(_ROW).rowsBetween(*upto), runs.orderBy(F.desc(_ROW)).rowsBetween(*upto)
    parts: dict[str, Column] = {}
    pieces = []
    for i, f in enumerate(frames):
        pieces.append([f"{i}_{k}" for k in range(len(_pieces(f)))])
        for k, value in zip(pieces[-1], _pieces(f)):
            parts |= {f"__head_{k}": value.over(ahead), f"__tail_{k}": value.over(back)}
        parts |= {f"__heads_{i}": F.count(f.column).over(ahead), f"__tails_{i}": F.count(f.column).over(back)}
    df = df.withColumns(parts)
    whole = F.pmod(F.col(_ROW), F.lit(window)) == window - 1
    values: dict[str, Column] = {}
    for i, f in enumerate(frames):
        tails = F.lag(f"__tails_{i}", window - 1).over(spec)
        full = F.when(whole, F.col(f"__heads_{i}")).otherwise(F.col(f"__heads_{i}") + tails) >= window
        for k in pieces[i]:
            head, tail = F.col(f"__head_{k}"), F.lag(f"__tail_{k}", window - 1).over(spec)
            both = {"min": F.least, "max": F.greatest}.get(f.aggregate, lambda a, b: F.coalesce(a + b, a, b))(head, tail)
            values[f"__piece_{k}"] = F.when(full, F.when(whole, head).otherwise(both))
    outputs = [f"__value_{i}" for i in range(len(frames))]
    named = [[f"__piece_{k}" for k in names] for names in pieces]
    df = _put_together(df.withColumns(values), frames, outputs, named)
    moved = {
        f.output: F.lag(o, f.lag).over(spec) if f.lag else F.col(o)
        for f, o in zip(frames, outputs)
    }
    return df.withColumns(moved).drop(_RUN, *parts, *outputs)


def running_sum(column: str, spec: WindowSpec, value: Column | None = None) -> Column:
    """Running total of the column, or of a value made of it; rows without a value stay null and do not reset it."""
    frame = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.when(F.col(column).isNotNull(), F.sum(column if value is None else value).over(frame))
