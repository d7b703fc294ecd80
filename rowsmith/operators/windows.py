"""Rolling, shifted and cumulative features over ordered rows, per key or over the whole table.

Every operator takes ``order_by``, columns that order the rows of a group totally: a Spark table
has no row order of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions import checks, exact, frames, names
from rowsmith.functions.registry import rolling_aggregate
from rowsmith.operators.blocks import (
    BLOCK,
    CUT,
    ROWS_PER_BLOCK,
    Cuts,
    assign_blocks,
    carry_in,
    find_cuts,
    measure,
    positional,
)


@dataclass(frozen=True)
class Rolling:
    """``op`` over ``window`` rows of ``column``, moved ``lag`` rows down (up if negative)."""

    column: str
    window: int
    lag: int = 0
    op: str = "rolling_mean"
    name: str | None = None

    @property
    def output(self) -> str:
        return self.name or names.derived(names.BY_OPERATION, self.column, self.op)


def rolling_list(
    columns: Sequence[str],
    windows: Sequence[int],
    lags: Sequence[int],
    op: str,
    pattern: str = names.BY_OPERATION,
) -> list[Rolling]:
    """Parallel lists of columns, windows and lags as rolling features."""
    checks.require_same_length(columns=columns, windows=windows, lags=lags)
    checks.require_unique(columns)
    return [
        Rolling(c, w, lag, op, names.derived(pattern, c, op))
        for c, w, lag in zip(columns, windows, lags)
    ]


def _check(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str]
) -> None:
    checks.require_one_table(df)
    checks.require_order(order)
    checks.require_columns(df, [*keys, *order])
    checks.require_numeric(df, columns)


def _check_rolling(
    df: DataFrame, features: Sequence[Rolling], keys: Sequence[str], order: Sequence[str], lead: bool
) -> None:
    _check(df, [f.column for f in features], keys, order)
    checks.require_new_names(df, [f.output for f in features])
    for f in features:
        rolling_aggregate(f.op)
        checks.require_window(f.window)
        checks.require_lag(f.lag, lead_allowed=lead)


def _reach(features: Sequence[Rolling]) -> tuple[int, int]:
    """How many rows before and after the current one the features use."""
    back = max(f.window - 1 + f.lag for f in features)
    ahead = max(-f.lag for f in features)
    return max(back, 0), max(ahead, 0)


def _cut_for(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_block: int | None,
    reach: tuple[int, int],
) -> Cuts | None:
    """Cut points for blocks at least as long as the reach, so that few blocks are in reach of one."""
    return find_cuts(df, keys, order, max(rows_per_block or ROWS_PER_BLOCK, *reach))


def _measure(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_block: int | None,
    reach: tuple[int, int],
    summed: Sequence[str],
) -> tuple[Cuts | None, dict[str, exact.Digits]]:
    """Cut points, and the digits of those columns whose sums would depend on the order of adding."""
    doubles = [c for c in dict.fromkeys(summed) if exact.inexact(df.schema[c].dataType)]
    if not doubles:
        return _cut_for(df, keys, order, rows_per_block, reach), {}
    return measure(df, keys, order, max(rows_per_block or ROWS_PER_BLOCK, *reach), doubles)


def _summed(features: Sequence[Rolling]) -> list[str]:
    return [f.column for f in features if rolling_aggregate(f.op) in ("sum", "mean")]


def _roll(
    df: DataFrame,
    cuts: Cuts | None,
    digits: dict[str, exact.Digits],
    features: Sequence[Rolling],
    keys: Sequence[str],
    order: Sequence[str],
    runs_from: int = frames.RUNS_FROM,
) -> DataFrame:
    types = {f.column: df.schema[f.column].dataType for f in features}
    wanted = []
    for f in features:
        op = rolling_aggregate(f.op)
        own = digits.get(f.column) if op in ("sum", "mean") else None
        wanted.append(frames.Frame(f.output, f.column, types[f.column], op, f.window, f.lag, own))

    def add(table: DataFrame, by: Sequence[str]) -> DataFrame:
        return frames.rolling(table, by, order, wanted, runs_from)

    return positional(df, cuts, keys, order, list(types), *_reach(features), add)


def _accumulate(
    df: DataFrame,
    cuts: Cuts | None,
    digits: dict[str, exact.Digits],
    outputs: dict[str, str],
    keys: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Running totals, ``outputs`` mapping each new name to its column; ``digits`` those of double columns."""
    pieces: dict[str, dict[str, Column]] = {}
    for i, (n, c) in enumerate(outputs.items()):
        values = exact.parts(F.col(c), digits[c]) if c in digits else [F.col(c)]
        pieces[n] = {f"__sum_{i}_{k}": v for k, v in enumerate(values)}
    carried = {n: f"__carry{n}" for made in pieces.values() for n in made} if cuts else {}
    types = df.agg(*(F.sum(v).alias(p) for made in pieces.values() for p, v in made.items())).schema
    if cuts:
        df = carry_in(df, cuts, {carried[p]: F.sum(v) for made in pieces.values() for p, v in made.items()})

    def add(table: DataFrame, by: Sequence[str]) -> DataFrame:
        spec = Window.partitionBy(*by).orderBy(*order)
        total = {}
        for n, c in outputs.items():
            for p, v in pieces[n].items():
                running = frames.running_sum(c, spec, v)
                if cuts:
                    earlier = F.when(F.col(c).isNotNull(), F.col(carried[p]))
                    running = F.coalesce(earlier + running, running, earlier).cast(types[p].dataType)
                total[p if c in digits else n] = running
        return table.withColumns(total)

    df = positional(df, cuts, keys, order, [], 0, 0, add).drop(*carried.values())
    if digits:
        exactly = {n: (list(pieces[n]), digits[c]) for n, c in outputs.items() if c in digits}
        df = exact.totals(df, exactly).drop(*(p for names_, _ in exactly.values() for p in names_))
    return df


def rolling(
    df: DataFrame,
    features: Sequence[Rolling],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    rows_per_block: int | None = None,
    measured: DataFrame | None = None,
    runs_from: int = frames.RUNS_FROM,
) -> DataFrame:
    """Add rolling features, over the whole ordered table or within ``partition_by``.

    ``measured`` is a cheaper table with the same keys and order, to count instead of ``df``.
    Windows of ``runs_from`` rows or more are computed in runs, at a cost that does not depend on the
    window, with the same results. Sums and means of doubles come from exact sums, rounded once.
    """
    _check_rolling(df, features, partition_by, order_by, lead=not partition_by)
    cuts, digits = _measure(
        measured or df, partition_by, order_by, rows_per_block, _reach(features), _summed(features)
    )
    blocked = assign_blocks(df, cuts) if cuts else df
    return _roll(blocked, cuts, digits, features, partition_by, order_by, runs_from).drop(BLOCK, CUT)


def rolling_over_self(
    df: DataFrame,
    features: Sequence[Rolling],
    order_by: Sequence[str],
    rows_per_block: int | None = None,
) -> DataFrame:
    """Rolling features where each column is also its own partition key."""
    source = df
    for f in features:
        df = rolling(df, [f], order_by, [f.column], rows_per_block, source)
    return df


def rolling_cumulative(
    df: DataFrame,
    features: Sequence[Rolling],
    order_by: Sequence[str],
    partition_by: Sequence[str],
    rows_per_block: int | None = None,
) -> DataFrame:
    """Running total, within the key, of a shifted rolling feature; of doubles from exact sums, rounded once."""
    checks.require_columns(df, partition_by)
    _check_rolling(df, features, partition_by, order_by, lead=False)
    cuts, digits = _measure(df, partition_by, order_by, rows_per_block, _reach(features), [f.column for f in features])
    inner = [
        Rolling(f.column, f.window, f.lag, f.op, f"__rolled_{i}") for i, f in enumerate(features)
    ]
    blocked = assign_blocks(df, cuts) if cuts else df
    rolled = _roll(blocked, cuts, digits, inner, partition_by, order_by)
    outputs = {f.output: i.output for f, i in zip(features, inner)}
    of_rolled = {
        i.output: exact.of_rolling(df.schema[i.column].dataType, digits.get(i.column), rolling_aggregate(i.op), i.window)
        for i in inner
        if exact.inexact(rolled.schema[i.output].dataType)
    }
    summed = _accumulate(rolled, cuts, of_rolled, outputs, partition_by, order_by)
    return summed.drop(BLOCK, CUT, *outputs.values())


def cumulative_sum(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    rows_per_block: int | None = None,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Add the running total of each column, of doubles from exact sums; ``measured`` as for ``rolling``."""
    _check(df, columns, partition_by, order_by)
    outputs = {names.derived(names.CUMULATIVE, c): c for c in columns}
    checks.require_new_names(df, list(outputs))
    cuts, digits = _measure(measured or df, partition_by, order_by, rows_per_block, (0, 0), columns)
    blocked = assign_blocks(df, cuts) if cuts else df
    return _accumulate(blocked, cuts, digits, outputs, partition_by, order_by).drop(BLOCK, CUT)


def shift(
    df: DataFrame,
    column: str,
    lag: int,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    name: str | None = None,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Add the value ``lag`` rows earlier (later if negative)."""
    checks.require_order(order_by)
    checks.require_columns(df, [column, *partition_by, *order_by])
    output = name or names.derived(names.BY_OPERATION, column, "shift")
    checks.require_new_names(df, [output])
    reach = max(lag, 0), max(-lag, 0)
    cuts = _cut_for(df, partition_by, order_by, rows_per_block, reach)
    blocked = assign_blocks(df, cuts) if cuts else df
    return positional(
        blocked, cuts, partition_by, order_by, [column], *reach,
        lambda table, by: table.withColumn(
            output, F.lag(column, lag).over(Window.partitionBy(*by).orderBy(*order_by))
        ),
    ).drop(BLOCK, CUT)
