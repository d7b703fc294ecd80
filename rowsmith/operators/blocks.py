"""Ordered blocks: how positional operators stay parallel when a group is huge.

A window over a whole table, or over one key that holds a large share of the rows, would put
that group into a single task. Here such a group is cut, along its row order, into consecutive
blocks, and the window is partitioned by (keys, block):

* ``measure`` counts the rows of each group. Groups within ``rows_per_block`` are left alone,
  so a table without large groups keeps the plain one-shuffle window plan. For larger groups the
  cut points come from a sample of the order columns, taken in the same pass. The sample decides only where a
  cut lies, never which rows are kept, so results are exact for every choice of cuts.
* ``assign_blocks`` finds each row's block by binary search in its group's cut points.
* ``with_halo`` copies the few rows a window reaches beyond its block into that block.
* ``carry_in`` gives the total of all earlier blocks of the group, for running totals.

What reaches the driver or is broadcast is the cut points, at most ``2 * MAX_BLOCKS`` of them
whatever the table size, because blocks grow once that many are reached.

The order columns must order the rows of a group totally; nulls come first, as in Spark's
ascending sort.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F

from rowsmith.functions import exact
from rowsmith.operators.arrow_ops import outermost_rows

ROWS_PER_BLOCK = 1_000_000
MAX_BLOCKS = 65_536
SAMPLED_ROWS_PER_BLOCK = 16
# Spark limits the rows of a ranked group before the shuffle only below this rank.
RANKED_BY_SPARK = 1_000

BLOCK = "__block"
CUT = "__cut"
HOME = "__home"
_POINTS = "__points"
_HERE = "__here"
_ROWS = "__rows"
_PLACE = "__place"
_TARGETS = "__targets"


@dataclass(frozen=True)
class Cuts:
    """Cut points of the large groups: one row per group, with the keys and a sorted array."""

    table: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    longest: int


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_block: int | None = None
) -> Cuts | None:
    """Cut points for the groups with more than ``rows_per_block`` rows, or None if there are none."""
    return measure(df, keys, order, rows_per_block)[0]


def measure(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_block: int | None = None,
    doubles: Sequence[str] = (),
) -> tuple[Cuts | None, dict[str, exact.Digits]]:
    """``find_cuts``, and the digits that exact sums of some double columns need, in one pass.

    Rows are counted by group and sampled by a hash of their order columns in the same aggregate,
    so a row that comes twice is sampled once; magnitudes are metrics observed beside it. The driver gets one row
    for each large group. If these need more than MAX_BLOCKS blocks together, blocks grow.
    """
    limit = rows_per_block or ROWS_PER_BLOCK
    source = df.select(*dict.fromkeys([*keys, *order, *doubles]))
    seen = Observation() if doubles else None
    if seen:
        source = source.observe(seen, *exact.ranges(doubles))
    every = max(1, limit // SAMPLED_ROWS_PER_BLOCK)
    point = F.when(F.pmod(F.xxhash64(*order), F.lit(every)) == 0, F.struct(*order))
    sizes = source.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS), F.collect_set(point).alias(_POINTS))
    large = sizes.filter(F.col(_ROWS) > limit).withColumn(_POINTS, F.sort_array(_POINTS))
    rows = _spaced(large, F.ceil(F.col(_ROWS) / limit)).collect()
    digits = exact.from_ranges(doubles, seen.get) if seen else {}
    total = sum(r[_ROWS] for r in rows)
    grown = max(limit, math.ceil(total / MAX_BLOCKS))
    found = []
    for *group, n, points in rows:
        blocks, size = math.ceil(n / grown), len(points)
        if grown > limit:
            step = min(blocks, size + 1)
            points = [points[i * size // step] for i in range(1, step)]
        if points:
            found.append((*group, points))
    if not found:
        return None, digits
    table = df.sparkSession.createDataFrame(found, large.drop(_ROWS).schema)
    return Cuts(table, tuple(keys), tuple(order), max(len(points) for *_, points in found)), digits


def _spaced(large: DataFrame, blocks: Column) -> DataFrame:
    """As many of the sorted points, evenly spaced, as cut a group into ``blocks`` blocks."""
    at = F.transform(
        F.sequence(F.lit(1), F.least(blocks - 1, F.size(_POINTS))),
        lambda i: F.get(_POINTS, F.floor(i * F.size(_POINTS) / F.least(blocks, F.size(_POINTS) + 1)).cast("int")),
    )
    return large.withColumn(_POINTS, F.when(F.size(_POINTS) > 0, F.array_distinct(at)).otherwise(F.col(_POINTS)))


def _match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where null equals null, as it does for groups; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"__match_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__match_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*(f"__match_{k}" for k in keys))


def assign_blocks(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Add the block number, which is the number of the group's cut points at or below the row, and
    whether the group is cut at all.

    The binary search is unrolled, one projection per step: each step uses the last one's result
    several times, so the steps stay separate and are compiled, where a lambda over the array would
    be interpreted for every row and step.
    """
    if cuts.keys:
        found = _match_keys(df, F.broadcast(cuts.table), cuts.keys, "left")
    else:
        found = df.withColumn(_POINTS, cuts.table.select(_POINTS).scalar())
    found = found.withColumns({_HERE: F.struct(*cuts.order), BLOCK: F.lit(0)})
    for bit in reversed(range(cuts.longest.bit_length())):
        beyond = F.col(BLOCK) + (1 << bit)
        above = F.get(_POINTS, beyond - 1) <= F.col(_HERE)
        found = found.withColumn(BLOCK, F.when(above, beyond).otherwise(F.col(BLOCK)))
    return found.withColumn(CUT, F.col(_POINTS).isNotNull()).drop(_POINTS, _HERE)


def _block_sizes(blocked: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = F.count(F.lit(1)).alias(_ROWS)
    return blocked.filter(CUT).groupBy(*keys, BLOCK).agg(rows)


def with_halo(
    blocked: DataFrame, cuts: Cuts, columns: Sequence[str], back: int, ahead: int
) -> DataFrame:
    """All rows, plus copies of the ``back`` rows before and ``ahead`` rows after each block.

    Copies carry the keys, the order and ``columns``, and are marked by a false ``__home``. A block
    shorter than the reach takes rows from as many neighbours as it needs. Every task sends at most the reach of
    each block: Spark sees to that for short reaches, ``outermost_rows`` for long ones.
    """
    keys, order = cuts.keys, cuts.order
    kept = list(dict.fromkeys([*keys, *order, *columns]))
    narrow = blocked.filter(CUT).select(*kept, BLOCK)
    by_block = Window.partitionBy(*keys).orderBy(BLOCK)
    sized = _block_sizes(blocked, keys).withColumn(
        "__end", F.sum(_ROWS).over(by_block.rowsBetween(Window.unboundedPreceding, 0))
    )
    in_block = Window.partitionBy(*keys, BLOCK)
    result = blocked.withColumn(HOME, F.lit(True))

    def copies(reach: int, place: WindowSpec, targets: Column, last: bool) -> DataFrame:
        near = narrow if reach < RANKED_BY_SPARK else outermost_rows(narrow, [*keys, BLOCK], order, reach, last)
        near = near.withColumn(_PLACE, F.row_number().over(place)).filter(F.col(_PLACE) <= reach)
        to = sized.withColumn("__beside", F.lead(BLOCK).over(by_block)).withColumn(
            "__before", F.lag(BLOCK).over(by_block)
        )
        to = to.withColumn("__start", F.col("__end") - F.col(_ROWS))
        to = to.select(*keys, BLOCK, targets.alias(_TARGETS)).filter(F.size(_TARGETS) > 0)
        moved = _match_keys(near, F.broadcast(to), [*keys, BLOCK], "inner")
        return moved.select(*kept, F.explode(_TARGETS).alias(BLOCK), F.lit(False).alias(HOME))

    # Two blocks are in reach when the rows between them number less than the reach: the start of
    # the later one is the end of its predecessor, so a range frame over the ends finds them.
    if back:
        by_end = Window.partitionBy(*keys).orderBy("__end").rangeBetween(0, back - 1)
        later = F.collect_list("__beside").over(by_end)
        place = in_block.orderBy(*(F.desc(c) for c in order))
        result = result.unionByName(copies(back, place, later, True), allowMissingColumns=True)
    if ahead:
        by_start = Window.partitionBy(*keys).orderBy("__start").rangeBetween(1 - ahead, 0)
        earlier = F.collect_list("__before").over(by_start)
        place = in_block.orderBy(*order)
        result = result.unionByName(copies(ahead, place, earlier, False), allowMissingColumns=True)
    return result


def carry_in(blocked: DataFrame, cuts: Cuts, totals: dict[str, Column]) -> DataFrame:
    """Add, under each given name, the aggregate's total over the earlier blocks of the row's group."""
    keys = cuts.keys
    sums = blocked.filter(CUT).groupBy(*keys, BLOCK).agg(*(c.alias(n) for n, c in totals.items()))
    earlier = (
        Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = sums.select(*keys, BLOCK, *(F.sum(n).over(earlier).alias(n) for n in totals))
    return _match_keys(blocked, F.broadcast(sums), [*keys, BLOCK], "left")


def positional(
    df: DataFrame,
    cuts: Cuts | None,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    back: int,
    ahead: int,
    add: Callable[[DataFrame, Sequence[str]], DataFrame],
) -> DataFrame:
    """Add window columns that reach ``back`` rows before and ``ahead`` rows after the current one.

    ``df`` is a table with blocks assigned if there are cuts, and keeps them. ``add`` gets a table and
    the columns that make its groups.
    """
    if cuts is None:
        return add(df, list(keys))
    reached = with_halo(df, cuts, columns, back, ahead)
    return add(reached, [*keys, BLOCK]).filter(HOME).drop(HOME)
