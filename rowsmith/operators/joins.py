"""Equi-joins on same-named keys, whole under skewed keys.

Inner joins, and outer joins whose preserved side alone is skewed, are left to the planner:
adaptive execution broadcasts small sides and splits skewed partitions. It cannot split the side
that an outer join does not preserve (both sides of a full join), because unmatched rows would be
reported once per split. If such a side has a large key, the join is written as the inner join,
which can be split, plus the unmatched rows of each preserved side, found by an anti join on the
other side's distinct keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    MapType,
    NumericType,
    StructType,
    VariantType,
)

from rowsmith.functions import checks
from rowsmith.operators.labels import sql_predicates, threshold_if_present

ROWS_PER_TASK = 4_000_000
MAX_LARGE_KEYS = 16_384

HOW = {"inner": "inner", "left": "left", "right": "right", "outer": "full", "full": "full"}

_SALT, _SALTS, _ON_LEFT, _COPIES = "__salt", "__salts", "__on_left", "__copies"


def join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    suffix: str = "_right",
    coalesce_keys: bool = True,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Join two tables; columns of ``right`` whose names are taken get ``suffix``.

    Null keys match nothing. With ``coalesce_keys`` there is one key column; without it an outer
    join also keeps the right side's key, suffixed.
    """
    keys, how, left, right = _prepare(left, right, on, how, suffix)
    unsplittable = {"inner": [], "left": [right], "right": [left], "full": [left, right]}[how]
    limit = rows_per_task or ROWS_PER_TASK
    if any(_key_sizes(side, keys)[1] > limit for side in unsplittable):
        inner = left.join(right, _matching(keys), "inner")
        joined = _with_unmatched(inner, left, right, keys, how)
    else:
        joined = left.join(right, _matching(keys), how)
    return _named(joined, left, right, keys, how, suffix, coalesce_keys)


def join_partitioned(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    num_partitions: int | None = None,
    suffix: str = "_right",
    coalesce_keys: bool = True,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Join of both tables shuffled into ``num_partitions``; without a number, ``join``.

    A fixed number of partitions is out of adaptive execution's reach, so a large key is salted
    here: its rows on the larger side are spread over several partitions by a hash of their other
    columns, and its rows on the other side are copied to each of them. Rows that are equal in all
    columns travel as one row with their number, in shares of at most ``rows_per_task``, each with a
    salt of its own, and become so many rows again after the join.
    """
    if num_partitions is None:
        return join(left, right, on, how, suffix, coalesce_keys, rows_per_task)
    keys, how, left, right = _prepare(left, right, on, how, suffix)
    if num_partitions < 1:
        raise ValueError(f"num_partitions must be at least 1, got {num_partitions}")

    limit = rows_per_task or ROWS_PER_TASK
    sizes = [_key_sizes(side, keys) for side in (left, right)]
    if all(largest <= limit for _, largest in sizes):
        sides = (_spread(left, num_partitions, keys), _spread(right, num_partitions, _mates(keys)))
        joined = sides[0].join(sides[1], _matching(keys), how)
        return _named(joined, left, right, keys, how, suffix, coalesce_keys)

    limit = max(limit, *(math.ceil(total / MAX_LARGE_KEYS) for total, _ in sizes))
    salts = F.broadcast(_salts(left, right, keys, limit))
    salted_left = _salted(left, salts, keys, keys, F.col(_ON_LEFT), limit)
    salted_right = _salted(right, salts, keys, _mates(keys), ~F.col(_ON_LEFT), limit)
    salted_right = salted_right.withColumnsRenamed({_SALT: f"__mate{_SALT}", _COPIES: f"__mate{_COPIES}"})
    inner = _spread(salted_left, num_partitions, [*keys, _SALT]).join(
        _spread(salted_right, num_partitions, [*_mates(keys), f"__mate{_SALT}"]),
        [*_matching(keys), F.col(_SALT) == F.col(f"__mate{_SALT}")],
        "inner",
    )
    copies = F.array_repeat(F.lit(0), (F.col(_COPIES) * F.col(f"__mate{_COPIES}")).cast("int"))
    inner = inner.withColumn("__copy", F.explode(copies)).drop(
        _SALT, f"__mate{_SALT}", _COPIES, f"__mate{_COPIES}", "__copy"
    )
    joined = _with_unmatched(inner, left, right, keys, how)
    return _named(joined, left, right, keys, how, suffix, coalesce_keys)


def label_then_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str,
    predicates: Sequence[str],
    then: str,
    otherwise: str,
    join_filter: bool = True,
) -> DataFrame:
    """Label the left table by SQL predicates, unless ``join_filter`` is off, then join."""
    keys = [on] if isinstance(on, str) else list(on)
    checks.require_numeric(left, keys)
    checks.require_numeric(right, keys)
    labelled = sql_predicates(left, predicates, then, otherwise) if join_filter else left
    return join(labelled, right, on, how)


def label_both_then_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str,
    column: str,
    num_partitions: int | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """Threshold-label whichever table has ``column``, then join."""
    sides = [threshold_if_present(t, column) for t in (left, right)]
    if partitioned:
        return join_partitioned(*sides, on, how, num_partitions)
    return join(*sides, on, how)


def _mates(keys: Sequence[str]) -> list[str]:
    return [f"__mate_{k}" for k in keys]


def _matching(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) == F.col(m) for k, m in zip(keys, _mates(keys))]


def _prepare(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str, suffix: str
) -> tuple[list[str], str, DataFrame, DataFrame]:
    """Check the arguments and give the right table names that are free on the left."""
    if how not in HOW:
        raise ValueError(f"unknown join type {how!r}, expected one of {', '.join(HOW)}")
    keys = [on] if isinstance(on, str) else list(on)
    checks.require_columns(left, keys)
    checks.require_columns(right, keys)
    checks.require_unique(keys, left)
    fold = checks.folding(left)
    on_left, on_right = ({fold(c): c for c in side.columns} for side in (left, right))
    for k in keys:
        ours, theirs = (side.schema[names[fold(k)]].dataType for side, names in ((left, on_left), (right, on_right)))
        if ours != theirs and not (isinstance(ours, NumericType) and isinstance(theirs, NumericType)):
            raise ValueError(f"key {k} is {ours.simpleString()} on the left, {theirs.simpleString()} on the right")
    keys = [on_left[fold(k)] for k in keys]
    own = {fold(k) for k in keys}
    taken = {c: f"{c}{suffix}" for f, c in on_right.items() if f in on_left and f not in own}
    for name in taken.values():
        if fold(name) in on_left or fold(name) in on_right:
            raise ValueError(f"column {name} already exists, choose another suffix")
    renames = {**taken, **{on_right[fold(k)]: m for k, m in zip(keys, _mates(keys))}}
    return keys, HOW[how], left, right.withColumnsRenamed(renames)


def _own_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [k for k in keys if k in df.columns] or _mates(keys)


def _key_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the table and of its largest key, counted on the key columns only."""
    counts = df.groupBy(*_own_keys(df, keys)).agg(F.count(F.lit(1)).alias("rows"))
    total, largest = counts.agg(F.sum("rows"), F.max("rows")).first()
    return total or 0, largest or 0


def _with_unmatched(
    inner: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    parts = [inner]
    if how in ("left", "full"):
        others = right.select(*_mates(keys)).distinct()
        parts.append(left.join(others, _matching(keys), "left_anti"))
    if how in ("right", "full"):
        others = left.select(*keys).distinct()
        parts.append(right.join(others, _matching(keys), "left_anti"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _named(
    joined: DataFrame,
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    suffix: str,
    coalesce_keys: bool,
) -> DataFrame:
    mates = dict(zip(keys, _mates(keys)))
    keep_mates = not coalesce_keys and how != "inner"
    columns = []
    for c in left.columns:
        if c not in mates or keep_mates:
            columns.append(F.col(c))
        elif how == "right":
            columns.append(F.col(mates[c]).alias(c))
        elif how == "full":
            columns.append(F.coalesce(c, mates[c]).alias(c))
        else:
            columns.append(F.col(c))
    for c in right.columns:
        if c not in mates.values():
            columns.append(F.col(c))
    if keep_mates:
        columns += [F.col(m).alias(f"{k}{suffix}") for k, m in mates.items()]
    return joined.select(*columns)


def _spread(df: DataFrame, num_partitions: int, keys: Sequence[str]) -> DataFrame:
    return df.repartition(num_partitions, *keys)


def _salts(left: DataFrame, right: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The keys with more than ``limit`` rows, the side that has more, and the pieces to make.

    Each side has at most ``MAX_LARGE_KEYS`` of them, so the table may be broadcast.
    """
    def large(side: DataFrame, own: Sequence[str], rows: str) -> DataFrame:
        sizes = side.select(*(F.col(o).alias(k) for o, k in zip(own, keys)))
        return sizes.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows)).filter(F.col(rows) > limit)

    both = large(left, keys, "on_left").join(large(right, _mates(keys), "on_right"), keys, "full")
    on_left, on_right = F.coalesce("on_left", F.lit(0)), F.coalesce("on_right", F.lit(0))
    pieces = F.ceil(F.greatest(on_left, on_right) / limit).cast("int")
    return both.select(*keys, (on_left >= on_right).alias(_ON_LEFT), pieces.alias(_SALTS))


def _salted(
    df: DataFrame, salts: DataFrame, keys: Sequence[str], own: Sequence[str], spread_here: Column, limit: int
) -> DataFrame:
    """Add a salt and a number of copies: rows of large keys are spread over the salts here, or sent to all of them.

    A spread row's salt is a hash of its columns and of its share of the equal rows, so it depends neither
    on where the row was before nor on which task computes it.
    """
    match = salts.withColumnsRenamed({k: f"__large_{k}" for k in keys})
    same = [F.col(o) == F.col(f"__large_{k}") for o, k in zip(own, keys)]
    tagged = df.join(match, same, "left")
    to_spread = F.col(_SALTS).isNotNull() & spread_here
    choices = F.when(F.col(_SALTS).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col(_SALTS) - 1))
    copied = tagged.filter(~F.coalesce(to_spread, F.lit(False))).withColumn(_SALT, F.explode(choices))
    copied = copied.select(*df.columns, _SALT, F.lit(1).cast("bigint").alias(_COPIES))
    large = tagged.filter(to_spread)
    packed = {f.name: _groupable(f.dataType, F.col(f.name)) for f in df.schema}
    if any(v is None for v in packed.values()):
        # Values that can't be grouped: every row for itself, by a hash of the others.
        plain = [v for v in packed.values() if v is not None]
        piece = F.pmod(F.xxhash64(*plain), F.col(_SALTS)).cast("int")
        spread = large.withColumn(_SALT, piece).select(*df.columns, _SALT, F.lit(1).cast("bigint").alias(_COPIES))
        return copied.unionByName(spread)
    counted = large.select(*(v.alias(c) for c, v in packed.items()), _SALTS)
    counted = counted.groupBy(*df.columns, _SALTS).agg(F.count(F.lit(1)).alias("__n"))
    shares = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / limit))
    shared = counted.withColumn("__share", F.explode(shares)).withColumns(
        {
            _COPIES: F.least(F.lit(limit), F.col("__n") - F.col("__share") * limit).cast("bigint"),
            _SALT: F.pmod(F.xxhash64(*df.columns, "__share"), F.col(_SALTS)).cast("int"),
        }
    )
    restored = [_restored(f.dataType, F.col(f.name)).alias(f.name) for f in df.schema]
    return copied.unionByName(shared.select(*restored, _SALT, _COPIES))


def _groupable(dtype: DataType, value: Column) -> Column | None:
    """The value in a form that Spark can group by and restore exactly, or None if there is no such form.

    Maps become sorted entries. Floating-point numbers become text, as grouping would merge 0.0 and -0.0.
    """
    if isinstance(dtype, (FloatType, DoubleType)):
        return value.cast("string")
    if isinstance(dtype, MapType):
        if _nested(dtype.keyType) or _nested(dtype.valueType):
            return None
        return F.array_sort(F.map_entries(value))
    return None if _nested(dtype) else value


def _nested(dtype: DataType) -> bool:
    """Whether a map or a variant lies anywhere in the type."""
    if isinstance(dtype, StructType):
        return any(_nested(f.dataType) for f in dtype)
    if isinstance(dtype, ArrayType):
        return _nested(dtype.elementType)
    return isinstance(dtype, (MapType, VariantType))


def _restored(dtype: DataType, value: Column) -> Column:
    if isinstance(dtype, MapType):
        return F.map_from_entries(value)
    return value.cast(dtype) if isinstance(dtype, (FloatType, DoubleType)) else value
