"""User functions over Arrow batches and groups."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from rowsmith.functions import checks

Batches = Iterator[pa.RecordBatch]
TableFunction = Callable[[pa.Table], pa.Table]

# These functions run on executors, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Partial rows a task holds before it combines them.
COMBINE_ROWS = 65_536
ROWS_KEPT = 262_144


def _joined(tables: Sequence[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables, promote_options="permissive")


def _same_as_last(rows: pa.Table, columns: Sequence[str]) -> pa.ChunkedArray:
    """Which rows agree with the last one, null with null and NaN with NaN."""
    same = pa.chunked_array([pa.repeat(True, rows.num_rows)])
    for c in columns:
        values, last = rows[c], rows[c][-1]
        if not last.is_valid:
            equal = pc.is_null(values)
        elif pa.types.is_floating(values.type) and math.isnan(last.as_py()):
            equal = pc.fill_null(pc.is_nan(values), False)
        else:
            equal = pc.fill_null(pc.equal(values, last), False)
        same = pc.and_(same, equal)
    return same


def resized(batches: Batches, size: int) -> Batches:
    """The same rows in batches of exactly ``size``, but for the last: cut and joined across batch borders."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while rows + batch.num_rows >= size:
            held.append(batch.slice(0, size - rows))
            batch = batch.slice(size - rows)
            yield from _joined([pa.Table.from_batches([b]) for b in held]).combine_chunks().to_batches()
            held, rows = [], 0
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield from _joined([pa.Table.from_batches([b]) for b in held]).combine_chunks().to_batches()


def map_batches(df: DataFrame, fn: TableFunction, schema: StructType | str, batch_size: int | None = None) -> DataFrame:
    """Apply a row-wise function to Arrow batches, without a shuffle.

    A batch is an arbitrary piece of the table, so ``fn`` must not depend on where it is cut. With
    ``batch_size`` it gets exactly so many rows at a time, and what remains in each partition; without it, the
    session's ``spark.sql.execution.arrow.maxRecordsPerBatch`` sets the size for all such functions.
    """
    if batch_size is not None and batch_size < 1:
        raise ValueError(f"batch_size must be at least 1, got {batch_size}")

    def run(batches: Batches) -> Batches:
        for batch in batches if batch_size is None else resized(batches, batch_size):
            yield from fn(pa.Table.from_batches([batch])).to_batches()

    return df.mapInArrow(run, schema)


def _place(values: pa.Array) -> np.ndarray:
    """Dense rank of each value as Spark orders them: nulls first, NaN last."""
    if pa.types.is_floating(values.type):
        numbers = values.to_numpy(zero_copy_only=False)
        place = np.unique(numbers, return_inverse=True)[1] + 1
        return np.where(values.is_null().to_numpy(zero_copy_only=False), 0, place)
    if pa.types.is_boolean(values.type):
        values = values.cast(pa.int8())
    return pc.rank(values, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)


def outermost_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, last: bool = False) -> DataFrame:
    """A table with, of each group, at least its first ``n`` rows (``last``: its last), and few others.

    Every task keeps the outermost ``n`` rows of each group in its part of the table, at most ROWS_KEPT rows at
    a time; what the tasks keep together still has to be ranked. So a later shuffle moves as many rows as tasks
    and groups ask for, whatever ``n`` is. Order columns of types that Arrow does not rank leave the table as it is.
    """
    width = len(by)

    def pruned(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        keys = whole.select([*by, *order])
        try:
            places = [_place(keys.column(i)) for i in range(width, keys.num_columns)]
        except pa.ArrowNotImplementedError:
            return whole
        group = np.zeros(whole.num_rows, np.int64)
        for i in range(width):
            codes = keys.column(i).dictionary_encode("encode").indices.to_numpy()
            group = np.unique(group * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1]
        if last:
            places = [-p for p in places]
        sort = np.lexsort((*reversed(places), group))
        begin = np.flatnonzero(np.r_[True, np.diff(group[sort]) != 0])
        within = np.arange(len(sort)) - np.repeat(begin, np.diff(np.r_[begin, len(sort)]))
        return whole.take(pa.array(np.sort(sort[within < n])))

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_KEPT:
                held = [pruned(held)]
                rows = held[0].num_rows
                if rows > ROWS_KEPT // 2:
                    yield from held
                    held, rows = [], 0
        if held:
            yield pruned(held)

    return df.mapInArrow(run, df.schema)


def map_groups(
    df: DataFrame,
    by: Sequence[str],
    fn: Callable[[Batches], Batches],
    schema: StructType | str,
) -> DataFrame:
    """Apply a function to each group, which it reads batch by batch.

    One task runs a whole group, in bounded memory. Where one key may hold a large share of the
    rows, use ``reduce_groups``.
    """
    checks.require_columns(df, by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)

    return df.groupBy(*by).applyInArrow(run, schema)


def reduce_groups(
    df: DataFrame,
    by: Sequence[str],
    partial: TableFunction,
    combine: TableFunction,
    partial_schema: StructType | str,
    finish: TableFunction,
    schema: StructType | str,
) -> DataFrame:
    """Apply a function to each group in steps, so that no task reads a large group whole.

    All three functions take a table that may hold many keys. Before the shuffle, ``partial``
    reduces a batch to partial rows, which keep the ``by`` columns, and ``combine`` reduces partial
    rows to one per key, so a key sends about one row per input task. After it ``combine`` runs
    again, on the partial rows in key order, and ``finish`` turns one row per key into the result.
    """
    checks.require_columns(df, by)
    keys = list(by)

    def reduce_batches(batches: Batches) -> Batches:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            held.append(partial(pa.Table.from_batches([batch])))
            rows += held[-1].num_rows
            if rows > COMBINE_ROWS:
                merged = combine(_joined(held))
                held, rows = [merged], merged.num_rows
                if rows > COMBINE_ROWS // 2:
                    yield from merged.to_batches()
                    held, rows = [], 0
        if held:
            yield from combine(_joined(held)).to_batches()

    def finish_batches(batches: Batches) -> Batches:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else _joined([held, rows])
            if not rows.num_rows:
                continue
            # The last key may go on in the next batch.
            last = pc.sum(_same_as_last(rows, keys)).as_py()
            done, held = rows.slice(0, rows.num_rows - last), rows.slice(rows.num_rows - last)
            if done.num_rows:
                yield from finish(combine(done)).to_batches()
            if held.num_rows > COMBINE_ROWS:
                held = combine(held)
        if held is not None and held.num_rows:
            yield from finish(combine(held)).to_batches()

    reduced = df.mapInArrow(reduce_batches, partial_schema)
    return reduced.repartition(*by).sortWithinPartitions(*by).mapInArrow(finish_batches, schema)
