"""Parquet sinks. Every executor writes its own part files; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rowsmith.functions import checks

MODES = ("overwrite", "errorifexists", "ignore")


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "snappy",
    rows_per_file: int | None = None,
    rows_per_group: int | None = None,
) -> str:
    """Write a Parquet table, at most ``rows_per_file`` rows a file and ``rows_per_group`` a row group.

    ``mode`` says what happens to an existing one: replaced (``overwrite``), refused
    (``errorifexists``), or left as it is without writing (``ignore``).
    """
    _check(path, mode)
    writer = df.write.mode(mode).option("compression", compression)
    for name, rows in (("maxRecordsPerFile", rows_per_file), ("parquet.block.row.count.limit", rows_per_group)):
        if rows is not None:
            if rows < 1:
                raise ValueError(f"rows per file or group must be at least 1, got {rows}")
            writer = writer.option(name, rows)
    writer.parquet(path)
    return path


def write_counted(df: DataFrame, path: str, mode: str = "overwrite", **options: Any) -> int:
    """``write_parquet``, and how many rows it wrote: a metric of the write itself, without another scan."""
    if mode == "ignore":
        raise ValueError("mode ignore may write nothing, so there is nothing to count")
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode, **options)
    return seen.get["rows"]


def write_zstd(
    df: DataFrame, path: str, rows_per_file: int | None = None, mode: str = "overwrite", rows_per_group: int | None = None
) -> str:
    """Write zstd Parquet in files of at most ``rows_per_file`` rows, in row groups of ``rows_per_group``."""
    return write_parquet(df, path, mode, "zstd", rows_per_file, rows_per_group)


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", compression: str = "zstd"
) -> str:
    """Write one folder per value of ``by``.

    The rebalancing shuffle gathers each value's rows into few files, and adaptive execution splits
    a value that outgrows a task's share, so a frequent value is written by many tasks.
    """
    checks.require_columns(df, by)
    _check(path, mode)
    gathered = df.hint("rebalance", *(F.col(c) for c in by))
    gathered.write.mode(mode).partitionBy(*by).option("compression", compression).parquet(path)
    return path


def write_parts(
    df: DataFrame,
    path: str,
    parts: int,
    mode: str = "overwrite",
    compression: str = "zstd",
    rows_per_file: int | None = None,
    rows_per_group: int | None = None,
) -> str:
    """Write ``parts`` files of nearly equal size."""
    if parts < 1:
        raise ValueError(f"parts must be at least 1, got {parts}")
    return write_parquet(df.repartition(parts), path, mode, compression, rows_per_file, rows_per_group)


def _check(path: str, mode: str) -> None:
    checks.require_suffix(path, [".parquet"])
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, got {mode!r}")
