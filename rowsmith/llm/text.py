"""Words of Arrow string arrays as numpy arrays, and what several operators share."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A task handles so many bytes of text at once; a single longer text is one slice of its own.
SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
FILTER_BITS = 1 << 26

# The white space between words, x20 and x09 to x0D.
SPACES = b" \t\n\x0b\x0c\r"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MIX_A = np.uint64(0x9E3779B97F4A7C15)
_MIX_B = np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0x5851F42D4C957F2D


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, … modulo 2**64."""
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out, dtype=np.uint64)


# Bytes that are hashed at once; powers of the base, and of its inverse.
_PIECE = 1 << 15
_UP, _DOWN = powers(_BASE, _PIECE), powers(pow(_BASE, -1, 1 << 64), _PIECE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX_A
        x = (x ^ (x >> np.uint64(27))) * _MIX_B
        return x ^ (x >> np.uint64(31))


def small_batches(df: DataFrame) -> DataFrame:
    """Let Arrow batches of this session hold at most BATCH_BYTES, unless it has a bound of its own."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(bound, None) is None:
        df.sparkSession.conf.set(bound, str(BATCH_BYTES))
    return df


def slices(
    batches: Iterable[pa.RecordBatch], column: str | int, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with at most ``size`` bytes of text, one row at least.

    At the end of a task's input, memory that allocators hold for later goes back: workers are kept.
    """
    for batch in batches:
        ends = raw(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + size, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
    if not isinstance(batches, list):
        release_memory()


def release_memory() -> None:
    """Give unused memory of Arrow's pool and of the C library's heap back to the system, where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each text begins, with the end of the last. Nulls are empty."""
    if texts.null_count or texts.type != pa.string():
        texts = texts.cast(pa.string()).fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts: first byte, end and text number of each.

    ``table`` replaces each byte first.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, table: np.ndarray | None = None):
        data, offsets = raw(texts)
        table = LOWER if lower else table
        self.take(data if table is None else table[data], offsets)

    def take(self, data: np.ndarray, offsets: np.ndarray) -> None:
        """Find the words of bytes that hold texts one after the other."""
        self.data, self.offsets = data, offsets
        self.solid = ~IS_SPACE[self.data]
        n = len(data)
        begins = np.zeros(n + 1, bool)
        begins[self.offsets] = True
        first, last = self.solid.copy(), self.solid.copy()
        first[1:] &= ~self.solid[:-1] | begins[1:n]
        last[:-1] &= ~self.solid[1:] | begins[1:n]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.rows = len(self.offsets) - 1
        self.row = np.repeat(np.arange(self.rows), np.diff(np.searchsorted(self.starts, self.offsets)))

    def __len__(self) -> int:
        return len(self.starts)

    def per_row(self) -> np.ndarray:
        """Number of words of each text."""
        return np.bincount(self.row, minlength=self.rows)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, the same in every task."""
        if not len(self):
            return np.zeros(0, np.uint64)
        length = self.ends - self.starts
        stop = np.cumsum(length)
        at, solid, out = stop - length, self.data[self.solid], np.empty(len(self), np.uint64)
        i = 0
        with np.errstate(over="ignore"):
            while i < len(self):
                # Powers run through a piece of several words; each word's are brought down to its first byte.
                to = max(i + 1, int(np.searchsorted(stop, at[i] + _PIECE, "right")))
                piece = solid[at[i] : stop[to - 1]].astype(np.uint64)
                piece += np.uint64(1)
                piece *= _UP[: len(piece)] if len(piece) <= _PIECE else powers(_BASE, len(piece))
                begin = at[i:to] - at[i]
                out[i:to] = np.add.reduceat(piece, begin) * _DOWN[begin]
                i = to
            return mix(out + length.astype(np.uint64))

    def word(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()


def windows(hashes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words within one text, and the number of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(row[:n] == row[width - 1 :])
    factor = powers(0xD6E8FEB86659FD93, width + 1)[1:]
    with np.errstate(over="ignore"):
        value = np.zeros(n, np.uint64)
        for i in range(width):
            value += hashes[i : i + n] * factor[i]
    return mix(value)[first], first


def code_points(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    """Code points of each text, or of its bytes that are kept."""
    lead = (data & 0xC0) != 0x80
    if keep is not None:
        lead &= keep
    total = np.concatenate([[0], np.cumsum(lead)])
    return total[offsets[1:]] - total[offsets[:-1]]


def bit_set(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for the highest bits of each 64-bit hash in the first column: a fixed size for any number."""
    shift = 64 - (bits.bit_length() - 1)
    words = (
        hashes.toDF("h")
        .selectExpr(f"shiftrightunsigned(h, {shift}) AS slot")
        .selectExpr("shiftright(slot, 6) AS word", "shiftleft(1L, cast(slot % 64 AS int)) AS one")
        .groupBy("word")
        .agg(F.bit_or("one").alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    if words.num_rows:
        out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def in_bit_set(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (int64) may be in the set."""
    shift = np.uint64(64 - ((len(found) * 64).bit_length() - 1))
    slot = (hashes.view(np.uint64) >> shift).astype(np.int64)
    return ((found[slot >> 6] >> (slot & 63)) & 1).astype(bool)


def free_name(docs: DataFrame, name: str) -> str:
    """The name, with as many underscores as it takes to differ from all columns, in any letter case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def split_rows(docs: DataFrame, key, hashes: DataFrame, name: str = "__key") -> tuple[DataFrame, DataFrame]:
    """Rows whose key (a 64-bit hash column) is surely not among the hashes, and the others, with the key as ``name``.

    So a join with the hashes has to move only the few rows that it may concern.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bit_set(hashes))
    n = len(docs.columns)
    keyed = docs.withColumn(name, key)

    def part(wanted: bool):
        def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = in_bit_set(sent.value, batch.column(n).to_numpy())
                yield batch.filter(pa.array(hit if wanted else ~hit))

        return take

    return (
        keyed.mapInArrow(part(False), keyed.schema).drop(name),
        keyed.mapInArrow(part(True), keyed.schema),
    )


def remainder(column: str, modulus: int):
    """crc32 of a column as text, modulo a number; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def parts(df: DataFrame, column: str, bytes_each: int) -> int:
    """How many parts of about ``bytes_each`` bytes a text column makes, one at least (one job)."""
    total = df.agg(F.sum(F.octet_length(F.col(column)) + F.lit(64))).first()[0]
    return max(1, math.ceil((total or 0) / bytes_each))
