"""Removal of repeated byte strings, with a logarithmic family of sparse suffix arrays.

Every byte that a LENGTH-byte string covers which also starts earlier goes. Of the suffixes that
start in a text only some are kept, chosen by content: each window of LENGTH bytes is owned by the
K-byte string with the smallest hash in it, so equal windows have equal owners at equal places. About
one suffix in 35 stays, with the run of windows it owns (its region). A suffix array here is a table
of such suffixes sorted by the hashes of owner and region, each region with its first place.

* Documents come in BATCHES, ranges of ids in order. A batch's suffix array is merge-scanned with the
  rows of the existing levels that share an owner with it: a region that is in a level, or earlier in
  the batch, repeats whole. New regions become a level, and levels of equal size merge into one of
  twice the size, so there are at most log2(BATCHES) + 1 levels.
* Owners with several regions mark where long matches may end inside a region. Only these regions
  are then compared window by window, with their bytes, in a last scan over the documents.
* Repeats within one task are settled there, so a region that a third of all documents have is sent
  once by each task. Owners with more than HOT regions are split by region, and the windows left by
  each split are compared by window hash.
* What is gathered for the driver are bit sets of fixed size (FILTER_BITS): hashes that may matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.text import mix, raw, slices
from rowsmith.session import scratch_dir

LENGTH = 100
K = 32
BATCHES = 4
HOT = 100_000
SALTS = 64
FILTER_BITS = 1 << 26
# Samples that a task settles among each other at once.
SAMPLES_AT_ONCE = 1 << 18
SUSPECTS_AT_ONCE = 1 << 16
# Bytes handled at once: arrays of eight bytes for each stay within a processor's cache, or nearly so.
SLICE = 1 << 18
PIECE = 1 << 15

_BASE = 0x9E3779B97F4A7C55
_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(99))
_SPAN = LENGTH - K + 1
_ROW = "kind int, h bigint, r bigint, doc bigint, pos bigint, tag bigint, spans binary"
REGION, SPANS, SHARED = 0, 1, 2


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_BASE, k, 1 << 64))


def _hashes(data: np.ndarray, sizes: Iterable[int]) -> list[np.ndarray]:
    """Hashes of all runs of each size (up to 127), computed for PIECE bytes at a time."""
    sizes = list(sizes)
    out = [np.zeros(max(0, len(data) - size + 1), np.uint64) for size in sizes]
    for at in range(0, max(map(len, out)), PIECE):
        for all_, some in zip(out, _piece_hashes(data[at : at + PIECE + max(sizes) - 1], sizes), strict=True):
            n = min(PIECE, len(all_) - at)
            if n > 0:
                all_[at : at + n] = some[:n]
    return out


def _piece_hashes(data: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Those of a piece, put together from the hashes of powers of two."""
    double = {1: _BYTES[data]}
    k = 1
    with np.errstate(over="ignore"):
        while 2 * k <= max(sizes):
            h = double[k]
            double[2 * k] = h[:-k] * _power(k) + h[k:] if len(h) > k else h[:0]
            k *= 2
        out = []
        for size in sizes:
            n = max(0, len(data) - size + 1)
            total, at = np.zeros(n, np.uint64), 0
            for k in sorted(double, reverse=True):
                if size & k:
                    total = total * _power(k) + double[k][at : at + n]
                    at += k
            out.append(total)
    return out


def regions(data: np.ndarray, offsets: np.ndarray):
    """Owner hash, region hash, text number, first byte in the text and number of windows of each region."""
    owner, window = _hashes(data, (K, LENGTH))
    n = len(window)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    owner = mix(owner)
    key = (owner & ~np.uint64(0xFFFFFFFF)) | np.arange(len(owner), dtype=np.uint64)
    low, size = key, 1
    while 2 * size <= _SPAN:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[_SPAN - size : _SPAN - size + n])
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # A window starts at each byte of a text but the last LENGTH - 1.
    fits = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    inside = np.arange(int(fits.sum())) + np.repeat(offsets[:-1] - (np.cumsum(fits) - fits), fits)
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    place = place[inside]
    new = np.r_[True, (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1)]
    at = np.flatnonzero(new)
    first, count = inside[at], np.diff(np.r_[at, len(inside)])
    row = np.searchsorted(offsets, first, "right") - 1
    last = first + count - 1
    shape = (count * 256 + (place[at] - first)).astype(np.uint64)
    with np.errstate(over="ignore"):
        region = mix(window[first] + mix(window[last] + shape))
    short = (mix(owner[place[at]]) >> np.uint64(24)).view(np.int64)  # owners have small hashes: spread them
    return short, region.view(np.int64), row, first - offsets[row], count


def pack(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Start and windows in one number, ordered by start."""
    return (first << 7) | count


def _tags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each text; with the id it tells repeated ids apart."""
    import xxhash

    flat = data.tobytes()
    ends = offsets.tolist()
    return np.array(
        [xxhash.xxh3_64_intdigest(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], np.uint64
    ).view(np.int64)


def _span_rows(doc: np.ndarray, pos: np.ndarray, tag: np.ndarray) -> pa.RecordBatch:
    """The removed bytes of repeated runs of windows, merged for each document."""
    first, count = pos >> 7, pos & 127
    order = np.lexsort((first, tag, doc))
    doc, tag, first = doc[order], tag[order], first[order]
    end = first + count[order] + LENGTH - 1
    new = np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]
    begin = np.flatnonzero(new)
    spans = np.stack([first, end], axis=1).astype(np.int64)
    out = [
        merged(spans[a:b]).tobytes() for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(doc)], strict=True)
    ]
    n = len(begin)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, SPANS, np.int32)),
            pa.array(mix(doc[begin].view(np.uint64)).view(np.int64)),
            pa.nulls(n, pa.int64()),
            pa.array(doc[begin]),
            pa.nulls(n, pa.int64()),
            pa.array(tag[begin]),
            pa.array(out, pa.binary()),
        ],
        names=["kind", "h", "r", "doc", "pos", "tag", "spans"],
    )


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of spans (first, end), sorted, touching ones joined."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], np.maximum.reduceat(spans[:, 1], at)], axis=1)


def _rows(kind: int, h, r, doc, pos, tag) -> pa.RecordBatch:
    n = len(h)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), *(pa.array(x) for x in (h, r, doc, pos, tag)), pa.nulls(n, pa.binary())],
        names=["kind", "h", "r", "doc", "pos", "tag", "spans"],
    )


def _firsts(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of key and place, and which of them are at the first place of their key."""
    order = np.lexsort((tag, pos, doc, key))
    k, d, p = key[order], doc[order], pos[order]
    new = np.r_[True, k[1:] != k[:-1]]
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    return order, (d == d[lead]) & (p == p[lead])


def _suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions of a batch, each once for a run of texts, and what repeats within the run."""
    held, size = [], 0

    def settle():
        h, r, doc, pos, tag = (np.concatenate(x) for x in zip(*held, strict=True))
        order, first = _firsts(r, doc, pos, tag)
        lead = order[first]
        lead = lead[np.r_[True, r[lead][1:] != r[lead][:-1]]] if len(lead) else lead
        yield _rows(REGION, h[lead], r[lead], doc[lead], pos[lead], tag[lead])
        rest = order[~first]
        if len(rest):
            yield _span_rows(doc[rest], pos[rest], tag[rest])

    for batch in slices(batches, 1, SLICE):
        data, offsets = raw(batch.column(1))
        h, r, row, first, count = regions(data, offsets)
        if len(h):
            doc = batch.column(0).to_numpy()
            held.append([h, r, doc[row], pack(first, count), _tags(data, offsets)[row]])
            size += len(h)
        if size >= SAMPLES_AT_ONCE:
            yield from settle()
            held.clear()
            size = 0
    if held:
        yield from settle()


def _blocks(batches: Iterable[pa.RecordBatch], kinds: bool) -> Iterator[pa.RecordBatch]:
    """Batches sorted by h, cut only where h changes."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        h = batch.column(1 if kinds else 0).to_numpy()
        if not len(h):
            continue
        cut = int(np.searchsorted(h, h[-1]))
        held = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut)
    if held is not None and held.num_rows:
        yield held


def _scan(keep_regions: bool):
    """Merge-scan of a batch's rows (kind REGION) with those of levels (kind REGION, known)."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, True):
            kind = block.column(0).to_numpy()
            done = np.flatnonzero(kind == SPANS)
            if len(done):
                yield block.take(pa.array(done)).select(["kind", "h", "r", "doc", "pos", "tag", "spans"])
            at = np.flatnonzero(kind == REGION)
            if not len(at):
                continue
            h, r, doc, pos, tag = (block.column(i).to_numpy(zero_copy_only=False)[at] for i in (1, 2, 3, 4, 5))
            r, pos = r.astype(np.int64), pos.astype(np.int64)
            known = block.column(7).to_numpy(zero_copy_only=False)[at]
            order, first = _firsts(r, doc, pos, tag)
            again = order[~first & ~known[order]]
            if len(again):
                yield _span_rows(doc[again], pos[again], tag[again])
            lead = order[first]
            lead = lead[np.r_[True, r[lead][1:] != r[lead][:-1]]]
            if keep_regions:
                new = lead[~known[lead]]
                yield _rows(REGION, h[new], r[new], doc[new], pos[new], tag[new])
            owners, where, times = np.unique(h[lead], return_inverse=True, return_counts=True)
            fresh = np.bincount(where, ~known[lead], minlength=len(owners)) > 0
            shared = np.flatnonzero((times > 1) & fresh)
            n = len(shared)
            if n:
                none = np.zeros(n, np.int64)
                yield _rows(SHARED, owners[shared], times[shared].astype(np.int64), none, none, none)

    return scan


def bit_set(values: DataFrame) -> np.ndarray:
    """A bit for each hash of a column ``h`` (40 bits), in FILTER_BITS bits."""
    drop = 40 - (FILTER_BITS.bit_length() - 1)
    words = (
        values.selectExpr(f"shiftright(h, {drop + 6}) AS word", f"shiftleft(1L, cast(shiftright(h, {drop}) % 64 AS int)) AS one")
        .groupBy("word")
        .agg(F.bit_or("one").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    if words.num_rows:
        bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bits


def _in(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h >> (40 - (FILTER_BITS.bit_length() - 1))
    return ((bits[slot >> 6] >> (slot & 63)) & 1).astype(bool)


def _delete(spark, path: str) -> None:
    """Remove a level that was merged into a larger one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Family:
    """Levels of sorted suffix tables; sizes double."""

    def __init__(self, spark):
        self.spark = spark
        self.levels: list[tuple[int, str]] = []  # batches in the level, path of its regions
        self.found: list[str] = []

    def add(self, docs: DataFrame, last: bool) -> None:
        """Scan a batch (doc, text) against all levels, then make it a level."""
        spark = self.spark
        fresh, written = docs.mapInArrow(_suffixes, _ROW), None
        if self.levels:
            # Read twice: once for the owners that concern the levels, once for the scan.
            written = scratch_dir(spark, "batch")
            fresh.write.parquet(written)
            fresh = spark.read.schema(_ROW).parquet(written)
            sent = spark.sparkContext.broadcast(bit_set(fresh.filter(F.col("kind") == REGION).select("h")))
        fresh = fresh.withColumn("known", F.lit(False))
        if self.levels:

            def touched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield batch.filter(pa.array(_in(sent.value, batch.column(1).to_numpy())))

            for _, path in self.levels:
                level = spark.read.schema("h bigint, r bigint, doc bigint, pos bigint, tag bigint").parquet(path)
                level = level.selectExpr("0 AS kind", "h", "r", "doc", "pos", "tag", "cast(null AS binary) AS spans", "true AS known")
                fresh = fresh.unionByName(level.mapInArrow(touched, _ROW + ", known boolean"))
        scanned = fresh.repartition("h").sortWithinPartitions("h").mapInArrow(_scan(not last), _ROW)
        path = scratch_dir(spark, "suffixes")
        scanned.write.partitionBy("kind").parquet(path)
        self.found.append(path)
        if written:
            _delete(spark, written)
        if last:
            return
        self.levels.append((1, f"{path}/kind={REGION}"))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, one), (_, two) = self.levels[-2:]
            schema = "h bigint, r bigint, doc bigint, pos bigint, tag bigint"
            both = spark.read.schema(schema).parquet(one).unionByName(spark.read.schema(schema).parquet(two))
            path = scratch_dir(spark, "level")
            both.repartition("h").sortWithinPartitions("h", "r").write.parquet(path)
            self.levels[-2:] = [(2 * n, path)]
            _delete(spark, one)
            _delete(spark, two)

    def rows(self, kind: int) -> DataFrame:
        schema = "h bigint, r bigint, doc bigint, pos bigint, tag bigint, spans binary, kind int"
        out = None
        for path in self.found:
            part = self.spark.read.schema(schema).parquet(path).filter(F.col("kind") == kind)
            out = part if out is None else out.unionByName(part)
        return out


def repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Repeated spans (columns doc, tag, spans) of documents (doc bigint, text string)."""
    spark = docs.sparkSession
    shares = [i / batches for i in range(1, batches)]
    points = sorted(set(docs.approxQuantile("doc", shares, 0.01))) if shares else []
    family = Family(spark)
    edges = [None, *[int(p) for p in points], None]
    for k in range(len(edges) - 1):
        part = docs
        if edges[k] is not None:
            part = part.filter(F.col("doc") > edges[k])
        if edges[k + 1] is not None:
            part = part.filter(F.col("doc") <= edges[k + 1])
        family.add(part, k == len(edges) - 2)
    shared = family.rows(SHARED)
    marks = spark.sparkContext.broadcast(bit_set(shared))
    hot = spark.sparkContext.broadcast(bit_set(shared.filter(F.col("r") > HOT)))

    def suspects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Regions of shared owners with their bytes, each once for a run of texts."""
        held, size = [], 0

        def settle():
            h, r, doc, pos, tag, bodies = (np.concatenate(x) for x in zip(*held, strict=True))
            order, first = _firsts(r, doc, pos, tag)
            at = order[first]
            at = at[np.r_[True, r[at][1:] != r[at][:-1]]]
            salt = np.where(_in(hot.value, h[at]), r[at] % SALTS + 1, 0)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(h[at] ^ (salt << 40)),
                    pa.array(salt > 0),
                    pa.array(doc[at]),
                    pa.array(pos[at]),
                    pa.array(tag[at]),
                    pa.array(bodies[at].tolist(), pa.binary()),
                ],
                names=["h", "split", "doc", "pos", "tag", "body"],
            )

        for batch in slices(batches, 1, SLICE):
            data, offsets = raw(batch.column(1))
            h, r, row, first, count = regions(data, offsets)
            at = np.flatnonzero(_in(marks.value, h)) if len(h) else np.zeros(0, np.int64)
            if not len(at):
                continue
            pos, tag = pack(first[at], count[at]), _tags(data, offsets)[row[at]]
            start = offsets[row[at]] + first[at]
            flat = data.tobytes()
            bodies = np.empty(len(at), object)
            ends = start + count[at] + LENGTH - 1
            bodies[:] = [flat[a:b] for a, b in zip(start.tolist(), ends.tolist(), strict=True)]
            held.append([h[at], r[at], batch.column(0).to_numpy()[row[at]], pos, tag, bodies])
            size += len(at)
            if size >= SUSPECTS_AT_ONCE:
                yield settle()
                held.clear()
                size = 0
        if held:
            yield settle()

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, False):
            bodies = block.column(5)
            _, where, flat = bodies.buffers()
            bound = np.frombuffer(where, np.int32)[bodies.offset : bodies.offset + len(bodies) + 1].astype(np.int64)
            data = np.frombuffer(flat, np.uint8)[bound[0] : bound[-1]]
            (window,) = _hashes(data, (LENGTH,))
            doc, pos, tag = (block.column(i).to_numpy() for i in (2, 3, 4))
            count = pos & 127
            base = np.cumsum(count) - count
            step = np.arange(int(count.sum())) - np.repeat(base, count)
            key = window[np.repeat(bound[:-1] - bound[0], count) + step].view(np.int64)
            split = np.repeat(block.column(1).to_numpy(zero_copy_only=False), count)
            doc, tag = np.repeat(doc, count), np.repeat(tag, count)
            pos = pack(np.repeat(pos >> 7, count) + step, np.ones(len(step), np.int64))
            order, first = _firsts(key, doc, pos, tag)
            again = order[~first]
            if len(again):
                yield _span_rows(doc[again], pos[again], tag[again])
            left = order[first]
            left = left[split[left]]
            if len(left):
                yield _rows(REGION, key[left], key[left], doc[left], pos[left], tag[left])

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, False):
            key, doc, pos, tag = (block.column(i).to_numpy() for i in range(4))
            order, first = _firsts(key, doc, pos, tag)
            again = order[~first]
            if len(again):
                yield _span_rows(doc[again], pos[again], tag[again])

    found = docs.mapInArrow(suspects, "h bigint, split boolean, doc bigint, pos bigint, tag bigint, body binary")
    found = found.repartition("h").sortWithinPartitions("h").mapInArrow(compare, _ROW)
    path = scratch_dir(spark, "compared")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    left = found.filter(F.col("kind") == REGION).select("h", "doc", "pos", "tag")
    left = left.repartition("h").sortWithinPartitions("h").mapInArrow(finish, _ROW)
    columns = ["doc", "tag", "spans"]
    return (
        family.rows(SPANS).select(*columns).union(found.filter(F.col("kind") == SPANS).select(*columns)).union(left.select(*columns))
    )


def _pack_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, 1, SLICE):
        data, offsets = raw(batch.column(1))
        flat = data.tobytes()
        packed = [press.compress(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(_tags(data, offsets)), pa.array(packed, pa.binary()), *batch.columns[2:]],
            names=["doc", "tag", "packed", *batch.schema.names[2:]],
        )


def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """Each document's id with ``n_bytes``, ``n_removed``, ``spans`` (removed runs: first byte and
    end) and ``kept`` (the other bytes, binary).

    The id must be an integer. Earlier means a smaller id, or the same row and an earlier start. A
    null id comes before all others. Rows with the same id are not earlier than each other at equal
    starts; of other starts the smaller is earlier. Null and empty texts have no bytes, and texts
    below LENGTH bytes lose none. An empty table gives an empty result.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    doc = F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63)))
    found = repeats(docs.select(doc.alias("doc"), body.alias("text")), batches)
    found = found.groupBy("doc", "tag").agg(F.collect_list("spans").alias("found"))
    packed = docs.select(doc.alias("doc"), body.alias("text"), F.col(id_column).cast("bigint").alias("id")).mapInArrow(
        _pack_texts, "doc bigint, tag bigint, packed binary, id bigint"
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sizes, removed, spans, kept = [], [], [], []
                for item, lists in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    data = press.decompress(item)
                    runs = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in lists or ()]
                    runs = merged(np.concatenate(runs)) if runs else np.zeros((0, 2), np.int64)
                    out, last = [], 0
                    for first, end in runs.tolist():
                        out.append(data[last:first])
                        last = end
                    out.append(data[last:])
                    sizes.append(len(data))
                    removed.append(int((runs[:, 1] - runs[:, 0]).sum()))
                    spans.append(runs.tolist())
                    kept.append(b"".join(out))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["id", "n_bytes", "n_removed", "spans", "kept"],
                )

    joined = packed.join(found, ["doc", "tag"], "left").select("id", "packed", "found")
    result = joined.mapInArrow(
        cut, "id bigint, n_bytes bigint, n_removed bigint, spans array<array<bigint>>, kept binary"
    )
    return result.withColumnRenamed("id", id_column)


def strip(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents without repeated bytes in their texts, with all their columns.

    Every row stays, with the text that is left; characters of which bytes were removed go whole.
    ``length`` names the column with the number of characters, if there is one. Null texts stay null.
    Other cases as in ``dedup``.
    """
    rest = F.struct(*(F.col(c) for c in docs.columns if c != text))
    doc = F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63)))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = repeats(docs.select(doc.alias("doc"), body.alias("text")))
    found = found.groupBy("doc", "tag").agg(F.collect_list("spans").alias("found"))
    rows = docs.select(doc.alias("doc"), body.alias("text"), F.col(text).isNull().alias("none"), rest.alias("rest"))
    kind = rows.schema["rest"].dataType.simpleString()
    packed = rows.mapInArrow(_pack_texts, f"doc bigint, tag bigint, packed binary, none boolean, rest {kind}")
    joined = packed.join(found, ["doc", "tag"], "left").select("packed", "found", "none", "rest")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdDecompressor()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = []
                columns = (batch.column(i).to_pylist() for i in range(3))
                for item, lists, none in zip(*columns, strict=True):
                    data = press.decompress(item)
                    runs = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in lists or ()]
                    out, last = [], 0
                    for first, end in merged(np.concatenate(runs)).tolist() if runs else ():
                        out.append(data[last:first].decode(errors="ignore"))
                        last = end
                    out.append(data[last:].decode(errors="ignore"))
                    texts.append(None if none else "".join(out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()), batch.column(3)], names=["text", "rest"]
                )

    made = joined.mapInArrow(cut, f"text string, rest {kind}")
    size = F.char_length("text").cast(docs.schema[length].dataType) if length in docs.columns else None
    return made.select(
        *(
            F.col("text").alias(c)
            if c == text
            else F.coalesce(size, F.col("rest")[c]).alias(c)
            if c == length
            else F.col("rest")[c].alias(c)
            for c in docs.columns
        )
    )
