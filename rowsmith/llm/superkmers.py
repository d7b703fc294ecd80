"""Removal of repeated word windows, counted in buckets of super-k-mers.

A window is K consecutive words of one document. Its minimiser is the M-word string in it with the
smallest hash (the leftmost of ties), so equal windows have equal minimisers at equal places. Consecutive windows that share
a minimiser overlap almost wholly: they travel as one packed string, a super-k-mer, to the bucket of
their minimiser, where all windows of that minimiser meet, are sorted and compared byte by byte.

* A first pass counts the rows of each minimiser. One that a single row of the corpus has can't repeat,
  so only the others travel; which these are reaches the tasks as a bit set of fixed size.
* Equal super-k-mers of a run of texts are settled there: only those of the smallest id are sent. A
  passage that a third of all documents have is one row for each run of texts.
* A minimiser with very many different surroundings (the edges of a frequent passage) would still put
  them all into one bucket. The windows of such minimisers, at most HOT_KEYS of them, travel singly, by window.
* The rows that a run of texts has for a bucket are compressed together: alone, a string of a hundred bytes hardly
  gets shorter. They are unpacked where they arrive, and sorted there.
* A bucket is read in its sort order, at most ROWS_AT_ONCE rows together. Where one minimiser has more, the first
  windows of each piece are sent on by window and settled in their order, one pass, in bounded memory.

Nothing but the bit set and the hot minimisers passes through the driver. The largest thing a task holds is one text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.suffix_dedup import _pack_texts as pack_texts
from rowsmith.llm.suffix_dedup import _tags as text_tags
from rowsmith.llm.text import Words, bit_set, in_bit_set, mix, raw, slices, split_rows, windows
from rowsmith.session import scratch_dir

K = 13
M = 5
# Minimisers with more rows than this, or than one in HOT_KEYS of all rows, are split by window.
HOT_ROWS = 20_000
HOT_KEYS = 65_536
# Super-k-mers that a task settles together, before and after the shuffle.
HELD = 1 << 17
ROWS_AT_ONCE = 1 << 16
SLICE = 1 << 20
GATHER = 1 << 18

SPANS, STRING, WINDOW = 0, 1, 2
_ROW = "kind int, h bigint, doc bigint, tag bigint, places binary, body binary"
_FAR = 1 << 40
_SCHEMA = pa.schema(
    [("kind", pa.int32()), *((c, pa.int64()) for c in ("h", "doc", "tag")), ("places", pa.binary()), ("body", pa.binary())]
)
# Buckets are as many as shuffle partitions, but this many at least, so that chance deals them evenly.
LEAST_BUCKETS = 256
UNPACKED_BYTES = 4 << 20


class Text:
    """The words of some texts, joined by one space, with the hash of each window."""

    def __init__(self, found: Words):
        self.words = found
        size = found.ends - found.starts
        self.at = np.cumsum(size + 1) - size - 1
        self.size = size
        self.bytes = np.full(int((size + 1).sum()), 32, np.uint8)
        if len(size):
            self.bytes[np.repeat(np.arange(len(size)), size) + np.arange(int(size.sum()))] = found.data[found.solid]

    def end(self, word: np.ndarray) -> np.ndarray:
        """The byte after a word."""
        return self.at[word] + self.size[word]


def _shares(size: np.ndarray) -> Iterator[slice]:
    """Runs of pieces with about GATHER bytes together: the indices of more would take eight times their room."""
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GATHER, "right")))
        yield slice(at, to)
        at = to


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of several pieces, one after the other."""
    out = np.empty(int(size.sum()), np.uint8)
    at = 0
    for part in _shares(size):
        n = size[part]
        ends = np.cumsum(n)
        total = int(ends[-1])
        out[at : at + total] = data[np.repeat(start[part] - ends + n, n) + np.arange(total)]
        at += total
    return out


def same_bytes(data: np.ndarray, one: np.ndarray, two: np.ndarray, one_size: np.ndarray, two_size: np.ndarray) -> np.ndarray:
    """Which pairs of pieces are equal, byte by byte."""
    same = one_size == two_size
    at = np.flatnonzero(same & (one != two) & (one_size > 0))
    for part in _shares(one_size[at]):
        some, size = at[part], one_size[at[part]]
        unlike = gather(data, one[some], size) != gather(data, two[some], size)
        same[some] = ~np.logical_or.reduceat(unlike, np.cumsum(size) - size)
    return same


def binary(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Pieces of bytes as an Arrow array."""
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    flat = gather(data, start, size)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def pieces(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and where each row begins, with the end of the last."""
    _, where, data = column.buffers()
    ends = np.frombuffer(where, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def firsts(key: np.ndarray, doc: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each string (a piece of ``data`` with a hash ``key``) the row of an equal one with the smallest id."""
    n = len(key)
    order = np.lexsort((doc, key))
    new = np.r_[True, key[order][1:] != key[order][:-1]] if n else np.zeros(0, bool)
    lead = np.empty(n, np.int64)
    lead[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if n else order
    unlike = ~same_bytes(data, start, start[lead], size, size[lead])
    if unlike.any():
        # Different strings with one hash: sort these by their bytes.
        known: dict[tuple, int] = {}
        for i in order[np.isin(key[order], key[unlike])].tolist():
            lead[i] = known.setdefault((key[i], data[start[i] : start[i] + size[i]].tobytes()), i)
    return lead


def super_kmers(text: Text, k: int = K, m: int = M):
    """First window, number of windows, minimiser and whole-string hash of each; window hashes, their first words."""
    row, words = text.words.row, text.words.hashes()
    window, first = windows(words, row, k)
    none = np.zeros(0, np.int64)
    if not len(window):
        return none, none, none, none, window, first
    mark = mix(windows(words, np.zeros(len(words), np.int64), m)[0])
    low = (mark & ~np.uint64(0xFFFFFFFF)) | np.arange(len(mark), dtype=np.uint64)
    span, size = k - m + 1, 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(words) - k + 1
    low = np.minimum(low[:n], low[span - size : span - size + n])[first]
    place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.r_[True, (place[1:] != place[:-1]) | (first[1:] != first[:-1] + 1)]
    at = np.flatnonzero(new)
    count = np.diff(np.r_[at, len(place)])
    return at, count, mark[place[at]].view(np.int64), whole(window, at, count), window, first


def whole(window: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash of the words under runs of windows, none longer than one window."""
    with np.errstate(over="ignore"):
        return mix(window[at] + mix(window[at + count - 1] + count.astype(np.uint64))).view(np.int64)


def span_rows(doc: np.ndarray, tag: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Removed words, merged for each document, in rows of kind SPANS."""
    order = np.lexsort((first, tag, doc))
    doc, tag, first, end = doc[order], tag[order], first[order], end[order]
    fresh = np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]
    group = (np.cumsum(fresh) - 1) * _FAR
    reach = np.maximum.accumulate(group + end)
    new = fresh | np.r_[True, (group + first)[1:] > reach[:-1]]
    at = np.flatnonzero(new)
    spans = np.stack([first[at], np.maximum.reduceat(end, at)], axis=1).astype(np.int64)
    where = np.flatnonzero(fresh[at])
    size = 16 * np.diff(np.r_[where, len(at)])
    n = len(where)
    doc = doc[at[where]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, SPANS, np.int32)),
            pa.array(mix(doc.view(np.uint64)).view(np.int64)),
            pa.array(doc),
            pa.array(tag[at[where]]),
            binary(spans.reshape(-1).view(np.uint8), 16 * where, size),
            pa.nulls(n, pa.binary()),
        ],
        names=["kind", "h", "doc", "tag", "places", "body"],
    )


def _string_rows(kind: int, h, doc, tag, places: pa.Array, body: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(h), kind, np.int32)), pa.array(h), pa.array(doc), pa.array(tag), places, body],
        names=["kind", "h", "doc", "tag", "places", "body"],
    )


def _marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many different super-k-mers a run of texts has of each minimiser."""
    for batch in slices(batches, 1, SLICE):
        _, _, mark, body, _, _ = super_kmers(Text(Words(batch.column(1))))
        order = np.lexsort((body, mark))
        mark, body = mark[order], body[order]
        # Equal ones of two documents count as two: they repeat.
        key, at, times = np.unique(mark, return_index=True, return_counts=True)
        new = np.r_[True, (mark[1:] != mark[:-1]) | (body[1:] != body[:-1])].astype(np.int64)
        kinds = np.add.reduceat(new, at) if len(key) else at
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(np.where(times > 1, np.maximum(kinds, 2), 1).astype(np.int64))],
            names=["h", "n"],
        )


def repeats(docs: DataFrame) -> DataFrame:
    """Repeated words (doc, tag, spans: first word and end as 64-bit integers) of documents (doc, text)."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "minimisers")
    counts = docs.mapInArrow(_marks, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    counts.filter("n > 1").write.parquet(path)
    counts = spark.read.schema("h bigint, n bigint").parquet(path)
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("n") > max(HOT_ROWS, total // HOT_KEYS)).select("h").toArrow()
    sent = spark.sparkContext.broadcast((bit_set(counts.select("h")), np.sort(hot["h"].to_numpy())))

    def strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Super-k-mers whose minimiser occurs elsewhere too, and what repeats within a run of texts."""
        shared, hot = sent.value
        held: list[list[np.ndarray]] = []
        rows = 0

        def settle():
            h, body_hash, doc, tag, place, count, size = (np.concatenate(x) for x in list(zip(*held, strict=True))[:7])
            data = np.concatenate([x[7] for x in held])
            start = np.cumsum(size) - size
            lead = firsts(body_hash, doc, data, start, size)
            later = doc > doc[lead]
            if later.any():
                yield span_rows(doc[later], tag[later], place[later], place[later] + count[later] + K - 1)
            at = np.flatnonzero(~later)
            at = at[np.lexsort((place[at], tag[at], lead[at]))]
            new = np.r_[True, (lead[at][1:] != lead[at][:-1]) | (tag[at][1:] != tag[at][:-1])]
            begin = np.flatnonzero(new)
            bytes_ = 8 * np.diff(np.r_[begin, len(at)])
            one = at[begin]
            yield _string_rows(
                STRING, h[one], doc[one], tag[one],
                binary(place[at].view(np.uint8), 8 * begin, bytes_), binary(data, start[one], size[one]),
            )

        for batch in slices(batches, 1, SLICE):
            text = Text(Words(batch.column(1)))
            at, count, mark, body, window, first = super_kmers(text)
            if not len(at):
                continue
            keep = in_bit_set(shared, mark)
            at, count, mark, body = at[keep], count[keep], mark[keep], body[keep]
            split = np.isin(mark, hot)
            if split.any():
                n = count[split]
                base = np.cumsum(n) - n
                single = np.repeat(at[split] - base, n) + np.arange(int(n.sum()))
                ones = np.ones(len(single), np.int64)
                key = mix(window[single] + np.uint64(1)).view(np.int64)
                at, count = np.r_[at[~split], single], np.r_[count[~split], ones]
                mark, body = np.r_[mark[~split], key], np.r_[body[~split], whole(window, single, ones)]
            if not len(at):
                continue
            word = first[at]
            row = text.words.row[word]
            start = text.at[word]
            size = text.end(word + count + K - 2) - start
            doc = batch.column(0).to_numpy()[row]
            before = np.searchsorted(text.words.row, np.arange(text.words.rows))
            tag = text_tags(*raw(batch.column(1)))[row]
            held.append([mark, body, doc, tag, word - before[row], count, size, gather(text.bytes, start, size)])
            rows += len(at)
            if rows >= HELD:
                yield from settle()
                held.clear()
                rows = 0
        if held:
            yield from settle()

    buckets = max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent_rows = docs.mapInArrow(lambda batches: packed_rows(strings(batches), buckets), "bucket int, packed binary")
    strung = sent_rows.repartition("bucket").mapInArrow(unpacked_rows, _ROW).sortWithinPartitions("h")
    path = scratch_dir(spark, "windows")
    strung.mapInArrow(_count, _ROW).write.partitionBy("kind").parquet(path)
    found = spark.read.schema(f"{_ROW.partition(', ')[2]}, kind int").parquet(path)
    left = found.filter(F.col("kind") == WINDOW).selectExpr("kind", *_COLUMNS[1:])
    left = left.repartition("h").sortWithinPartitions("h", "doc").mapInArrow(_settle_windows, _ROW)
    return found.filter(F.col("kind") == SPANS).selectExpr("doc", "tag", "places AS spans").union(
        left.selectExpr("doc", "tag", "places")
    )


_COLUMNS = ["kind", "h", "doc", "tag", "places", "body"]


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def packed_rows(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The rows of each batch by bucket (a remainder of ``h``), each bucket's compressed as one."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = (batch.column(1).to_numpy() & 0xFFFFFFFF) % buckets
        order = np.argsort(bucket, kind="stable")
        bucket, batch = bucket[order], batch.take(pa.array(order))
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        parts = [batch.slice(a, b - a) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(bucket)], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[at].astype(np.int32)),
                pa.array([press.compress(x.cast(_SCHEMA).serialize()) for x in parts], pa.binary()),
            ],
            names=["bucket", "packed"],
        )


def unpacked_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows again, some UNPACKED_BYTES together."""
    import zstandard

    press = zstandard.ZstdDecompressor()
    held, size = [], 0
    for batch in batches:
        for item in batch.column(1):
            held.append(pa.ipc.read_record_batch(pa.py_buffer(press.decompress(item.as_py())), _SCHEMA))
            size += held[-1].nbytes
            if size >= UNPACKED_BYTES:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the windows of a bucket's super-k-mers, sorted by minimiser."""
    held: pa.RecordBatch | None = None
    part = False  # whether the held minimiser began in rows that are settled already
    for batch in batches:
        kind = batch.column(0).to_numpy()
        if (kind == SPANS).any():
            yield batch.filter(pa.array(kind == SPANS))
        batch = batch.filter(pa.array(kind == STRING))
        if not batch.num_rows:
            continue
        held = batch if held is None else _joined([held, batch])
        while held.num_rows:
            h = held.column(1).to_numpy()
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                begun = int(np.searchsorted(h, h[0], "right")) if part else 0
                yield from _compare(held.slice(0, begun), True)
                yield from _compare(held.slice(begun, cut - begun), False)
                held, part = held.slice(cut), False
            elif held.num_rows >= ROWS_AT_ONCE:
                yield from _compare(held, True)
                held, part, last = None, True, h[-1]
                break
            else:
                break
        if held is None:
            continue
    if held is not None and held.num_rows:
        yield from _compare(held, part)


def _compare(block: pa.RecordBatch, incomplete: bool) -> Iterator[pa.RecordBatch]:
    """Words under windows that a smaller id has too; if not all rows are here, also each first window."""
    if not block.num_rows:
        return
    h, doc = block.column(1).to_numpy(), block.column(2).to_numpy()
    if not incomplete:
        # A minimiser of a single document has nothing to compare.
        at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        mixed = np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
        block = block.filter(pa.array(np.repeat(mixed, np.diff(np.r_[at, len(h)]))))
        if not block.num_rows:
            return
    doc, tag = block.column(2).to_numpy(), block.column(3).to_numpy()
    data, offsets = pieces(block.column(5))
    found = Words.__new__(Words)
    found.take(data, offsets)
    window, first = windows(found.hashes(), found.row, K)
    row = found.row[first]
    start, end = found.starts[first], found.ends[first + K - 1]
    lead = firsts(window, doc[row], data, start, end - start)
    later = doc[row] > doc[row[lead]]
    places, bound = pieces(block.column(4))
    places, bound = places.view(np.int64), bound // 8
    begin = np.searchsorted(found.row, np.arange(found.rows))
    at = np.flatnonzero(later)
    if len(at):
        # A super-k-mer that occurs several times in its document has its windows at all these places.
        times = np.diff(bound)[row[at]]
        base = np.cumsum(times) - times
        place = places[np.repeat(bound[row[at]] - base, times) + np.arange(int(times.sum()))]
        word = place + np.repeat(first[at] - begin[row[at]], times)
        yield span_rows(np.repeat(doc[row[at]], times), np.repeat(tag[row[at]], times), word, word + K)
    if incomplete:
        at = np.flatnonzero(~later)
        rows = row[at]
        times = np.diff(bound)[rows]
        base = np.cumsum(times) - times
        word = places[np.repeat(bound[rows] - base, times) + np.arange(int(times.sum()))]
        word = word + np.repeat(first[at] - begin[rows], times)
        yield _string_rows(
            WINDOW, mix(window[at]).view(np.int64), doc[rows], tag[rows],
            binary(word.astype(np.int64).view(np.uint8), 8 * base, 8 * times), binary(data, start[at], (end - start)[at]),
        )


def _settle_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows in order of hash and id: all but those of the first id go. Only first rows are carried on."""
    carried: pa.RecordBatch | None = None
    for batch in batches:
        known = 0
        if carried is not None:
            known = carried.num_rows
            batch = _joined([carried, batch])
        if not batch.num_rows:
            continue
        h, doc, tag = (batch.column(i).to_numpy() for i in (1, 2, 3))
        data, bound = pieces(batch.column(5))
        lead = firsts(h, doc, data, bound[:-1], np.diff(bound))
        at = np.flatnonzero((doc > doc[lead]) & (np.arange(len(h)) >= known))
        if len(at):
            places, ends = pieces(batch.column(4))
            places, ends = places.view(np.int64), ends // 8
            times = np.diff(ends)[at]
            base = np.cumsum(times) - times
            word = places[np.repeat(ends[at] - base, times) + np.arange(int(times.sum()))]
            yield span_rows(np.repeat(doc[at], times), np.repeat(tag[at], times), word, word + K)
        last = np.unique(lead[h == h[-1]])
        carried = batch.take(pa.array(last))


def kept_texts(text: Text, gone: np.ndarray) -> pa.Array:
    """The words of each text that are not gone, joined by one space."""
    rows = text.words.rows
    kept = np.flatnonzero(~gone)
    size = text.size[kept] + 1
    flat = gather(text.bytes, text.at[kept], size)
    total = np.bincount(text.words.row[kept], weights=size, minlength=rows).astype(np.int64)
    # The space after the last word of each text goes.
    solid = np.ones(len(flat), bool)
    solid[np.cumsum(total)[total > 0] - 1] = False
    ends = np.r_[0, np.cumsum(total - (total > 0))].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), rows, [None, pa.py_buffer(ends), pa.py_buffer(flat[solid])])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of texts (id, text, found: spans of removed words)."""
    for batch in batches:
        text = Text(Words(batch.column(1)))
        n, row = text.words.per_row(), text.words.row
        begin = np.cumsum(n) - n
        lists = batch.column(2)
        step = np.zeros(len(text.words) + 1, np.int64)
        for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)).tolist():
            for spans in lists[i].values.to_pylist():
                runs = np.frombuffer(spans, np.int64).reshape(-1, 2) + begin[i]
                np.add.at(step, runs[:, 0], 1)
                np.add.at(step, runs[:, 1], -1)
        gone = np.cumsum(step[:-1]) > 0
        edge = np.flatnonzero(gone & np.r_[True, ~gone[:-1] | (row[1:] != row[:-1])]) if len(gone) else begin[:0]
        stop = np.flatnonzero(gone & np.r_[~gone[1:] | (row[1:] != row[:-1]), True]) + 1 if len(gone) else begin[:0]
        spans = np.stack([edge - begin[row[edge]], stop - begin[row[edge]]], axis=1) if len(edge) else np.zeros((0, 2), np.int64)
        pairs = pa.ListArray.from_arrays(pa.array(np.arange(len(edge) + 1, dtype=np.int32) * 2), pa.array(spans.reshape(-1)))
        per = np.bincount(row[edge], minlength=len(n)) if len(edge) else np.zeros(len(n), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n.astype(np.int64)),
                pa.array(np.bincount(row[gone], minlength=len(n)).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)].astype(np.int32)), pairs),
                kept_texts(text, gone),
            ],
            names=["id", "n_words", "n_removed", "spans", "kept"],
        )


def _cut_plain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1, SLICE):
        none = pa.nulls(batch.num_rows, pa.list_(pa.binary()))
        yield from _cut([pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), none], names=["id", "text", "found"])])


def _cut_packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdDecompressor()
    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows, 64):
            batch = whole_batch.slice(at, 64)
            texts = pa.array([press.decompress(x).decode() for x in batch.column(1).to_pylist()], pa.string())
            part = pa.RecordBatch.from_arrays([batch.column(0), texts, batch.column(2)], names=["id", "text", "found"])
            yield from _cut(slices([part], 1, SLICE))


def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's id with ``n_words``, ``n_removed``, ``spans`` (removed runs of words: first and
    end) and ``kept`` (the other words, joined by one space).

    A word goes if a window of K words that covers it also starts in a document with a smaller id. The
    id must be an integer. A null id comes before all others; rows with equal ids, null ones too, do
    not make each other repeat. Null and empty texts have no words, texts below K words lose none. An
    empty table gives an empty result; other columns are not read, whatever their names.
    """
    doc = F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63)))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = docs.select(doc.alias("doc"), body.alias("text"), F.col(id_column).cast("bigint").alias("id"))
    found = repeats(source.select("doc", "text"))
    spark = docs.sparkSession
    path = scratch_dir(spark, "spans")
    found.write.parquet(path)
    found = spark.read.schema("doc bigint, tag bigint, spans binary").parquet(path)
    whole_texts, touched = split_rows(source, F.xxhash64("doc"), found.select(F.xxhash64("doc")))
    lists = found.groupBy("doc", "tag").agg(F.collect_list("spans").alias("found"))
    packed = touched.select("doc", "text", "id").mapInArrow(pack_texts, "doc bigint, tag bigint, packed binary, id bigint")
    joined = packed.join(lists, ["doc", "tag"], "left").select("id", "packed", "found")
    out = "id bigint, n_words bigint, n_removed bigint, spans array<array<bigint>>, kept string"
    plain = whole_texts.select("id", "text").mapInArrow(_cut_plain, out)
    return plain.unionByName(joined.mapInArrow(_cut_packed, out)).withColumnRenamed("id", id_column)
