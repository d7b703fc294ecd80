"""N-gram Jaccard join of documents, as a blocked sparse product with size bounds.

The rows of the sparse matrix are classes of documents with equal shingle sets, its columns are
shingles. Columns are dealt to tasks in blocks; a block adds the overlaps of its columns
for each pair of rows, and overlaps of a pair are then added over the blocks. A block is the columns with
the same smallest row (those of long columns in parts, by hash): columns with similar rows mostly meet in one
block, so a pair is sent a few times and not once for each of its columns, whatever the number of tasks.

* Size bounds decide which cells take part. For 80 % similarity two sets need an overlap of
  ceil(80 (n + m) / 180), so of a set of n only its first n - ceil(0.8 n) + 1 shingles in one global
  order (the prefix) are needed to find all its partners. Rare shingles come first: a sketch of fixed
  size, added up over all documents, tells about how frequent each is. Any order gives all pairs; this
  one keeps passages that many documents share out of the prefixes.
* Each set has a signature: the parities of its shingles over 512 slots. Slots in which two signatures
  differ are never more than the shingles in which the sets do, so a pair goes at once if they are more
  than its sizes allow. This is a bound, not an estimate: no link is lost.
* After adding, a pair goes if its overlap in the prefixes, plus all that can follow them, is still
  below what its sizes need. The rest is checked on the whole sets.
* Large groups of near copies are linked first, by comparing each member with the nearest of a few
  pivots of each column, chosen by a hash. Then all pairs of different components are multiplied, without exception,
  so no link between components is lost. Links within a component say nothing new and are not made.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.components import components
from rowsmith.llm.text import Words, free_name, mix, slices, split_rows, windows
from rowsmith.session import scratch_dir

WIDTH = 5
SKETCH = 1 << 18
SKETCH_ROWS = 64
# First steps, pivots of a column in them (on average at most twice as many), and how many of them a
# member is compared with at most.
PIVOT_STEPS = 2
PIVOTS = 8
COMPARED = 3
# A column of more rows has its block split in as many parts as it has this many rows.
BLOCK_ROWS = 1 << 13
# Pairs that a task holds at most, and how many different ones of these it sends on.
HELD_PAIRS = 500_000
SENT_PAIRS = 250_000
# Slots of a signature.
SLOTS = 512
SIGNS = [f"s{i}" for i in range(SLOTS // 64)]
# Bits of the filter that keeps the sets of classes without partners from being moved.
FILTER_BITS = 1 << 26


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Shingle hashes and text numbers, and the number of texts. Shingles may repeat."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    value, first = windows(hashes, words.row, WIDTH)
    row = words.row[first]
    n = words.per_row()
    short = np.flatnonzero((n > 0) & (n < WIDTH))
    if len(short):
        at = np.searchsorted(words.row, short)
        whole = mix(n[short].astype(np.uint64))
        for k in range(WIDTH - 1):
            inside = k < n[short]
            whole[inside] = mix(whole[inside] ^ mix(hashes[at[inside] + k] + np.uint64(k)))
        value, row = np.concatenate([value, whole]), np.concatenate([row, short])
    return value, row, words.rows


def distinct(value: np.ndarray, row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, texts in order, shingles by key."""
    order = np.lexsort((key, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], row[new]


def classes(value: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and fingerprint of each text's set."""
    n = np.bincount(row, minlength=rows)
    total = np.zeros(rows, np.uint64)
    if len(value):
        begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        with np.errstate(over="ignore"):
            total[row[begin]] = np.add.reduceat(mix(value + np.uint64(3)), begin)
    return n, mix(total + n.astype(np.uint64)).view(np.int64)


def need(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least overlap of two sets of these sizes with a similarity of 80 %."""
    return -((-80 * (n + m)) // 180)


def kept_out(n: np.ndarray) -> np.ndarray:
    """How many shingles of a set follow its prefix."""
    return -((-8 * n) // 10) - 1


def signatures(value: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Parity of each set's distinct shingles in each slot, as rows of 64-bit numbers."""
    slot = (mix(value + np.uint64(5)) >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)
    times = np.bincount(row * SLOTS + slot, minlength=rows * SLOTS).reshape(rows, SLOTS)
    return np.packbits((times & 1).astype(np.uint8), axis=1).view(np.int64).reshape(rows, SLOTS // 64)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many slots signatures differ. Counted without sign: numpy counts the bits of absolute values."""
    return np.bitwise_count((a ^ b).view(np.uint64)).sum(-1, dtype=np.int64)


def may_link(n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sizes and differing slots let two sets be similar."""
    ok = 10 * np.minimum(n, m) >= 8 * np.maximum(n, m)
    return ok & (differ <= n + m - 2 * need(n, m))


def _first_pass(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, set size, fingerprint and signature of each document; last, the sketch of the task in rows of its own."""
    counts = np.zeros(SKETCH, np.uint64)
    shift = np.uint64(64 - (SKETCH.bit_length() - 1))
    seen: set[int] = set()
    kind = None
    for batch in slices(batches, 1):
        value, row, rows = shingle_sets(batch.column(1))
        value, row = distinct(value, row, value)
        n, print_ = classes(value, row, rows)
        new = np.zeros(rows, bool)
        for i, c in enumerate(print_.tolist()):
            if c not in seen:
                seen.add(c)
                new[i] = True
        counts += np.bincount((value[new[row]] >> shift).astype(np.int64), minlength=SKETCH).astype(np.uint64)
        kind = batch.schema.field(0).type
        none = pa.nulls(rows, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n, pa.int64()),
                pa.array(print_),
                none,
                pa.nulls(rows, pa.binary()),
                *(pa.array(s) for s in signatures(value, row, rows).T),
            ],
            names=["id", "n", "c", "part", "counts", *SIGNS],
        )
    if kind is not None:
        split = counts.reshape(SKETCH_ROWS, -1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(SKETCH_ROWS, kind),
                pa.nulls(SKETCH_ROWS, pa.int64()),
                pa.nulls(SKETCH_ROWS, pa.int64()),
                pa.array(range(SKETCH_ROWS), pa.int32()),
                pa.array([x.tobytes() for x in split], pa.binary()),
                *(pa.nulls(SKETCH_ROWS, pa.int64()) for _ in SIGNS),
            ],
            names=["id", "n", "c", "part", "counts", *SIGNS],
        )


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(v, np.uint64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
        names=["part", "counts"],
    )


def _ranks(sketch: np.ndarray) -> np.ndarray:
    """Frequency of each slot on a logarithmic scale, below 128."""
    return np.minimum(4 * np.log2(np.maximum(sketch.astype(float), 1)), 127).astype(np.uint64)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of batches in which equal values of the first column are together, cut only where it changes."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        columns = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
        if not len(columns[0]):
            continue
        earlier = np.flatnonzero(columns[0] != columns[0][-1])
        cut = int(earlier[-1]) + 1 if len(earlier) else 0
        held = [c[cut:] for c in columns]
        if cut:
            yield tuple(c[:cut] for c in columns)
    if held is not None and len(held[0]):
        yield tuple(held)


def _shared_columns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the columns that several classes have, with the block of the column."""
    for h, c, n in _runs(batches):
        order = np.lexsort((c, h))
        h, c, n = h[order], c[order], n[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])]
        h, c, n = h[new], c[new], n[new]
        more = np.zeros(len(h), bool)
        same = h[1:] == h[:-1]
        more[1:] |= same
        more[:-1] |= same
        if more.any():
            h, c, n = h[more], c[more], n[more]
            begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            length = np.diff(np.r_[begin, len(h)])
            part = mix(h[begin].view(np.uint64)) % (1 + length // BLOCK_ROWS).astype(np.uint64)
            block = mix(mix(c[begin].view(np.uint64)) + part).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(block, length)), pa.array(h), pa.array(c), pa.array(n)], names=["b", "h", "c", "n"]
            )


def _level(c: np.ndarray, seed: int) -> np.ndarray:
    """Trailing zero bits of a hash of the class: half of all classes have one or more, a quarter two …"""
    value = mix(c.view(np.uint64) + np.uint64(seed * 2 + 1)) | np.uint64(1 << 40)
    low = value & (~value + np.uint64(1))
    return np.log2(low.astype(float)).astype(np.int64)


def _multiply(seed: int | None):
    """Overlaps of pairs of classes in different components, added up over a task's columns.

    With a seed, only pairs of a class and its nearest pivot by signature, which comes second; the
    longer a column, the fewer of its classes are pivots.
    """

    def pairs_of(c, n, label, sign):
        """All pairs of one column that may count: positions. In the largest component, none are needed."""
        if seed is None:
            kinds, kind, times = np.unique(label, return_inverse=True, return_counts=True)
            some = np.flatnonzero(kind != times.argmax())
        else:
            level = _level(c, seed)
            some = np.flatnonzero(level >= max(0, int(np.log2(max(1.0, len(c) / PIVOTS)))))
        both = np.zeros(len(c), bool)
        both[some] = True
        step = max(1, (1 << 18) // len(c))
        for at in range(0, len(some), step):
            x = some[at : at + step]
            ok = label[x][:, None] != label[None, :]
            ok &= ~both[None, :] | (x[:, None] < np.arange(len(c))[None, :])
            i, j = np.nonzero(ok)
            i = x[i]
            differ = differing(sign[i], sign[j])
            good = may_link(n[i], n[j], differ)
            i, j, differ = i[good], j[good], differ[good]
            if seed is not None:
                order = np.lexsort((c[i], differ, j))
                i, j = i[order], j[order]
                nearest = np.ones(len(j), bool)
                nearest[1:] = j[1:] != j[:-1]
                i, j = i[nearest], j[nearest]
            yield i, j

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def added() -> list[np.ndarray]:
            """The different ones of the held pairs, with their overlaps added."""
            x, y, nx, ny, o = (np.concatenate(a) for a in zip(*held, strict=True))
            swap = x > y
            if seed is not None:
                of_x, of_y = _level(x, seed), _level(y, seed)
                swap = (of_x > of_y) | ((of_x == of_y) & swap)
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            nx, ny = np.where(swap, ny, nx), np.where(swap, nx, ny)
            order = np.lexsort((y, x))
            x, y, nx, ny, o = x[order], y[order], nx[order], ny[order], o[order]
            at = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            return [x[at], y[at], nx[at], ny[at], np.add.reduceat(o, at)]

        def sent(pairs: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v) for v in pairs], names=["x", "y", "nx", "ny", "o"])

        for h, c, n, label, *signs in _runs(batches):
            sign = np.stack(signs, axis=1)
            begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            length = np.diff(np.r_[begin, len(h)])
            two = begin[length == 2]
            two = two[label[two] != label[two + 1]]
            two = two[may_link(n[two], n[two + 1], differing(sign[two], sign[two + 1]))]
            found = [(two, two + 1)] if len(two) else []
            for a, k in zip(begin[length > 2].tolist(), length[length > 2].tolist(), strict=True):
                for i, j in pairs_of(*(v[a : a + k] for v in (c, n, label, sign))):
                    if len(i):
                        found.append((i + a, j + a))
            for i, j in found:
                held.append([c[i], c[j], n[i], n[j], np.ones(len(i), np.int64)])
                size += len(i)
                if size > HELD_PAIRS:
                    held = [added()]
                    size = len(held[0][0])
                    if size > SENT_PAIRS:
                        yield sent(held[0])
                        held, size = [], 0
        if held:
            yield sent(added())

    return multiply


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        good = np.zeros(len(x), bool)
        sets = batch.column(2), batch.column(3)
        for i in range(len(x)):
            a, b = (np.frombuffer(s[i].as_buffer(), np.uint64) for s in sets)
            both = np.concatenate([a, b])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            good[i] = 100 * common >= 80 * (len(a) + len(b) - common)
        yield pa.RecordBatch.from_arrays([pa.array(x[good]), pa.array(y[good])], names=["a", "b"])


def join_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size, class and component of each document.

    Returns the id, ``n_shingles``, ``class_id`` (fingerprint of the set) and ``component_id`` (the
    smallest id that links reach, itself included). A null text and one without words has an empty
    set, no link, and its own id as component. Repeated rows are documents with equal sets, linked
    with each other. A null id takes part in links and is never the smallest, unless all of a
    component are null. An empty table gives an empty result.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, what: str) -> DataFrame:
        path = scratch_dir(spark, what)
        df.write.parquet(path)
        return spark.read.parquet(path)

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    first = written(
        rows.mapInArrow(
            _first_pass,
            f"id {kind}, n bigint, c bigint, part int, counts binary, " + ", ".join(f"{s} bigint" for s in SIGNS),
        ),
        "sets",
    )
    plain = first.filter("part IS NULL").select("id", "n", "c")
    sums = first.filter("part IS NOT NULL").select("part", "counts").mapInArrow(_add, "part int, counts binary")
    sums = sums.repartition("part").mapInArrow(_add, "part int, counts binary").toArrow().to_pydict()
    sketch = np.zeros((SKETCH_ROWS, SKETCH // SKETCH_ROWS), np.uint64)
    for k, v in zip(sums["part"], sums["counts"], strict=True):
        sketch[k] = np.frombuffer(v, np.uint64)
    rank = spark.sparkContext.broadcast(_ranks(sketch.reshape(-1)))
    shift = np.uint64(64 - (SKETCH.bit_length() - 1))

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of the prefixes of all classes; a task gives each class once."""
        seen: set[int] = set()
        for batch in slices(batches, 0):
            value, row, rows = shingle_sets(batch.column(0))
            key = (rank.value[(value >> shift).astype(np.int64)] << np.uint64(57)) | (value >> np.uint64(7))
            value, row = distinct(value, row, key)
            n, print_ = classes(value, row, rows)
            new = np.zeros(rows, bool)
            for i, c in enumerate(print_.tolist()):
                if c not in seen:
                    seen.add(c)
                    new[i] = True
            place = np.arange(len(row)) - np.searchsorted(row, np.arange(rows))[row]
            cell = (place < n[row] - kept_out(n)[row]) & new[row]
            row = row[cell]
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[cell].view(np.int64)), pa.array(print_[row]), pa.array(n[row].astype(np.int32))],
                names=["h", "c", "n"],
            )

    cells = rows.select("text").mapInArrow(prefixes, "h bigint, c bigint, n int")
    cells = cells.repartition("h").sortWithinPartitions("h").mapInArrow(
        _shared_columns, "b bigint, h bigint, c bigint, n int"
    )
    cells = written(cells, "cells")

    signed = first.filter("n > 0").select("c", *SIGNS).dropDuplicates(["c"])

    high = np.uint64(64 - (FILTER_BITS.bit_length() - 1))

    def sets_of(wanted):
        """Sets of the classes in a bit set of fingerprints; a task gives each class once."""

        def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in slices(batches, 0):
                value, row, rows = shingle_sets(batch.column(0))
                value, row = distinct(value, row, value)
                n, print_ = classes(value, row, rows)
                at = (print_.view(np.uint64) >> high).astype(np.int64)
                hit = ((wanted.value[at >> 6] >> (at & 63)) & 1).astype(bool) & (n > 0)
                ends = np.searchsorted(row, np.arange(rows + 1))
                c_out, s_out = [], []
                for i in np.flatnonzero(hit).tolist():
                    c = int(print_[i])
                    if c not in seen:
                        seen.add(c)
                        c_out.append(c)
                        s_out.append(value[ends[i] : ends[i + 1]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c_out, pa.int64()), pa.array(s_out, pa.binary())], names=["c", "s"]
                )

        return sets

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (x, y) whose sets are similar. Only the sets of their classes are moved."""
        pairs = written(pairs.select("x", "y"), "pairs")
        slots = pairs.select(F.explode(F.array("x", "y")).alias("c")).distinct()
        slots = slots.select(F.shiftrightunsigned("c", 64 - (FILTER_BITS.bit_length() - 1)).alias("slot"))
        words = (
            slots.selectExpr("shiftright(slot, 6) AS word", "shiftleft(1L, cast(slot % 64 AS int)) AS one")
            .groupBy("word")
            .agg(F.bit_or("one").alias("bits"))
            .toArrow()
        )
        bits = np.zeros(FILTER_BITS // 64, np.int64)
        bits[words["word"].to_numpy()] = words["bits"].to_numpy()
        sets = rows.select("text").mapInArrow(sets_of(spark.sparkContext.broadcast(bits)), "c bigint, s binary")
        sets = written(sets.dropDuplicates(["c"]), "members")
        x, y = (sets.select(F.col("c").alias(v), F.col("s").alias(f"s{v}")) for v in "xy")
        both = pairs.join(x, "x").join(y, "y").select("x", "y", "sx", "sy")
        return both.mapInArrow(_verify, "a bigint, b bigint")

    def products(labels: DataFrame | None, seed: int | None) -> DataFrame:
        known = signed
        if labels is not None:
            known = known.join(labels.select(F.col("v").alias("c"), "label"), "c", "left")
            known = known.withColumn("label", F.coalesce("label", "c"))
        else:
            known = known.withColumn("label", F.col("c"))
        cell = cells.join(known, "c").select("b", "h", "c", F.col("n").cast("bigint").alias("n"), "label", *SIGNS)
        blocks = cell.repartition("b").sortWithinPartitions("b", "h").drop("b").mapInArrow(
            _multiply(seed), "x bigint, y bigint, nx bigint, ny bigint, o bigint"
        )
        return blocks.groupBy("x", "y").agg(F.first("nx").alias("nx"), F.first("ny").alias("ny"), F.sum("o").alias("o"))

    rest = F.greatest(F.ceil(F.col("nx") * 8 / 10), F.ceil(F.col("ny") * 8 / 10)) - 1
    enough = (F.col("o") + rest) * 180 >= (F.col("nx") + F.col("ny")) * 80
    by_member = Window.partitionBy("x").orderBy(F.desc("o"), "y")
    links, labels = None, None
    for seed in range(PIVOT_STEPS):
        best = products(labels, seed).filter(enough).withColumn("place", F.row_number().over(by_member))
        found = linked(best.filter(F.col("place") <= COMPARED))
        links = written(found if links is None else links.union(found), "similar")
        labels = components(links)
    labels = components(links.union(linked(products(labels, None).filter(enough))))

    least = plain.filter("n > 0").groupBy("c").agg(F.min("id").alias("least"))
    joined = least.join(labels.withColumnRenamed("v", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    joined = written(joined, "labels")
    smallest = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = joined.join(smallest, "label").select("c", "component_id")
    found = plain.join(of_class, "c", "left")
    return found.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("c")).alias("class_id"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Documents without words, and rows with a null id, all stay. Rows with the same id and text are one
    document, of which one row stays. Other cases as in ``join_documents``.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "joined")
    join_documents(docs, id_column, text).select(id_column, "component_id").write.parquet(path)
    found = spark.read.parquet(path).filter(F.col(id_column).isNotNull())
    key, other = free_name(docs, "__key"), free_name(docs, "__gone")
    gone = found.filter(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias(other)).distinct()
    twice = found.groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(id_column)
    keys = gone.union(twice).select(F.xxhash64(F.col(other)))
    others, concerned = split_rows(docs, F.xxhash64(F.col(id_column)), keys, key)
    concerned = concerned.join(gone, F.col(id_column) == F.col(other), "left_anti").drop(key)
    here = F.col(id_column).isNotNull()
    once = concerned.filter(here).dropDuplicates([id_column, text])
    return others.union(once).union(concerned.filter(~here))
