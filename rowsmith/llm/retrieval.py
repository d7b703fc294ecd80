"""Ranked lexical search: posting lists in geometric blocks with coordinatewise-maximum summaries.

The k best documents of each item by a whole-number form of BM25, exactly.

* A forward table holds, of every document, its length and the counts of those terms that any item has
  (no other term enters a score). It is written once; the statistics (documents, their terms, documents of
  each term) are aggregates over all of it.
* A task reads documents in shards. In a shard, every term's posting list is clustered: documents go to
  the nearest of some documents of the list, by the angle between random projections of their impacts.
  A cluster is a block; its summary is the largest impact that any of its documents has, for each term.
* Terms come in order of falling weight, the same for all items, and a document belongs to the list of the first
  term that it shares with an item. So the bound of a block under an item is its summary times the item's
  weights from this term on. A block is skipped only if that bound is below the item's k-th best score so
  far; all others are scored in full. Bounds and scores are whole numbers below 2**53 and exact as doubles.
* Items come in blocks of at most ITEMS, each a search of all documents. A task gives at most k rows an item.

The index of a shard lives as long as its search: summaries would take more room than the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.superkmers import binary, gather, pieces
from rowsmith.llm.text import Words, slices
from rowsmith.session import scratch_dir

# Items, and bytes of their texts, that are searched together.
ITEMS = 512
ITEM_BYTES = 16 << 20
# About so many documents make a block; a shard has so many cells, documents times terms.
BLOCK = 32
CELLS = 1 << 23
SHARD = 4096
DIRECTIONS = 16

# Bytes outside terms become spaces, A-Z lower case.
TERMS = np.arange(256, dtype=np.uint8)
TERMS[:0x80] = 32
TERMS[0x30:0x3A] = np.arange(0x30, 0x3A)
TERMS[0x41:0x5B] = np.arange(0x61, 0x7B)
TERMS[0x61:0x7B] = np.arange(0x61, 0x7B)


class Vocabulary:
    """The terms of some items, by hash, with their bytes and the items that have them."""

    def __init__(self, texts: pa.Array):
        found = Words(texts, table=TERMS)
        self.hashes, first, where = np.unique(found.hashes(), return_index=True, return_inverse=True)
        self.size = (found.ends - found.starts)[first]
        self.at = np.cumsum(self.size) - self.size
        self.bytes = gather(found.data, found.starts[first], self.size)
        pairs = np.unique(np.stack([where, found.row], axis=1), axis=0) if len(where) else np.zeros((0, 2), np.int64)
        self.term, self.item = pairs[:, 0], pairs[:, 1]


def forward(vocabulary: tuple):
    """Length of each document with a term, and its counts of the vocabulary's terms."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, at, size, letters = vocabulary
        for batch in slices(batches, 1):
            found = Words(batch.column(1), table=TERMS)
            n = found.per_row()
            h = found.hashes()
            term = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
            length = found.ends - found.starts
            hit = np.flatnonzero((hashes[term] == h) & (size[term] == length)) if len(hashes) else np.zeros(0, np.int64)
            term, width = term[hit], length[hit]
            if len(hit):
                unlike = gather(found.data, found.starts[hit], width) != gather(letters, at[term], width)
                good = np.add.reduceat(unlike.astype(np.int64), np.cumsum(width) - width) == 0
                hit, term = hit[good], term[good]
            cell, times = np.unique(found.row[hit] * max(len(hashes), 1) + term, return_counts=True)
            row, term = np.divmod(cell, max(len(hashes), 1))
            keep = np.flatnonzero(n > 0)
            per = 4 * np.bincount(row, minlength=len(n))[keep]
            begin = np.cumsum(per) - per
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep)),
                    pa.array(n[keep].astype(np.int64)),
                    binary(term.astype(np.int32).view(np.uint8), begin, per),
                    binary(times.astype(np.int32).view(np.uint8), begin, per),
                ],
                names=["doc", "n", "terms", "times"],
            )

    return run


def _documents_of(terms: int):
    """In how many documents of a task each term occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(pieces(batch.column(0))[0].view(np.int32), minlength=terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "documents"])

    return run


def weight(documents: int, having: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def impacts(times: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What an occurrence count adds to the score for each unit of weight."""
    if len(n) and 90 * int(n.max()) * documents >= 1 << 63:
        n = n.astype(object)
    m = (10 + 90 * n * documents // terms).astype(np.int64)
    return 1_000_000_000 * times // (1000 * times + 8 * m)


class Shard:
    """Documents of a shard, their impacts by term, and the posting list of each term in blocks."""

    def __init__(self, doc: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray, weights: np.ndarray):
        self.doc = doc
        self.impact = np.zeros((len(doc), len(weights)), np.float32)
        self.impact[row, term] = impact
        self.largest = self.impact.max(axis=0).astype(np.float64)
        order = np.argsort(term, kind="stable")
        self.row = row[order]
        self.bound = np.searchsorted(term[order], np.arange(len(weights) + 1))
        side = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (len(weights), DIRECTIONS))
        place = self.impact @ (side * weights[:, None].astype(np.float32))
        self.place = place / np.maximum(np.linalg.norm(place, axis=1, keepdims=True), 1e-9)

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the term's list, clustered, and where each block begins."""
        rows = self.row[self.bound[term] : self.bound[term + 1]]
        if len(rows) <= BLOCK:
            return rows, np.zeros(min(len(rows), 1), np.int64)
        centres = rows[:: math.ceil(len(rows) / math.ceil(len(rows) / BLOCK))]
        label = np.argmax(self.place[rows] @ self.place[centres].T, axis=1)
        order = np.argsort(label, kind="stable")
        return rows[order], np.flatnonzero(np.r_[True, np.diff(label[order]) != 0])


class Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.score = np.zeros((items, k), np.int64)
        self.doc = np.zeros((items, k), np.int64)

    def bar(self, items: np.ndarray) -> np.ndarray:
        return self.score[items, -1]

    def put(self, item: int, doc: np.ndarray, score: np.ndarray) -> None:
        k = self.score.shape[1]
        keep = (score > 0) & (score >= self.score[item, -1])
        score, doc = np.r_[self.score[item], score[keep]], np.r_[self.doc[item], doc[keep]]
        # Free places have score 0 and stay behind all documents.
        order = np.lexsort((doc, -score))[:k]
        self.score[item], self.doc[item] = score[order], doc[order]


def scan(shard: Shard, table: np.ndarray, best: Best) -> tuple[int, int]:
    """Search a shard for all items (columns of ``table``, weights by term); blocks there were, and scored."""
    seen = scored = 0
    for term in range(len(table)):
        items = np.flatnonzero(table[term])
        if shard.bound[term] == shard.bound[term + 1] or not len(items):
            continue
        # The list's own summary first: if it is too small for all items, no block needs one.
        items = items[shard.largest[term:] @ table[term:, items] >= np.maximum(best.bar(items), 1)]
        if not len(items):
            continue
        rows, starts = shard.blocks(term)
        summary = np.maximum.reduceat(shard.impact[rows, term:], starts, axis=0).astype(np.float64)
        bounds = summary @ table[term:, items]
        sizes = np.diff(np.r_[starts, len(rows)])
        seen += bounds.size
        for j, item in enumerate(items.tolist()):
            live = bounds[:, j] >= max(int(best.score[item, -1]), 1)
            if not live.any():
                continue
            scored += int(live.sum())
            some = rows[np.repeat(live, sizes)]
            own = np.flatnonzero(table[:, item])
            values = shard.impact[np.ix_(some, own)].astype(np.float64)
            fresh = ~(values[:, own < term] > 0).any(axis=1)
            score = (values[fresh] @ table[own, item]).astype(np.int64)
            best.put(item, shard.doc[some[fresh]], score)
    return seen, scored


def _search(rank: np.ndarray, weights: np.ndarray, term: np.ndarray, item: np.ndarray, items: int, k: int, size: tuple):
    """Best documents of each item among those of a task."""
    documents, terms = size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(weights), items))
        table[rank[term], item] = weights[rank[term]]
        best = Best(items, k)
        step = max(64, min(SHARD, CELLS // max(len(weights), 1)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                found, ends = pieces(part.column(2))
                times, _ = pieces(part.column(3))
                row = np.repeat(np.arange(part.num_rows), np.diff(ends) // 4)
                n = part.column(1).to_numpy()[row]
                value = impacts(times.view(np.int32).astype(np.int64), n, documents, terms)
                shard = Shard(part.column(0).to_numpy(), row, rank[found.view(np.int32)], value, weights)
                scan(shard, table, best)
        item_, place = np.nonzero(best.score)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item_.astype(np.int32)),
                pa.array(best.doc[item_, place]),
                pa.array(best.score[item_, place]),
            ],
            names=["item", "doc", "score"],
        )

    return run


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """The ``k`` best documents (id, ``rank`` from 1, ``score``) of each item, equal scores by ascending id.

    Terms are maximal runs of ASCII letters, digits and all characters beyond ASCII; only A-Z are
    lower-cased. A document's score adds, over the distinct terms of the item, weight times
    ``1000000000 * tf div (1000 * tf + 8 * m)``; see ``weight`` and ``impacts``. Documents that score 0 are not ranked.

    Null and empty texts have no terms: such documents count nowhere, such items find nothing. Each row of
    documents counts for itself, repeated ones too; a null id comes before all others. Item rows with equal id and
    text are one item; those with equal ids and other texts are ranked each for itself. Ids of documents must be
    integers. Empty tables give an empty result; other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    doc = F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63)))
    source = docs.select(doc.alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    wanted = items.select(F.col(item_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    wanted = wanted.distinct()
    count, bytes_ = wanted.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, math.ceil(count / ITEMS), math.ceil((bytes_ or 0) / ITEM_BYTES))
    kind = wanted.schema["id"].dataType
    out = None
    for block in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).toArrow().combine_chunks()
        found = _search_block(source, part, k).withColumn("block", F.lit(block))
        ids = pa.table({"item": pa.array(np.arange(part.num_rows, dtype=np.int32)), item_column: part["id"]})
        ids = spark.createDataFrame(ids).select("item", F.col(item_column).cast(kind))
        found = found.join(F.broadcast(ids), "item").select(
            item_column,
            "rank",
            F.when(F.col("doc") != -(1 << 63), F.col("doc")).alias(id_column),
            "score",
        )
        out = found if out is None else out.unionByName(found)
    return out


def _search_block(source: DataFrame, part: pa.Table, k: int) -> DataFrame:
    """Search for at most ITEMS items (id, text), numbered from 0."""
    spark = source.sparkSession
    texts = part["text"].combine_chunks() if part.num_rows else pa.array([], pa.string())
    known = Vocabulary(texts.cast(pa.string()))
    path = scratch_dir(spark, "forward")
    columns = "doc bigint, n bigint, terms binary, times binary"
    made = source.mapInArrow(forward((known.hashes, known.at, known.size, known.bytes)), columns)
    made.write.parquet(path)
    table = spark.read.schema(columns).parquet(path)
    documents, terms = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    having = np.zeros(len(known.hashes), np.int64)
    counts = table.select("terms").mapInArrow(_documents_of(len(having)), "term bigint, documents bigint")
    counts = counts.groupBy("term").agg(F.sum("documents").alias("documents")).toArrow()
    having[counts["term"].to_numpy()] = counts["documents"].to_numpy()
    weights = np.array([weight(documents, h) if h else 0 for h in having.tolist()], np.int64)
    order = np.lexsort((np.arange(len(weights)), -weights))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    run = _search(rank, weights[order].astype(np.float64), known.term, known.item, part.num_rows, k, (documents, terms or 1))
    found = table.mapInArrow(run, "item int, doc bigint, score bigint")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
