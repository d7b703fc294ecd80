"""Quality classification by importance resampling.

Two generative models of hashed n-grams are compared: one of the target text (documents labelled
good and not toxic) and one of the raw text (all labelled documents). The log ratio of both, summed
over a document, is its log weight. Documents are drawn without replacement by weight: a Gumbel number
is added to each log weight, and the k largest of all documents stay (Gumbel top-k). k is the number
of documents above a bound on the log weight that separates labelled good and bad documents best.

* The models count the documents that have an n-gram, so a text that repeats itself counts once. The
  log ratio has additive smoothing and is taken relative to the ratio of the median n-gram, so that the
  length of a text alone says nothing. What is summed is how far it goes beyond ERRORS standard errors, and
  beyond NOISE: an n-gram counts as far as its documents prove a large ratio, with forty labels or many.
* The models are fitted on about MAX_LABELS labelled documents at most, chosen by hash, which bounds
  what is broadcast. The driver gets BUCKETS rows at most. Weights, k and the cut cover
  all documents.
* The k-th largest value is found by counting values in bins and narrowing the bin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.text import LOWER, Words, free_name, mix, slices
from rowsmith.session import scratch_dir

BUCKETS = 1 << 22
SMOOTH = 0.5
ERRORS = 1.5
NOISE = 1.0
MAX_LABELS = 200_000
BINS = 4_096
# Bytes whose n-grams are found at once: the arrays of one slice take some fifty times its size.
SLICE = 1 << 20
# Scale of the Gumbel numbers. At 1 documents are drawn exactly by weight; smaller, closer calls
# than this are left to chance, and no others.
TEMPERATURE = 0.1

# Classes of bytes: 0 letter or not ASCII, 1 capital, 2 digit, 3 punctuation of prose, 4 other mark.
_KIND = np.zeros(256, np.uint8)
_KIND[33:128] = 4
_KIND[65:91] = 1
_KIND[97:123] = 0
_KIND[48:58] = 2
_KIND[[ord(c) for c in ".,;:'\"()-?"]] = 3
_LETTERS = np.where(_KIND >= 3, ord(" "), LOWER).astype(np.uint8)


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Bucket and text number of each hashed n-gram, and the number of texts.

    N-grams are words in lower case without marks, marks that prose has no use for, and pairs of word
    shapes. A shape is the kind of a word's first and last byte, and whether it has several
    capitals; the pair also tells whether both words are equal.
    """
    words, plain = Words(texts, table=_LETTERS), Words(texts)
    kind = _KIND[plain.data]
    at = np.flatnonzero(kind == 4)
    found = [mix(words.hashes() + np.uint64(1)), mix(plain.data[at].astype(np.uint64) + np.uint64(1 << 41))]
    where = [words.row, np.searchsorted(plain.offsets, at, "right") - 1]
    if len(plain) > 1:
        capitals = np.add.reduceat((kind == 1).astype(np.int64), plain.starts) > 1
        shape = (kind[plain.starts].astype(np.uint64) * np.uint64(5) + kind[plain.ends - 1]) * np.uint64(2) + capitals
        value = plain.hashes()
        again = (value[1:] == value[:-1]).astype(np.uint64)
        pair = (shape[1:] * np.uint64(50) + shape[:-1]) * np.uint64(2) + again
        inside = plain.row[1:] == plain.row[:-1]
        found.append(mix(pair[inside] + np.uint64(1 << 40)))
        where.append(plain.row[1:][inside])
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    return (np.concatenate(found) >> shift).astype(np.int64), np.concatenate(where), plain.rows


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents, and how many of the target, have each n-gram."""
    for batch in slices(batches, 0, SLICE):
        bucket, row, _ = ngrams(batch.column(0))
        pair = np.unique(bucket * batch.num_rows + row)
        bucket, row = pair // batch.num_rows, pair % batch.num_rows
        good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)[row]
        if not len(bucket):
            continue
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        target = np.add.reduceat(good.astype(np.int64), at)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[at], pa.int32()), pa.array(np.diff(np.r_[at, len(bucket)])), pa.array(target)],
            names=["bucket", "total", "target"],
        )


def log_ratios(total: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Evidence of each bucket for the target text, from the raw and the target documents that have it."""
    if not target.sum():
        return np.zeros(len(total))
    due = total * (target.sum() / total.sum())
    ratio = np.log((target + SMOOTH) / (due + SMOOTH))
    order = np.argsort(ratio)
    middle = ratio[order[np.searchsorted(np.cumsum(total[order]), total.sum() / 2)]]
    ratio -= middle
    error = np.sqrt(1 / (target + SMOOTH) + 1 / (due + SMOOTH))
    return np.where(total > 0, np.sign(ratio) * np.maximum(np.abs(ratio) - np.maximum(ERRORS * error, NOISE), 0.0), 0.0)


def _scorer(sent) -> Callable[[pa.Array], np.ndarray]:
    def score(texts: pa.Array) -> np.ndarray:
        bucket, row, rows = ngrams(texts)
        return np.bincount(row, sent.value[bucket], minlength=rows)

    return score


def _gumbel(seed: int, id_column: str, text) -> F.Column:
    """A Gumbel number from a hash of seed, id and text, the same whenever the row is computed."""
    share = (F.pmod(F.xxhash64(F.lit(seed), F.col(id_column), text), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(2.0**52)
    return -F.log(-F.log(share))


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The largest cut with at least k values at or above it. Counts, in bins of a narrowing range."""
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k >= n:
        return -np.inf
    if k <= 0:
        return np.inf
    above = 0
    while True:
        width = (high - low) / BINS
        if width <= 0 or low + width <= low:
            return low
        here = values.filter(F.col(column).between(low, high))
        bin_of = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1))
        rows = here.groupBy(bin_of.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for _, count, least, most in sorted(rows.collect(), reverse=True):
            if above + count >= k:
                if least == most or count == 1:
                    return least
                if (least, most) == (low, high):
                    return least
                low, high = least, most
                break
            above += count


def best_bound(good: dict[float, int], bad: dict[float, int]) -> float:
    """The bound with the largest sum of rates of good values at or above and bad values below it."""
    if not good or not bad:
        return -np.inf
    n_good, n_bad = sum(good.values()), sum(bad.values())
    best, bound, lost, caught = 1.0, -np.inf, 0, 0
    points = sorted({*good, *bad})
    for here, following in zip(points, [*points[1:], np.inf], strict=True):
        lost += good.get(here, 0)
        caught += bad.get(here, 0)
        gain = 1 - lost / n_good + caught / n_bad
        if gain > best:
            best, bound = gain, following
    return bound


class Sampler:
    """Fitted models, and the cut that the k-th largest perturbed weight makes."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = 7):
        spark = docs.sparkSession
        self.id, self.text, self.seed = id_column, text, seed
        known = labels.select(
            F.col(id_column).alias("__id"), F.col("quality").cast("int"), F.col("toxic").cast("int")
        ).dropna()
        known = known.groupBy("__id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        known = known.withColumn("__good", (F.col("quality") == 1) & (F.col("toxic") == 0))
        known = known.select("__id", "__good")
        share = (MAX_LABELS << 20) // max(known.count(), 1)
        known = known.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < share)
        rows = docs.select(F.col(id_column).alias("__id"), F.col(text).cast("string").alias("__text"))
        marked = rows.join(F.broadcast(known), "__id")
        counted = (
            marked.select("__text", F.col("__good").alias("target"))
            .mapInArrow(_count, "bucket int, total bigint, target bigint")
            .groupBy("bucket")
            .agg(F.sum("total").alias("total"), F.sum("target").alias("target"))
            .toArrow()
        )
        total, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
        at = counted["bucket"].to_numpy()
        total[at], target[at] = counted["total"].to_numpy(), counted["target"].to_numpy()
        self.sent = spark.sparkContext.broadcast(log_ratios(total, target).astype(np.float32))
        path = scratch_dir(spark, "weights")
        self.weighed(docs).write.parquet(path)
        self.weights = spark.read.parquet(path)
        judged = self.weights.join(F.broadcast(known), F.col(id_column) == F.col("__id"))
        bins = judged.groupBy("__good", F.round("log_weight", 2).alias("at")).count().collect()
        self.bound = best_bound(*({r[1]: r[2] for r in bins if r[0] is good} for good in (True, False)))
        k = self.weights.filter(F.round("log_weight", 2) >= self.bound).count()
        self.cut = float(kth_largest(self.weights, "perturbed", k))

    def weighed(self, docs: DataFrame) -> DataFrame:
        """Id, log weight and perturbed log weight of each document."""
        score = _scorer(self.sent)

        def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 1, SLICE):
                value = score(batch.column(1))
                noise = batch.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(value), pa.array(value + TEMPERATURE * noise)],
                    names=["id", "log_weight", "perturbed"],
                )

        kind = docs.schema[self.id].dataType.simpleString()
        body = F.col(self.text).cast("string")
        rows = docs.select(F.col(self.id).alias("id"), body.alias("text"), _gumbel(self.seed, self.id, body).alias("noise"))
        return rows.mapInArrow(weigh, f"id {kind}, log_weight double, perturbed double").withColumnRenamed("id", self.id)

    def sampled(self, docs: DataFrame) -> DataFrame:
        """The rows of documents that the draw keeps, all columns."""
        score, cut, columns = _scorer(self.sent), self.cut, len(docs.columns)

        def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, columns, SLICE):
                value = score(batch.column(columns)) + TEMPERATURE * batch.column(columns + 1).to_numpy()
                kept = pa.RecordBatch.from_arrays(batch.columns[:columns], schema=pa.schema(list(batch.schema)[:columns]))
                yield kept.filter(pa.array(value >= cut))

        body = F.col(self.text).cast("string")
        noise = _gumbel(self.seed, self.id, body).alias(free_name(docs, "__noise"))
        rows = docs.select("*", body.alias(free_name(docs, "__body")), noise)
        return rows.mapInArrow(keep, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, ``log_weight``, ``perturbed`` and ``kept`` of each document.

    ``labels`` has the id, ``quality`` and ``toxic``; rows with a null are left out, of several rows
    of an id the worst counts. A null or empty text has the log weight 0. Rows tied with the k-th
    are all kept. Without good labels every weight is 0, and without good or without bad ones all
    documents stay. Repeated rows are drawn with the same number. An empty table gives an empty
    result.
    """
    sampler = Sampler(docs, labels, id_column, text)
    return sampler.weights.withColumn("kept", F.col("perturbed") >= F.lit(sampler.cut))


def keep_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the draw keeps, with all their columns; cases as in ``classify``."""
    return Sampler(docs, labels, id_column, text).sampled(docs)
