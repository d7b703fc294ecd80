"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0). How often a rule votes, and how often it is
right, is estimated for good and for bad texts by expectation-maximisation, from how many documents
show each pattern of votes; no label is needed. A document is kept if its posterior probability of
being good is at least one half and the fixed base rules do not fail it.

Two passes over the texts: the first counts vote patterns (a map-side combined aggregate of at most
3**8 = 6,561 rows, which is what the driver sees at any size), the second applies the posterior of
each pattern. Nothing but patterns is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.text import Words, code_points, mix, slices, windows

# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

# Each rule: (measure, good up to, bad from). Between the bounds the rule abstains.
RULES = (
    ("symbols_per_word", 0.02, 0.10),
    ("repeat_share", 0.15, 0.35),
    ("dup_line_share", 0.10, 0.30),
    ("upper_share", 0.15, 0.40),
    ("shouts_per_word", 0.05, 0.25),
    ("non_letter_share", 0.10, 0.25),
    ("top_word_share", 0.15, 0.30),
    ("word_length_misfit", 0.0, 3.0),
)
# Mean word lengths (code points) in this range fit; outside, the distance to it is the misfit.
WORD_LENGTH = (3.0, 10.0)
# Chances to vote bad, to abstain and to vote good, of a rule that sees a bad and a good text.
START = ((0.40, 0.10, 0.50), (0.02, 0.08, 0.90))
PRIOR_SHARE = 0.05
# The base rules' bound, below which a text is too short for the rates above to mean much.
FEW_WORDS = 50

BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_ASCII_MARK = np.zeros(256, bool)
_IS_ASCII_MARK[[c for c in range(33, 128) if not chr(c).isalpha() and chr(c) not in ".,;:'-"]] = True


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts and the rules' measures of each text."""
    words = Words(texts)
    data, offsets, rows = words.data, words.offsets, words.rows
    hashes = words.hashes()
    n_words = words.per_row()
    salt = mix(np.arange(rows, dtype=np.uint64) + np.uint64(1))

    n_repeat = np.zeros(rows, np.int64)
    value, first = windows(hashes, words.row, 3)
    if len(value):
        _, which, times = np.unique(value ^ salt[words.row[first]], return_inverse=True, return_counts=True)
        covered = np.zeros(len(words), bool)
        hit = first[times[which] > 1]
        for k in range(3):
            covered[hit + k] = True
        n_repeat = np.bincount(words.row[covered], minlength=rows)

    word_times = np.zeros(rows, np.int64)
    if len(words):
        distinct, at, times = np.unique(hashes ^ salt[words.row], return_index=True, return_counts=True)
        np.maximum.at(word_times, words.row[at], times)

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    word_chars = code_points(data, offsets, words.solid)
    n_symbols = count(_IS_SYMBOL[data])
    n_dup, n_lines = _lines(texts)
    upper = count((data >= 65) & (data <= 90))
    letters = upper + count((data >= 97) & (data <= 122))
    some = np.maximum(n_words, 1)
    length = word_chars / some
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "symbols_per_word": n_symbols / some,
        "repeat_share": n_repeat / some,
        "dup_line_share": n_dup / np.maximum(n_lines, 1),
        "upper_share": upper / np.maximum(letters, 1),
        "shouts_per_word": count(data == 33) / some,
        "non_letter_share": count(_IS_ASCII_MARK[data]) / np.maximum(word_chars, 1),
        "top_word_share": word_times / some,
        "word_length_misfit": np.maximum(np.maximum(WORD_LENGTH[0] - length, length - WORD_LENGTH[1]), 0),
    }


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of the text, and lines with a word."""
    n_dup, n_lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts.to_pylist()):
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
        n_lines[i] = len(lines)
        n_dup[i] = len(lines) - len(set(lines))
    return n_dup, n_lines


def base_failed(measures: dict[str, np.ndarray]) -> np.ndarray:
    n = measures["n_words"]
    return (n < FEW_WORDS) | (100 * measures["n_repeat_words"] > 50 * n)


def vote(measures: dict[str, np.ndarray]) -> np.ndarray:
    """The votes of each text, one column for each rule; a text without words gets none."""
    votes = np.zeros((len(measures["n_words"]), len(RULES)), np.int8)
    for k, (name, good, bad) in enumerate(RULES):
        votes[:, k] = (measures[name] <= good).astype(np.int8) - (measures[name] >= bad)
    votes[measures["n_words"] == 0] = 0
    return votes


def pattern(votes: np.ndarray) -> np.ndarray:
    """The votes as one number in base three."""
    return (votes.astype(np.int64) + 1) @ (3 ** np.arange(votes.shape[1]))


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior probability of a good text for each pattern, by expectation-maximisation.

    The model has a share of good texts and, for each rule and class, the chances to vote good, to
    abstain and to vote bad. A rule sees one kind of bad text only, so it starts with START: it
    seldom calls a good text bad, and most bad texts pass it. The start also stays in the model as
    PRIOR_SHARE of the corpus, so that the classes keep their meaning.
    """
    if not len(patterns):
        return np.zeros(0)
    n_rules = len(RULES)
    digits = (patterns[:, None] // 3 ** np.arange(n_rules)) % 3
    hot = np.eye(3)[digits]  # pattern, rule, vote
    weight = counts / counts.sum()
    prior = 0.8
    start = np.repeat(np.array(START)[:, None, :], n_rules, axis=1)
    chance = start
    for _ in range(rounds):
        log = np.einsum("prv,crv->pc", hot, np.log(chance)) + np.log([1 - prior, prior])
        log -= log.max(axis=1, keepdims=True)
        post = np.exp(log)
        post /= post.sum(axis=1, keepdims=True)
        mass = post * weight[:, None]
        prior = float(np.clip(mass[:, 1].sum(), 0.01, 0.99))
        found = np.einsum("pc,prv->crv", mass, hot) + PRIOR_SHARE * start
        chance = found / found.sum(axis=2, keepdims=True)
    return post[:, 1]


def _patterns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, int] = {}
    for batch in slices(batches, 0):
        measures = measure(batch.column(0))
        judged = ~base_failed(measures)
        seen, times = np.unique(pattern(vote(measures))[judged], return_counts=True)
        for k, n in zip(seen.tolist(), times.tolist(), strict=True):
            total[k] = total.get(k, 0) + n
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())],
        names=["pattern", "n"],
    )


def fit_patterns(docs: DataFrame, text: str = "text") -> dict[int, float]:
    """The posterior of every pattern of votes among the documents that pass the base rules."""
    rows = (
        docs.select(F.col(text).cast("string").alias("text"))
        .mapInArrow(_patterns, "pattern bigint, n bigint")
        .groupBy("pattern")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    rows.sort()
    found = fit(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float))
    return dict(zip([r[0] for r in rows], found.tolist(), strict=True))


def quality(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, votes, posterior and verdict of each document.

    Returns the id, the base counts, ``base_failed``, ``votes`` (array, in the order of RULES),
    ``posterior`` and ``kept``. A null or empty text and one of white space has no words: all
    counts are 0, no rule votes, and it is not kept. The posterior is null where the base rules fail. Repeated rows are judged
    each; a null id is returned as it is. An empty table gives an empty result.
    """
    posterior = fit_patterns(docs, text)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            m = measure(batch.column(1))
            votes = vote(m)
            failed = base_failed(m)
            good = np.array([posterior.get(k, 0.0) for k in pattern(votes).tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array(m[c], pa.int64()) for c in [x.split()[0] for x in BASE.split(", ")]]
                + [
                    pa.array(failed),
                    pa.array(votes.tolist(), pa.list_(pa.int8())),
                    pa.array(good, pa.float64(), mask=failed),
                    pa.array(~failed & (good >= 0.5)),
                ],
                names=["id", *[x.split()[0] for x in BASE.split(", ")], "base_failed", "votes", "posterior", "kept"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    found = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        judge, f"id {kind}, {BASE}, base_failed boolean, votes array<tinyint>, posterior double, kept boolean"
    )
    return found.withColumnRenamed("id", id_column)
