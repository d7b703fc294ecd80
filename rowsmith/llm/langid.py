"""Language of a text by unigram pieces, summed over all segmentations.

Every language has its own probabilities of the pieces of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces (forward algorithm), so no segmentation
has to be chosen. The text's language is the one under which its words are most probable, and the
score is that language's share among all languages (equal priors).

Learning is one pass: starting from piece weights that depend on length only, each task runs the
forward-backward algorithm over its distinct words and adds up the expected uses of each piece for
each language. What is shuffled is at most one row for each task, language and piece, and the driver
sees (languages x vocabulary) rows, whatever the input. Prediction is a second pass without a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.text import Words, mix, remainder, slices

# Words whose probabilities a task remembers.
KNOWN_WORDS = 500_000
# Words segmented at once.
WORDS_AT_ONCE = 16_384
# Characters of so many words, if the longest has more than a few.
CELLS = 1 << 20
# Every RESCALE positions, probabilities below SMALL are scaled up.
RESCALE = 8
SMALL = 1e-100
UNKNOWN_CHAR = 1e-7
UND = "und"

_BASE = 0x2545F4914F6CDD1D


def vocabulary_pieces(model_path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model, lower case, in order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    found = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            found.setdefault(model.id_to_piece(i).lower())
    return [p for p in found if p]


class Pieces:
    """Numbers of pieces, and which strings begin one, by a rolling hash and an open-addressed table."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        self.lengths = np.array([len(p) for p in pieces])
        self.longest = max(map(len, pieces), default=1)
        known: dict[int, int] = {}
        for i, piece in enumerate(pieces):
            value = 0
            for c in piece:
                value = (value * _BASE + ord(c) + 1) % (1 << 64)
                known.setdefault(value, self.n)  # n: only the beginning of a piece
            known[value] = i
        keys = np.array(list(known), np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(known)) * 4))))
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.ids = np.full(1 << bits, -1, np.int32)
        self.reach = 1
        slots = (mix(keys) >> self.shift).astype(np.int64)
        for i, key, slot in zip(known.values(), keys, slots.tolist(), strict=True):
            step = 1
            while self.ids[slot] >= 0:
                slot, step = (slot + 1) % len(self.ids), step + 1
            self.keys[slot], self.ids[slot] = key, i
            self.reach = max(self.reach, step)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece's number, n for what only begins one, -1 for anything else."""
        slot = (mix(keys) >> self.shift).astype(np.int64)
        found = np.where((self.ids[slot] >= 0) & (self.keys[slot] == keys), self.ids[slot], -1)
        for _ in range(self.reach - 1):
            if not ((found < 0) & (self.ids[slot] >= 0)).any():
                break
            slot = (slot + 1) % len(self.ids)
            found = np.where((found < 0) & (self.keys[slot] == keys), self.ids[slot], found)
        return found

    def lattice(self, words: list[str]) -> tuple[list[list[tuple[int, np.ndarray, np.ndarray]]], np.ndarray]:
        """For each end position, (length, words, pieces) of all pieces ending there; lengths of the words.

        The words must be sorted by length, longest first, so that those which reach a position come
        first.
        """
        length = np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        chars += np.uint64(1)
        begin = np.cumsum(length) - length
        word = np.repeat(np.arange(len(words)), length)
        within = np.arange(len(chars)) - begin[word]
        left = length[word] - within
        edges: list = [[] for _ in range(int(length.max()))]
        at, keys = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        for size in range(1, self.longest + 1):
            if size > 1:  # only what is the beginning of a longer piece goes on
                go = (ids >= 0) & (left[at] >= size)
                at, keys = at[go], keys[go]
            if not len(at):
                break
            with np.errstate(over="ignore"):
                keys = keys * np.uint64(_BASE) + chars[at + size - 1]
            ids = self.find(keys)
            here = np.arange(len(at)) if size == 1 else np.flatnonzero((ids >= 0) & (ids < self.n))
            found = np.where(ids[here] < 0, self.n, ids[here])
            end = within[at[here]] + size
            order = np.argsort(end.astype(np.uint16) if len(edges) < 65536 else end, kind="stable")
            where, found, end = word[at[here[order]]], found[order], end[order]
            cuts = np.flatnonzero(np.r_[True, end[1:] != end[:-1]]) if len(end) else np.zeros(0, np.int64)
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(end)], strict=True) if len(cuts) else ():
                edges[end[a] - 1].append((size, where[a:b], found[a:b]))
        return edges, length


def forward(edges: list, length: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Summed probability of all segmentations up to each position: position, word, model. For short words."""
    alpha = np.zeros((len(edges) + 1, len(length), chance.shape[1]))
    alpha[0] = 1.0
    for t, here in enumerate(edges, 1):
        for size, at, ids in here:
            alpha[t, at] += alpha[t - size, at] * chance[ids]
    return alpha


def log_totals(edges: list, length: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all segmentations of each word, of any length: word, model.

    Only the positions that the longest piece spans are kept; they are scaled up together where the
    probabilities become small.
    """
    n, models = len(length), chance.shape[1]
    span = 1 + max(size for here in edges for size, _, _ in here)
    alpha = np.zeros((span, n, models))
    alpha[0] = 1.0
    scale, out = np.zeros((n, models)), np.zeros((n, models))
    for t, here in enumerate(edges, 1):
        now, alive = alpha[t % span], len(here[0][1])
        now[:alive] = 0.0
        for size, at, ids in here:
            now[at] += alpha[(t - size) % span, at] * chance[ids]
        if t % RESCALE == 0:
            low = np.flatnonzero((now[:alive] < SMALL).any(axis=1))
            if len(low):
                top = now[low]
                scale[low] += np.log(top)
                alpha[:, low] /= top
        after = len(edges[t][0][1]) if t < len(edges) else 0
        if after < alive:
            out[after:alive] = np.log(now[after:alive]) + scale[after:alive]
    return out


def expected(edges: list, length: np.ndarray, chance: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, for each column of ``counts`` (uses of the words), under one model.

    Forward and backward sums are kept as logs, so words may have any length.
    """
    logs = np.log(chance)
    n = len(length)
    alpha = np.full((len(edges) + 1, n), -np.inf)
    alpha[0] = 0.0
    for t, here in enumerate(edges, 1):
        for size, at, ids in here:
            alpha[t, at] = np.logaddexp(alpha[t, at], alpha[t - size, at] + logs[ids])
    beta = np.full((len(edges) + 1, n), -np.inf)
    beta[length, np.arange(n)] = -alpha[length, np.arange(n)]
    words, pieces, flows = [], [], []
    for t in range(len(edges), 0, -1):
        for size, at, ids in edges[t - 1]:
            flow = beta[t, at] + logs[ids]
            beta[t - size, at] = np.logaddexp(beta[t - size, at], flow)
            words.append(at)
            pieces.append(ids)
            flows.append(flow + alpha[t - size, at])
    word, piece, flow = np.concatenate(words), np.concatenate(pieces), np.exp(np.concatenate(flows))
    out = np.zeros((len(chance), counts.shape[1]))
    for k in range(counts.shape[1]):
        out[:, k] = np.bincount(piece, flow * counts[word, k], minlength=len(chance))
    return out


def start_weights(lengths: np.ndarray) -> np.ndarray:
    """Piece weights before learning: by length only, longer pieces more than their parts' product."""
    weight = np.append(0.02 ** (0.5 + 0.5 * lengths), UNKNOWN_CHAR)
    return weight


def marked(word: str) -> str:
    """A word as it is segmented: marked at its start, lower case."""
    return "▁" + word.lower()


_LOADED: dict[str, Pieces] = {}


def pieces_of(model_path: str) -> Pieces:
    if model_path not in _LOADED:
        _LOADED[model_path] = Pieces(vocabulary_pieces(model_path))
    return _LOADED[model_path]


def has_letter(text: str | None) -> bool:
    """Whether a character of general category L occurs."""
    return any(unicodedata.category(c)[0] == "L" for c in text or "")


def _distinct(words: Words, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of words, the first word with each, and each word's number among them."""
    return np.unique(keys, return_index=True, return_inverse=True)


def _by_length(runs: list[str]) -> Iterator[np.ndarray]:
    """Numbers of the words, longest first, in parts of WORDS_AT_ONCE words or, if long, CELLS characters."""
    order = np.argsort([-len(r) for r in runs], kind="stable")
    i = 0
    while i < len(order):
        n = min(WORDS_AT_ONCE, max(1, CELLS // len(runs[order[i]])))
        yield order[i : i + n]
        i += n


def learn(train: DataFrame, model_path: str) -> tuple[list[str], np.ndarray]:
    """Languages and, for each piece and the unknown character, its probability in each of them.

    ``train`` has columns text and lang.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_path)
        start = start_weights(pieces.lengths)
        total: dict[str, np.ndarray] = {}
        for batch in slices(batches, 0):
            words = Words(batch.column(0), lower=True)
            if not len(words):
                continue
            codes = batch.column(1).dictionary_encode()
            langs = codes.dictionary.to_pylist()
            lang = codes.indices.to_numpy(zero_copy_only=False)[words.row]
            _, first, which = _distinct(words, words.hashes())
            uses = np.zeros((len(first), len(langs)))
            np.add.at(uses, (which, lang), 1)
            runs = [marked(words.word(i)) for i in first.tolist()]
            for at in _by_length(runs):
                edges, length = pieces.lattice([runs[i] for i in at.tolist()])
                found = expected(edges, length, start, uses[at])
                for k, name in enumerate(langs):
                    total[name] = total.get(name, 0) + found[:, k]
        for name, values in total.items():
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(values[at])],
                names=["lang", "piece", "uses"],
            )

    rows = (
        train.select("text", "lang")
        .mapInArrow(count, "lang string, piece int, uses double")
        .groupBy("lang", "piece")
        .agg(F.sum("uses").alias("uses"))
        .collect()
    )
    langs = sorted({r[0] for r in rows})
    n = len(vocabulary_pieces(model_path)) + 1
    uses = np.full((n, len(langs)), 0.1)
    for lang, piece, value in rows:
        uses[piece, langs.index(lang)] += value
    if langs:
        least = UNKNOWN_CHAR * uses[:-1].sum(axis=0)  # one rate for all languages
        uses = np.maximum(uses, least)
        uses[n - 1] = least
        uses = uses / uses.sum(axis=0)
    return langs, uses


def identify(
    docs: DataFrame,
    model_path: str,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 4,
    held: int = 2,
) -> DataFrame:
    """Predicted language of each document, learnt from the documents outside the held-out fold.

    The fold is crc32 of the id as text, modulo ``folds``. Returns the id, ``held_out``,
    ``lang_pred`` and ``score`` (0 to 1). A null text and one without a letter gets ``und`` and
    score 0, and so does every text if there is nothing to learn from. A null id is in no fold: it
    is not held out and not learnt from. Rows with a null language are not learnt from. Repeated
    rows count as often as they occur. Of equally probable languages the first in sorted order wins.
    """
    fold = remainder(id_column, folds)
    train = docs.filter((fold != held) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )
    langs, chance = learn(train, model_path)
    sent = docs.sparkSession.sparkContext.broadcast(chance)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_path) if langs else None
        chance = sent.value
        known = np.zeros(0, np.uint64)
        logs = np.zeros((0, len(langs)))
        for batch in slices(batches, 2):
            texts = batch.column(2)
            words = Words(texts, lower=True)
            total = np.zeros((words.rows, len(langs)))
            if langs and len(words):
                keys, first, which = _distinct(words, words.hashes())
                at = np.searchsorted(known, keys)
                at[at == len(known)] = 0
                new = known[at] != keys if len(known) else np.ones(len(keys), bool)
                value = np.zeros((len(keys), len(langs)))
                if len(known):
                    value[~new] = logs[at[~new]]
                owner = np.flatnonzero(new)
                runs = [marked(words.word(i)) for i in first[owner].tolist()]
                for some in _by_length(runs):
                    edges, length = pieces.lattice([runs[i] for i in some.tolist()])
                    value[owner[some]] = log_totals(edges, length, chance)
                for k in range(len(langs)):
                    total[:, k] = np.bincount(words.row, value[which, k], minlength=words.rows)
                if len(known) + int(new.sum()) > KNOWN_WORDS:
                    known, logs = keys, value
                else:
                    known = np.concatenate([known, keys[new]])
                    logs = np.concatenate([logs, value[new]])
                    order = np.argsort(known)
                    known, logs = known[order], logs[order]
            letter = np.array([has_letter(t) for t in texts.to_pylist()], bool)
            if langs:
                best = total.argmax(axis=1)
                share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                names = [langs[b] if ok else UND for b, ok in zip(best.tolist(), letter.tolist(), strict=True)]
            else:
                share, names = np.zeros(len(letter)), [UND] * len(letter)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(np.where(letter, share, 0.0))],
                names=["id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    found = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(fold == held, F.lit(False)).alias("held_out"),
        F.col(text).cast("string").alias("text"),
    ).mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double")
    return found.withColumnRenamed("id", id_column)
