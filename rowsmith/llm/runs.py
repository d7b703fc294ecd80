"""Runs (maximal periodic stretches) of words, by Lyndon roots from Baier's grouping.

By the runs theorem every run has a Lyndon root: a longest Lyndon word that starts at some place, under the
order of the words or under its reverse. So all runs of a text follow from two Lyndon arrays:

* ``lyndon`` is the first phase of Baier's suffix sorter. Suffixes are grouped by first word; groups are
  taken from the highest to the lowest; each place of a group points to the nearest earlier place of a
  lower group, and places of one group with equally many pointers move together to a new group right above
  theirs. A group's common prefix is then the longest Lyndon word at its places, so its length is the
  Lyndon array's value. The phase runs once for each order; nothing is sorted further.
* Each root is extended both ways by the longest common extension of its start and its end (``Extension``: ranks
  of all 2**k-word strings, exact). At twice its length or more it is a run.

Only runs of at least SHORTEST words and two periods are wanted. The words of such a run are covered by SEED-word
strings that occur twice in the text, so the sorter gets the stretches that are covered so, one by one; outside of them
there is no such run. A text is handled by one task, in memory that grows with its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.superkmers import Text, firsts, kept_texts
from rowsmith.llm.text import Words, slices, windows

SHORTEST = 12
SEED = 6
SLICE = 2 << 20


def lyndon(symbols: list[int], kinds: int) -> np.ndarray:
    """Length of the longest Lyndon word at each place of symbols 0 to kinds - 1 (a shorter word precedes its extensions)."""
    n = len(symbols)
    group = list(symbols)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    length = [1] * kinds
    below = list(range(-1, kinds - 1))
    top = -2
    above = [*range(1, kinds), top]
    done = bytearray(n)
    before = [0] * n
    out = np.zeros(n, np.int64)
    g = kinds - 1
    while g >= 0:
        places = [i for i in members[g] if group[i] == g]
        members[g] = []
        size = length[g]
        pointed: dict[int, int] = {}
        for i in places:
            done[i] = 1
            p = i - 1
            while p >= 0 and done[p]:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        out[places] = size
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in pointed.items():
            moved.setdefault((times, group[p]), []).append(p)
        # Each new group goes right above the one it leaves, so those with most pointers go first.
        for times, old in sorted(moved, reverse=True):
            new, up = len(members), above[old]
            members.append(moved[times, old])
            length.append(length[old] + times * size)
            below.append(old)
            above.append(up)
            above[old] = new
            if up != top:
                below[up] = new
            for p in members[new]:
                group[p] = new
        g = below[g]
    return out


class Extension:
    """Longest common extensions of places of a word sequence, both ways, from ranks of its 2**k-word strings."""

    def __init__(self, symbols: np.ndarray):
        self.n = n = len(symbols)
        self.ranks = [symbols.astype(np.int64)]
        size = 1
        while 2 * size <= n:
            rank = self.ranks[-1]
            pair = rank[: n - 2 * size + 1] * n + rank[size : n - size + 1]
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
            size *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from i and j (i < j) on."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            at = np.flatnonzero(j + out + (1 << k) <= self.n)
            rank = self.ranks[k]
            out[at[rank[i[at] + out[at]] == rank[j[at] + out[at]]]] += 1 << k
        return out

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words before i and j (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            at = np.flatnonzero(i - out >= 1 << k)
            rank, step = self.ranks[k], 1 << k
            out[at[rank[i[at] - out[at] - step] == rank[j[at] - out[at] - step]]] += step
        return out


def runs(symbols: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """Start, length and period of each run of symbols 0, 1, … with at least ``shortest`` of them, in order of start and period."""
    n = len(symbols)
    if not n:
        return np.zeros((0, 3), np.int64)
    kinds = int(symbols.max()) + 1
    extension = Extension(symbols)
    found = []
    start = np.arange(n)
    for order in (symbols, kinds - 1 - symbols):
        period = lyndon(order.tolist(), kinds)
        ahead, back = extension.ahead(start, start + period), extension.back(start, start + period)
        at = np.flatnonzero((ahead + back >= period) & (ahead + back + period >= shortest))
        found.append(np.stack([start[at] - back[at], period[at], (ahead + back + period)[at]], axis=1))
    return np.unique(np.concatenate(found), axis=0)[:, [0, 2, 1]]


def stretches(found: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of the stretches covered by SEED-word strings that occur twice in their text."""
    window, first = windows(hashes, found.row, SEED)
    none = np.zeros(0, np.int64)
    if not len(window):
        return none, none
    with np.errstate(over="ignore"):
        key = window + found.row[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(key, kind="stable")
    same = np.r_[False, key[order][1:] == key[order][:-1], False]
    at = first[order[same[1:] | same[:-1]]]
    step = np.zeros(len(found) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + SEED, -1)
    covered = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    if not len(covered):
        return none, none
    new = np.r_[True, (covered[1:] != covered[:-1] + 1) | (found.row[covered[1:]] != found.row[covered[:-1]])]
    begin = np.flatnonzero(new)
    return covered[begin], covered[np.r_[begin[1:] - 1, len(covered) - 1]]


def _find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each text, and what is left of it."""
    for batch in slices(batches, 1, SLICE):
        text = Text(Words(batch.column(1)))
        found = text.words
        hashes = found.hashes()
        n = found.per_row()
        begin = np.cumsum(n) - n
        rows, all_runs = [], []
        step = np.zeros(len(found) + 1, np.int64)
        for first, last in zip(*(x.tolist() for x in stretches(found, hashes)), strict=True):
            size = last - first + 1
            if size < SHORTEST:
                continue
            part = slice(first, last + 1)
            lead = firsts(hashes[part], np.arange(size), found.data, found.starts[part], found.ends[part] - found.starts[part])
            mine = runs(np.unique(lead, return_inverse=True)[1])
            mine[:, 0] += first
            np.add.at(step, mine[:, 0] + mine[:, 2], 1)
            np.add.at(step, mine[:, 0] + mine[:, 1], -1)
            all_runs.append(mine)
            rows.append(np.full(len(mine), found.row[first]))
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        mine = np.concatenate(all_runs) if all_runs else np.zeros((0, 3), np.int64)
        ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(n)))].astype(np.int32)
        fields = [pa.array(mine[:, 0] - begin[row]), pa.array(mine[:, 1]), pa.array(mine[:, 2])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
                kept_texts(text, np.cumsum(step[:-1]) > 0),
            ],
            names=["id", "n_words", "runs", "collapsed"],
        )


def find_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's id with ``n_words``, ``runs`` (start, length and period in words, by start and period) and ``collapsed``.

    A run is a maximal stretch of at least SHORTEST words with a smallest period of at most half its
    length; ``collapsed`` has the words that no run contains after its first period, joined by one space.

    Null and empty texts have no words and no runs; ids are passed on, null and repeated ones too, and each
    row stands for itself. An empty table gives an empty result; other columns are not read, whatever their names.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kind = docs.schema[id_column].dataType.simpleString()
    found = docs.select(F.col(id_column).alias("id"), body.alias("text")).mapInArrow(
        _find,
        f"id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string",
    )
    return found.withColumnRenamed("id", id_column)
