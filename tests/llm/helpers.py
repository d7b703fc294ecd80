"""Small documents with all that may go wrong, and brute-force versions of the operators."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PROSE = (
    "The river ran low that summer, and the fields along its banks turned yellow before the month was out. "
    "People from the village walked down each evening to carry water home in buckets and jars, talking of rain. "
    "Nobody could remember a drier year, though the oldest of them claimed that it had been worse once."
)
OTHER = (
    "A machine of this size needs two people to run it, one at the front and one who watches the gauges. "
    "When the needle passes the red mark they must close the valve at once and wait until it falls again. "
    "It is dull work, but it pays well, and the men who do it seldom leave for anything else."
)
SCHEMA = "doc_id bigint, text string, id string, h bigint, c int, n int, label string, word string, rest string"


def rows() -> list[tuple]:
    """Nulls, empty texts, ties, repeated rows, long texts, near copies, odd characters."""
    long = " ".join(f"w{(i * i) % 977}x{i % 13}" for i in range(6_000))
    near = PROSE.replace("summer", "winter")
    texts = [
        (1, PROSE),
        (2, PROSE),
        (3, near),
        (4, OTHER),
        (5, None),
        (6, ""),
        (7, " \t\n\x0b\x0c\r "),
        (8, "one two"),
        (9, "ONE two"),
        (10, long),
        (11, long + " tail"),
        (12, "x" * 5_000),
        (13, "éàü ß 漢字 かな 😀😀 ’s it's <|endoftext|> <|end|> \\ \x1c"),
        (14, OTHER + "\n" + PROSE),
        (15, OTHER + "\n" + OTHER),
        (4, OTHER),
        (None, PROSE),
        (None, None),
        (16, "a b c d e " * 40),
    ]
    return [(i, t, "a", 1, 2, 3, None, "w", "r") for i, t in texts]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None) -> frozenset:
    found = words((text or "").translate(LOWER))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def jaccard_components(docs: list[tuple]) -> list[tuple]:
    """(id, set size, smallest linked id) by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [
        (d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))
    ]


def removed(docs: list[tuple], length: int = 100) -> dict:
    """For each (id, text): bytes covered by a string that starts earlier, as a mask."""
    first: dict[bytes, tuple] = {}
    order = sorted({(-math.inf if d is None else d, t or "") for d, t in docs})
    for d, t in order:
        data = t.encode()
        for s in range(len(data) - length + 1):
            key = data[s : s + length]
            first[key] = min(first.get(key, (d, s)), (d, s))
    out = {}
    for d, t in order:
        data = t.encode()
        mask = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if first[data[s : s + length]] < (d, s):
                mask[s : s + length] = b"\1" * length
        out[d, t] = bytes(mask)
    return out


def base_scores(docs: list[tuple]) -> list[tuple]:
    """(id, held out, tokens, known, training tokens, base score) as the contract has them."""
    tokens = [words((t or "").translate(LOWER)) + [None] for _, t in docs]
    fold = [None if d is None else zlib.crc32(str(d).encode()) % 7 for d, _ in docs]
    counts: Counter = Counter()
    for found, f in zip(tokens, fold, strict=True):
        if f is not None and f != 2:
            counts.update(found)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (
            d,
            f == 2,
            len(found),
            sum(counts[w] > 0 for w in found),
            total,
            sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in found),
        )
        for (d, _), found, f in zip(docs, tokens, fold, strict=True)
    ]


def base_rules(text: str | None) -> tuple:
    """Words, their characters, symbols, repeated lines, repeated words, base verdict."""
    found = words(text)
    threes = Counter(zip(found, found[1:], found[2:], strict=False))
    covered = {
        i + k for i in range(len(found) - 2) if threes[tuple(found[i : i + 3])] > 1 for k in range(3)
    }
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n, repeat = len(found), len(covered)
    return (
        n,
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text or ""),
        dup,
        repeat,
        n < 50 or 100 * repeat > 50 * n,
    )
