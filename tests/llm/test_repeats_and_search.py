"""Runs of words, repeated windows and ranked search against brute force."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOWER, PROSE, WORD, rows, words

import __spark_entry__ as entry
from rowsmith.llm import retrieval, runs, suffix_dedup, superkmers
from rowsmith.llm.text import raw

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def order(found):
    return sorted(found, key=lambda r: tuple((x is not None, x) for x in r))


def pairs():
    return [(d, t) for d, t, *_ in rows()]


def shuffled(n, kinds, seed):
    draw = random.Random(seed)
    return [f"w{draw.randrange(kinds)}" for _ in range(n)]


# Runs


def naive_runs(found, shortest=12):
    out = set()
    n = len(found)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and found[j] == found[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, 2 * q):
                part = found[i : j + q]
                if not any(part[p:] == part[: len(part) - p] for p in range(1, q)):
                    out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def naive_lyndon(s):
    best = []
    for i in range(len(s)):
        sizes = [j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))]
        best.append(max(sizes))
    return best


def test_lyndon_arrays_and_runs_of_short_sequences():
    draw = random.Random(1)
    for _ in range(400):
        kinds = draw.choice((1, 2, 2, 3, 5))
        s = [draw.randrange(kinds) for _ in range(draw.randrange(1, 24))]
        assert runs.lyndon(s, max(s) + 1).tolist() == naive_lyndon(s)
        got = [tuple(r) for r in runs.runs(np.unique(s, return_inverse=True)[1], 2).tolist()]
        assert got == naive_runs(s, 2)


def run_texts():
    a, b = shuffled(40, 30, 1), shuffled(7, 9, 2)
    texts = pairs()
    texts += [
        (20, " ".join(a + b * 3 + a)),
        (21, " ".join(b * 2) + "\n\t " + " ".join(b[:3])),
        (22, " ".join(["x"] * 11)),
        (23, " ".join(["x"] * 12)),
        (24, " ".join((b * 2 + ["y"]) * 3)),
        (25, " ".join(a + a) + "  " + " ".join(a[:1])),
        (26, "é ü " * 900),
    ]
    return [(d, t if len(words(t)) < 3000 else None) for d, t in texts]


def test_runs_equal_brute_force(spark, nothing):
    docs = run_texts()
    got = runs.find_runs(spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, runs int"))
    want = []
    for d, t in docs:
        found = words(t)
        mine = naive_runs(found)
        gone = {i for s, n, q in mine for i in range(s + q, s + n)}
        want.append((d, len(found), mine, " ".join(w for i, w in enumerate(found) if i not in gone)))
    assert order((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()) == order(want)
    assert runs.find_runs(nothing).collect() == []


def test_run_query_repeats_tails_as_its_contract_says(spark, tmp_path):
    draw = random.Random(4)
    docs = [(i, " ".join(shuffled(draw.randrange(0, 90), 40, i))) for i in range(120)]
    docs += [(200 + i, None if i % 3 else " \n") for i in range(30)] + [(None, PROSE), (-5, PROSE), (7, PROSE)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for d, t in docs:
        found = words(t)
        n = len(found)
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            found = [found[i] if i < a else found[a + (i - a) % p] for i in range(n)]
        mine = naive_runs(found)
        best = min(mine, key=lambda r: (-r[1], r[0], r[2])) if mine else None
        gone = {i for s, n, q in mine for i in range(s + q, s + n)}
        left = " ".join(w for i, w in enumerate(found) if i not in gone)
        digests = ("".join(f"{s},{n},{q}\n" for s, n, q in mine), left)
        row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((d, len(mine), *row, *(hashlib.sha256(x.encode()).hexdigest() for x in digests)))
    got = entry.queries()["op11_runs"](spark, str(tmp_path))
    assert order(map(tuple, got.collect())) == order(want)


# Windows


def naive_windows(docs, k=13):
    first = {}
    key = lambda d: -math.inf if d is None else d
    for d, t in docs:
        found = words(t)
        for i in range(len(found) - k + 1):
            run = tuple(found[i : i + k])
            first[run] = min(first.get(run, math.inf), key(d))
    out = []
    for d, t in docs:
        found = words(t)
        gone = set()
        for i in range(len(found) - k + 1):
            if first[tuple(found[i : i + k])] < key(d):
                gone |= set(range(i, i + k))
        spans = []
        for i in sorted(gone):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((d, len(found), len(gone), spans, " ".join(w for i, w in enumerate(found) if i not in gone)))
    return out


def window_texts():
    passage = " ".join(shuffled(30, 500, 5))
    docs = pairs()
    for i in range(60):
        own = shuffled(40, 60, 100 + i)
        docs.append((100 + i, " ".join(own[:20]) + " " + passage + "\n" + " ".join(own[20:])))
    docs += [(200 + i, " ".join(shuffled(50, 2, i // 3))) for i in range(12)]
    docs += [(300, "same " * 300), (299, "same " * 20), (301, "same\tsame " * 40), (301, "same " * 14 + passage)]
    return docs


def removed_words(spark, docs):
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, found string").repartition(5)
    got = superkmers.dedup(frame).collect()
    return order((r.doc_id, r.n_words, r.n_removed, [list(s) for s in r.spans], r.kept) for r in got)


def test_repeated_windows_equal_brute_force(spark, nothing):
    docs = window_texts()
    assert removed_words(spark, docs) == order(naive_windows(docs))
    assert superkmers.dedup(nothing).collect() == []


@pytest.mark.parametrize("limits", [{"HOT_ROWS": 3}, {"ROWS_AT_ONCE": 7, "HELD": 50}, {"HOT_ROWS": 3, "ROWS_AT_ONCE": 5, "HELD": 1}])
def test_split_minimisers_and_full_buckets_change_nothing(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(superkmers, name, value)
    monkeypatch.setattr(superkmers, "SLICE", 3000)
    docs = window_texts()
    assert removed_words(spark, docs) == order(naive_windows(docs))


def test_rows_of_a_bucket_travel_together_and_come_back_whole():
    random.seed(8)
    n = 4_000
    body = [" ".join(random.choices(words(PROSE), k=18)).encode() if i % 9 else None for i in range(n)]
    columns = [
        np.full(n, superkmers.STRING, np.int32), *(np.array([random.getrandbits(62) - 2**61 for _ in range(n)]) for _ in range(3))
    ]
    batch = pa.RecordBatch.from_arrays(
        [*map(pa.array, columns), pa.array([bytes(8 * (i % 4)) for i in range(n)], pa.binary()), pa.array(body, pa.binary())],
        schema=superkmers._SCHEMA,
    )
    sent = list(superkmers.packed_rows([batch.slice(0, 0), batch.slice(0, 3_000), batch.slice(3_000)], 7))
    assert [x.column(0).to_pylist() for x in sent] == [list(range(7))] * 2
    assert sum(x.nbytes for x in sent) < 0.75 * batch.nbytes
    back = pa.Table.from_batches(superkmers.unpacked_rows(sent)).to_pylist()
    assert sorted(back, key=str) == sorted(batch.to_pylist(), key=str)
    assert list(superkmers.unpacked_rows([])) == []


def test_regions_need_little_memory_and_are_found_in_any_pieces(monkeypatch):
    random.seed(9)
    texts = ["", "x" * 99, "y" * 100, *(" ".join(random.choices(words(PROSE), k=k)) for k in (0, 17, 300, 0, 90)), ""]
    data, offsets = raw(pa.array(texts))
    want = [x.tolist() for x in suffix_dedup.regions(data, offsets)]
    covered = np.bincount(want[2], want[4], minlength=len(texts))
    assert covered.tolist() == [max(0, len(t.encode()) - suffix_dedup.LENGTH + 1) for t in texts]
    monkeypatch.setattr(suffix_dedup, "PIECE", 37)
    assert [x.tolist() for x in suffix_dedup.regions(data, offsets)] == want
    monkeypatch.undo()
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([" ".join(random.choices(words(PROSE), k=1500)) for _ in range(400)])], ["doc", "text"])
    tracemalloc.start()
    list(suffix_dedup._suffixes(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 48e6


def test_equal_hashes_of_other_strings_are_told_apart():
    data = np.frombuffer(b"abcabdabcab", np.uint8)
    start, size = np.array([0, 3, 6, 9]), np.array([3, 3, 3, 2])
    lead = superkmers.firsts(np.zeros(4, np.int64), np.array([5, 1, 2, 0]), data, start, size)
    assert lead.tolist() == [2, 1, 2, 3]


# Search


def naive_search(docs, items, k=10):
    counted = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    having = Counter(term for _, c in counted for term in c)
    out = []
    for item, text in set(items):
        scores = []
        for d, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = 0
            for term in set(TERM.findall((text or "").translate(LOWER))):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * having[term] + 1)))
                    score += w * (1_000_000_000 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, -math.inf if d is None else d, d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2])[:k])]
    return out


def search_tables():
    docs = pairs() + [(100 + i, " ".join(shuffled(60, 80, i))) for i in range(300)]
    docs += [(500 + i, docs[30 + i % 4][1]) for i in range(40)] + [(600, "w1-W2_w3\x00É é 漢字")]
    items = [(i, " ".join(shuffled(12, 90, 50 + i // 2))) for i in range(20)]
    items += [(30, PROSE), (30, PROSE), (30, "river"), (31, None), (32, ""), (None, "É w2"), (33, "nowhere at all ... w1"), (34, "!?")]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 2, "CELLS": 4000}, {"ITEMS": 5, "BLOCK": 5}])
def test_search_equals_brute_force(spark, monkeypatch, nothing, limits):
    for name, value in limits.items():
        monkeypatch.setattr(retrieval, name, value)
    docs, items = search_tables()
    table = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id bigint, text string, score int").repartition(3)
    wanted = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, doc string")
    got = retrieval.search(table, wanted)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(map(tuple, got.collect())) == order(naive_search(docs, items))
    assert retrieval.search(nothing, wanted).collect() == []
    assert retrieval.search(table, wanted.limit(0)).collect() == []


def test_blocks_are_skipped_only_below_the_bar():
    draw = np.random.default_rng(3)
    weights = np.sort(draw.integers(1, 9000, 60))[::-1].astype(float)
    hits = np.unique(draw.integers(0, 2000 * 60, 12000))
    row, term = np.divmod(hits, 60)
    impact = draw.integers(1, 10**6, len(hits))
    shard = retrieval.Shard(np.arange(2000), row, term, impact, weights)
    table = np.where(draw.random((60, 8)) < 0.2, weights[:, None], 0)
    best = retrieval.Best(8, 10)
    seen, scored = retrieval.scan(shard, table, best)
    assert 0 < scored < seen
    full = np.zeros((2000, 60))
    full[row, term] = impact
    for item, scores in enumerate((full @ table).T):
        want = np.lexsort((np.arange(2000), -scores))[:10]
        assert best.doc[item].tolist() == want.tolist() and best.score[item].tolist() == scores[want].tolist()
    rows, starts = shard.blocks(59)
    assert len(starts) > 1 and np.array_equal(np.sort(rows), row[term == 59])


def test_words_are_those_of_the_contracts():
    assert WORD.findall("a\x1cb\xa0c \x0bd") == ["a\x1cb\xa0c", "d"]
