"""Near copies, repeats and benchmark items."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from helpers import OTHER, PROSE, jaccard_components, removed, rows

from rowsmith.llm import decontam, jaccard, suffix_dedup
from rowsmith.llm.components import components


def order(found):
    return sorted(found, key=lambda r: tuple((x is not None, x) for x in r))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.v: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)}


@pytest.mark.parametrize("part, held, sent", [(1 << 13, 500_000, 250_000), (2, 5, 3), (1, 40, 10)])
def test_product_in_blocks_adds_every_overlap(monkeypatch, part, held, sent):
    """However columns are dealt and whenever pairs are sent, overlaps add up to those of the whole product."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", part)
    monkeypatch.setattr(jaccard, "HELD_PAIRS", held)
    monkeypatch.setattr(jaccard, "SENT_PAIRS", sent)
    draw = np.random.default_rng(part)
    cells = sorted({(int(h), int(c)) for h, c in draw.integers(0, 12, (90, 2))})
    every = [pa.array([x[i] for x in cells], pa.int64()) for i in (0, 1)]
    n = pa.array([10] * len(cells), pa.int32())
    batch = pa.RecordBatch.from_arrays([*every, n], names=["h", "c", "n"])
    parts = pa.Table.from_batches(jaccard._shared_columns([batch.slice(at, 7) for at in range(0, len(cells), 7)]))
    blocks_of: dict[int, set] = {}
    for b, h in zip(parts["b"].to_pylist(), parts["h"].to_pylist(), strict=True):
        blocks_of.setdefault(h, set()).add(b)
    assert all(len(b) == 1 for b in blocks_of.values())

    expected = Counter()
    for h in {h for h, _ in cells}:
        expected.update(combinations([c for g, c in cells if g == h], 2))
    found = Counter()
    table = parts.sort_by([("b", "ascending"), ("h", "ascending")])
    zero = pa.array([0] * len(table), pa.int64())
    columns = [table["h"], table["c"], table["n"].cast(pa.int64()), table["c"], *(zero for _ in jaccard.SIGNS)]
    table = pa.table(columns, names=["h", "c", "n", "label", *jaccard.SIGNS])
    for b in set(parts["b"].to_pylist()):
        mine = pa.array([h for h, x in blocks_of.items() if b in x], pa.int64())
        here = table.filter(pc.is_in(table["h"], value_set=mine))
        for out in jaccard._multiply(None)(here.to_batches(max_chunksize=5)):
            for x, y, _, _, o in zip(*(c.to_pylist() for c in out.columns), strict=True):
                found[(x, y)] += o
    assert found == expected


def test_jaccard_equals_brute_force(spark, messy):
    got = jaccard.join_documents(messy).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(jaccard_components([(d, t) for d, t, *_ in rows()]))


def test_signatures_never_differ_in_more_slots_than_sets_in_shingles():
    draw = np.random.default_rng(7)
    pool = draw.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
    sets = [draw.choice(pool, n, replace=False) for n in (1, 2, 50, 50, 400, 2000)]
    for keep in (1, 20, 45, 49):
        sets.append(np.concatenate([sets[2][:keep], draw.choice(pool, 50 - keep, replace=False)]))
    sets = [np.unique(s) for s in sets]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    signs = jaccard.signatures(np.concatenate(sets), row, len(sets))
    assert (signs < 0).any() and (signs >= 0).any()
    for a in range(len(sets)):
        for b in range(len(sets)):
            slots = sum(bin((int(x) ^ int(y)) & (2**64 - 1)).count("1") for x, y in zip(signs[a], signs[b], strict=True))
            got = jaccard.differing(signs[a : a + 1], signs[b : b + 1])[0]
            assert got == slots <= len(np.setxor1d(sets[a], sets[b]))


def test_jaccard_of_large_groups_and_frequent_passages(spark, monkeypatch):
    random.seed(3)
    word = [f"w{i}" for i in range(500)]
    base = [random.choice(word) for _ in range(120)]
    passage = " ".join(f"licence{i}" for i in range(30))
    docs = []
    for i in range(90):
        text = list(base)
        for _ in range(random.choice((0, 1, 1, 2, 3))):
            text[random.randrange(120)] = random.choice(word)
        docs.append((i, " ".join(text)))
    docs += [(100 + i, " ".join(random.choice(word) for _ in range(25)) + " " + passage) for i in range(60)]
    got = jaccard.join_documents(spark.createDataFrame(docs, "doc_id bigint, text string"))
    got = got.select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(jaccard_components(docs))


def test_one_document_of_each_group_stays(spark, messy, nothing):
    kept = jaccard.keep_one(messy)
    assert kept.columns == messy.columns
    got = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is not None, x))
    assert got == [None, None, 1, 4, 5, 6, 7, 8, 10, 12, 13, 14, 16]
    assert jaccard.keep_one(nothing).collect() == []


def test_repeats_equal_brute_force(spark, messy, nothing):
    docs = [(d, t) for d, t, *_ in rows()]
    masks = removed(docs)
    want = []
    for d, t in docs:
        mask = masks[float("-inf") if d is None else d, t or ""]
        data = (t or "").encode()
        kept = bytes(x for x, m in zip(data, mask, strict=True) if not m)
        want.append((d, len(data), sum(mask), len([r for r in mask.split(b"\0") if r]), kept))
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup.dedup(messy).collect()]
    assert order(got) == order(want)
    assert suffix_dedup.dedup(nothing).collect() == []


def test_repeats_with_split_owners_and_more_batches(spark, monkeypatch):
    random.seed(5)
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    passage = "".join(random.choice("abcdefgh ") for _ in range(140))
    docs = []
    for i in range(60):
        around = ["".join(random.choice("ijklmnop ") for _ in range(random.randrange(0, 200))) for _ in range(2)]
        docs.append((i * 3, around[0] + passage[random.randrange(30) :] + around[1]))
    masks = removed(docs)
    for batches in (1, 3, 8):
        frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
        got = {r.doc_id: r.n_removed for r in suffix_dedup.dedup(frame, batches=batches).collect()}
        assert got == {d: sum(masks[d, t]) for d, t in docs}


def test_texts_without_id_keep_their_own_bytes(spark):
    import xxhash

    seen, pair, i = {}, None, 0
    while pair is None:  # two texts that share 24 bits of their hash; only one repeats itself
        again = f"{i} " + "".join(random.Random(i).choices("abcdefgh ", k=130))
        text = again + again if i % 2 else again * 2 + "x" if i % 4 else again
        tag = xxhash.xxh3_64_intdigest(text.encode()) & 0xFFFFFF
        other = seen.setdefault(tag, text)
        pair = (other, text) if len(other) != len(text) else None
        i += 1
    masks = removed([(None, t) for t in pair])
    frame = spark.createDataFrame([(None, t) for t in pair], "doc_id bigint, text string")
    got = {r.n_bytes: (r.n_removed, bytes(r.kept)) for r in suffix_dedup.dedup(frame).collect()}
    for t in pair:
        mask = masks[float("-inf"), t]
        assert got[len(t)] == (sum(mask), bytes(x for x, m in zip(t.encode(), mask, strict=True) if not m))


def test_stripped_texts_keep_all_columns(spark, messy):
    got = suffix_dedup.strip(messy.withColumn("n_chars", messy.c), length="n_chars")
    assert got.columns == [*messy.columns, "n_chars"]
    found = {r.doc_id: r for r in got.collect() if r.doc_id not in (None, 4)}
    assert len(found) == 15 and found[5].text is None and found[6].text == ""
    assert found[12].text == "x" and found[12].n_chars == 1
    assert found[4 + 4].text == "one two"


ITEMS = [
    (1, "Tom has 12 apples and gives 5 of them to Ann before he walks 3 km home to his old house"),
    (2, "Name the capital"),
    (3, None),
    (4, OTHER),
]


def test_benchmark_items_and_their_variants(spark, messy):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = [
        (1, "Here it comes: tom has 12 apples and gives 5 of them to Ann before he walks 3 km home to his old house. End"),
        (2, ITEMS[0][1].replace("Tom", "Bob").replace("Ann", "Eve").replace("12", "40").replace("5", "7").replace("3 km", "9 miles")),
        (3, PROSE),
        (4, None),
        (5, "Tom has apples. " + PROSE),
        (6, PROSE + " " + OTHER.replace(" ", "\n")),
        (7, "So name the capital of it"),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.same_slots) for r in decontam.contaminated(frame, items).collect()}
    assert {g[:2] for g in got} == {(1, 1), (2, 1), (6, 4), (7, 2)}
    assert (2, 1, False) in got and (6, 4, True) in got
    assert sorted(r.doc_id for r in decontam.clean(frame, items).collect()) == [3, 4, 5]


def test_copies_in_other_letter_case(spark):
    text = "In Paris Élodie Müller sold 12 old books to Ann Lee. Then Bob went home. She gave the rest to Tom in Rome"
    items = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    docs = [(1, text.lower()), (2, text.upper()), (3, text.title()), (4, PROSE.upper()), (5, text)]
    found = decontam.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 5} and len(found) == 4


def test_copies_of_items_with_few_plain_words(spark):
    texts = [
        "12 + 7 = 19, 13 + 8 = 21, 14 + 9 = 23, 15 + 10 = 25",
        "John Smith, Paris 1999; Mary Jones, London 2001; Peter Brown, Rome 2003; Anna White, Madrid 2005",
        "3 + 4 = 7",
        "5 km 8 miles 3 kg 7 lbs 2 feet 9 inches",
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    docs = [(i, f"{PROSE} {t} {OTHER}") for i, t in enumerate(texts)]
    docs += [(10, "22 + 7 = 29, 23 + 8 = 31, 24 + 9 = 33, 25 + 10 = 35"), (11, "6 + 2 = 8"), (12, PROSE)]
    docs += [(13, "4 km 9 miles 2 kg 6 lbs 1 feet 8 inches")]
    found = decontam.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in range(4)}
    assert all(r.same_slots for r in found)


def test_inconsistent_slots_are_no_match(spark):
    item = "Tom met Ann and Tom told Ann that Tom saw Ann when Tom left Ann near Tom and Ann there"
    names = iter("Al Bo Cy Di Ed Fay Gus Hal Ida Joe Kay Lee".split())
    text = " ".join(next(names) if w in ("Tom", "Ann") else w for w in item.split())
    docs = spark.createDataFrame([(1, text), (2, item.replace("Tom", "Sue"))], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert [r.doc_id for r in decontam.contaminated(docs, items).collect()] == [2]


def test_clean_keeps_rows_and_columns(spark, messy, nothing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    kept = decontam.clean(messy, items)
    assert kept.columns == messy.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 12, 13, 16]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.clean(messy, none).count() == messy.count()
    assert decontam.contaminated(nothing, items).collect() == []
