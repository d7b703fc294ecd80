"""Benchmark decontamination by templates.

Texts become templates: words in lower case without marks, with numbers, names (words with a capital)
and units replaced by placeholders of their type. Windows of WINDOW template words are hash-joined
between documents and benchmark items. For each document and item, the windows on one diagonal (same
distance of both positions, SHIFT words more or less) are one match; it counts if it covers COVERED of
the item and if its slots are consistent: what stands in an item's slots must map to one value each
in the document. So a question with other numbers or names is found too, and a text that has only
its frame words in common is not. Each text has a second form, in which names stay plain words; it
doesn't depend on letter case, so that copies in other case are found. A pair counts if either form
matches.

Windows without WORDS_AT_LEAST plain words are joined on their literal words, numbers and names included,
so that exact copies of them are found and variants are not. Items shorter than a window are one window
of their own length. Document windows are first held against a bit set of the benchmark's windows
(FILTER_BITS, whatever the benchmark's size), so that only possible matches are shuffled. The
benchmark's windows are broadcast if they are at most BROADCAST_ROWS, else the join is left to the
planner. Matches are grouped by document and item, so an item in a third of all documents is no hot
group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.text import LOWER, Words, free_name, mix, raw, slices, split_rows, windows
from rowsmith.session import scratch_dir

WINDOW = 8
WORDS_AT_LEAST = 4
COVERED = 0.6
CONSISTENT = 0.8
SHIFT = 2
FILTER_BITS = 1 << 26
BROADCAST_ROWS = 500_000

# Units of measurement that become placeholders after a number.
UNITS = (
    "mm cm dm m km mg g kg t ml cl l s sec second seconds min minute minutes h hour hours day days week weeks month "
    "months year years inch inches ft foot feet yard yards mile miles oz ounce ounces lb lbs pound pounds gallon "
    "gallons litre litres liter liters metre metres meter meters kilometre kilometres kilometer kilometers gram grams "
    "kilogram kilograms percent dollar dollars euro euros cent cents degree degrees mph kmh w kw kwh v a hz khz mhz ghz "
    "kb mb gb tb"
).split()

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WORDS = np.where(_LETTER, LOWER, ord(" ")).astype(np.uint8)
NUMBER, NAME, UNIT = 1, 2, 3
FORMS = (0, 1)


class Template:
    """Template words of all texts: hash with placeholders, kind (0 plain) and hash of what is there.

    Of the two FORMS, the first has names as placeholders. In the second, they are plain words, so that
    it doesn't depend on letter case.
    """

    def __init__(self, texts: pa.Array):
        written, written_offsets = raw(texts)
        data, offsets = raw(pc.utf8_lower(texts.cast(pa.string())))
        plain = _WORDS[data]
        if len(data) > 2:  # points inside numbers belong to them
            point = np.isin(data[1:-1], np.frombuffer(b".,:/", np.uint8)) & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
            plain[1:-1][point] = data[1:-1][point]
        words = Words.__new__(Words)
        words.take(plain, offsets)
        self.row, self.rows = words.row, words.rows
        self.value = words.hashes()
        starts = words.starts
        if not np.array_equal(written & 0xC0 == 0x80, data & 0xC0 == 0x80):  # lower case has other lengths
            other = Words.__new__(Words)
            other.take(_WORDS[written], written_offsets)
            starts = other.starts if len(other) == len(words) else starts
        first = written[np.minimum(starts, len(written) - 1)] if len(words) else np.zeros(0, np.uint8)
        digit = np.add.reduceat(_DIGIT[data] & words.solid, words.starts) > 0 if len(words) else np.zeros(0, bool)
        capital = (first >= 65) & (first <= 90)
        if len(written) > 1:
            second = written[np.minimum(starts + 1, len(written) - 1)]
            capital |= (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
        # A unit is one only right after a number: "a" and "second" are words elsewhere.
        counted = np.r_[False, digit[:-1] & (self.row[1:] == self.row[:-1])][: len(digit)]
        fixed = np.where(digit, NUMBER, np.where(counted & np.isin(self.value, _unit_hashes()), UNIT, 0))
        self.kinds = np.where((fixed == 0) & capital, NAME, fixed), fixed

    def windows(self, width: int, form: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of all windows; those with few plain words are hashed with what is in their slots."""
        kind = self.kinds[form]
        words = np.where(kind > 0, mix(kind.astype(np.uint64) + np.uint64(1 << 50)), self.value)
        value, first = windows(words, self.row, width)
        plain = np.r_[0, np.cumsum(kind == 0)]
        keep = 2 * (plain[first + width] - plain[first]) >= min(width, 2 * WORDS_AT_LEAST)
        literal = windows(self.value, self.row, width)[0]
        kinds = np.where(keep, form, form + len(FORMS)).astype(np.uint64)
        return np.where(keep, value, literal) ^ mix(np.uint64(width) + (kinds << np.uint64(32))), first


def _unit_hashes() -> np.ndarray:
    return Words(pa.array(UNITS)).hashes()


def _slots(t: Template, first: np.ndarray, width: int, form: int) -> list[list[int]]:
    """Values in the slots of windows, 0 for plain words."""
    at = first[:, None] + np.arange(width)
    return np.where(t.kinds[form][at] > 0, t.value[at], np.uint64(0)).view(np.int64).tolist()


def _item_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        t = Template(batch.column(1))
        n = np.bincount(t.row, minlength=t.rows)
        item = batch.column(0).to_pylist()
        columns: list[list] = [[], [], [], [], [], [], []]
        for width in sorted(set(np.minimum(n, WINDOW).tolist()) - {0}):
            for form in FORMS:
                value, first = t.windows(width, form)
                mine = np.minimum(n, WINDOW)[t.row[first]] == width
                value, first = value[mine], first[mine]
                row = t.row[first]
                begin = np.searchsorted(t.row, row)
                columns[0] += value.view(np.int64).tolist()
                columns[1] += [item[i] for i in row.tolist()]
                columns[2] += (first - begin).tolist()
                columns[3] += n[row].tolist()
                columns[4] += [width] * len(first)
                columns[5] += [form] * len(first)
                columns[6] += _slots(t, first, width, form)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], batch.schema.field(0).type),
                *(pa.array(c, pa.int32()) for c in columns[2:6]),
                pa.array(columns[6], pa.list_(pa.int64())),
            ],
            names=["h", "item", "item_pos", "item_words", "width", "form", "item_slots"],
        )


def _match(rows: list[dict]) -> tuple[int, int, float, bool] | None:
    """Covered words, first word, slot consistency and equality of the best diagonal of a document and item."""
    best = None
    by_shift: dict[int, list[dict]] = {}
    for x in rows:
        by_shift.setdefault(x["pos"] - x["item_pos"], []).append(x)
    for shift in by_shift:
        here = [x for s in range(shift - SHIFT, shift + SHIFT + 1) for x in by_shift.get(s, ())]
        covered: set[int] = set()
        pairs: dict[int, dict[int, set]] = {}
        for x in here:
            for k, (theirs, ours) in enumerate(zip(x["item_slots"], x["slots"], strict=True)):
                covered.add(x["item_pos"] + k)
                if theirs:
                    pairs.setdefault(theirs, {}).setdefault(ours, set()).add(x["item_pos"] + k)
        slots = sum(len(p) for to in pairs.values() for p in to.values())
        agree = sum(max(len(p) for p in to.values()) for to in pairs.values())
        same = all(set(to) == {value} for value, to in pairs.items())
        found = (len(covered), -min(x["pos"] for x in here), agree / slots if slots else 1.0, same)
        best = max(best, found) if best else found
    return best[0], -best[1], best[2], best[3]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs of documents and benchmark items: the document has the item or a variant of it.

    Returns both ids, ``row_key`` (hash of id and text), ``start`` (template word where the match
    begins), ``item_words``, ``matched_words``, ``slot_consistency`` and ``same_slots`` (no slot
    differs). A document has one row for each of its items. Null or empty texts, and items without
    words, match nothing. Repeated rows are one document. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_column).alias("item"), F.col(item_text).cast("string").alias("text"))
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, id_column), (items, "item")))
    known = items.mapInArrow(
        _item_windows, f"h bigint, item {item_kind}, item_pos int, item_words int, width int, form int, item_slots array<bigint>"
    )
    shift = 64 - (FILTER_BITS.bit_length() - 1)
    words = (
        known.selectExpr(f"shiftrightunsigned(h, {shift}) AS slot", "width")
        .selectExpr("shiftright(slot, 6) AS word", "shiftleft(1L, cast(slot % 64 AS int)) AS one", "width")
        .groupBy("word")
        .agg(F.bit_or("one").alias("bits"), F.collect_set("width").alias("widths"), F.count(F.lit(1)).alias("n"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    widths = sorted({w for ws in words["widths"].to_pylist() for w in ws})
    sent = spark.sparkContext.broadcast(bits)

    def candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            t = Template(batch.column(2))
            for width, form in itertools.product(widths, FORMS):
                value, first = t.windows(width, form)
                slot = (value >> np.uint64(shift)).astype(np.int64)
                hit = ((sent.value[slot >> 6] >> (slot & 63)) & 1).astype(bool)
                if not hit.any():
                    continue
                value, first = value[hit], first[hit]
                row = t.row[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value.view(np.int64)),
                        batch.column(0).take(pa.array(row)),
                        batch.column(1).take(pa.array(row)),
                        pa.array((first - np.searchsorted(t.row, row)).astype(np.int32)),
                        pa.array(_slots(t, first, width, form), pa.list_(pa.int64())),
                    ],
                    names=["h", "id", "row_key", "pos", "slots"],
                )

    rows = docs.select(
        F.col(id_column).alias("id"), _key(id_column, text).alias("row_key"), F.col(text).cast("string").alias("text")
    )
    found = rows.mapInArrow(candidates, f"h bigint, id {kind}, row_key bigint, pos int, slots array<bigint>")
    if sum(words["n"].to_pylist()) <= BROADCAST_ROWS:
        known = F.broadcast(known)
    joined = found.join(known, "h")
    pairs = joined.groupBy("id", "row_key", "item").agg(
        F.max("item_words").alias("item_words"),
        F.collect_set(F.struct("form", "pos", "item_pos", "slots", "item_slots")).alias("found"),
    )

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(3).to_pylist()
            best, keep = [], []
            for n, x in zip(size, batch.column(4).to_pylist(), strict=True):
                found = [_match([y for y in x if y["form"] == form]) for form in {y["form"] for y in x}]
                good = [b for b in found if b[0] >= COVERED * n and b[2] >= CONSISTENT]
                best.append(max(good or found))
                keep.append(bool(good))
            out = pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([b[1] for b in best], pa.int32()),
                    batch.column(3),
                    pa.array([b[0] for b in best], pa.int32()),
                    pa.array([b[2] for b in best], pa.float64()),
                    pa.array([b[3] for b in best], pa.bool_()),
                ],
                names=["id", "row_key", "item", "start", "item_words", "matched_words", "slot_consistency", "same_slots"],
            )
            yield out.filter(pa.array(keep, pa.bool_()))

    result = pairs.mapInArrow(
        judge,
        f"id {kind}, row_key bigint, item {item_kind}, start int, item_words int, matched_words int, "
        "slot_consistency double, same_slots boolean",
    )
    return result.withColumnsRenamed({"id": id_column, "item": item_column})


def _key(id_column: str, text: str):
    return F.xxhash64(F.col(id_column), F.col(text).cast("string"))


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a benchmark item, with all their columns; cases as in ``contaminated``."""
    path = scratch_dir(docs.sparkSession, "contaminated")
    key, other = free_name(docs, "__key"), free_name(docs, "__found")
    contaminated(docs, benchmark, id_column, text).select(F.col("row_key").alias(other)).distinct().write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    others, concerned = split_rows(docs, _key(id_column, text), found, key)
    return others.union(concerned.join(found, F.col(key) == F.col(other), "left_anti").drop(key))
