"""Byte-level BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over 16 bytes cuts every text into chunks of about CHUNK bytes, so texts that share a
passage share its inner chunks wherever it stands. A chunk that occurs more than once is encoded
once in the whole job. A text is then put together from its chunks' ids; chunks that occur once are
encoded with their neighbours, in one run. Where two parts meet, ids may differ from those of the
whole text: the words around the joint are encoded again, up to a place on either side where both
encodings surely agree (a printable character before white space, which no token spans and over
which the splitting pattern doesn't look). If a part has no such place, it is encoded again whole,
so the ids equal those of the whole text always.

Plan: texts go, compressed, to groups by a hash of id and text, sized by their bytes. Chunk digests
(16 bytes a chunk) are counted with the groups they occur in; the first group of a shared chunk
encodes it, and its ids go once to each other group that needs them, not to each text. A chunk in a
third of all texts thus costs one row for each group.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rowsmith.llm.text import mix, parts, raw, release_memory, slices

CHUNK = 1024
GROUP_BYTES = 4 << 20
ROWS_AT_ONCE = 256
_WINDOW = 16
_GEAR = (mix(np.arange(256, dtype=np.uint64) + np.uint64(7)) >> np.uint64(32)).astype(np.uint32)


class Coder:
    """Ids of texts under a byte-level BPE file of the tokenizers library, and texts of ids."""

    def __init__(self, path: str, extra: tuple[str, ...] = ()):
        """``extra``: further special tokens, which get the ids after the file's."""
        import tiktoken

        self._made = path, extra
        ranks, special, self.pieces = _read(path, extra)
        # Fixed value: the splitting pattern of byte-level BPE.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.special = list(special)
        self._coding = tiktoken.Encoding(
            "bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
        )
        self.lengths = np.array([len(p) for p in self.pieces])

    def __reduce__(self):
        return Coder, self._made

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self._coding.encode(text, allowed_special="all"), np.uint32)
        return np.array(self._coding.encode_ordinary(text), np.uint32)

    def text(self, ids: np.ndarray) -> str:
        return text_of(self.pieces, ids)


def _alphabet() -> list[str]:
    """The character that stands for each byte in the file: itself if printable, else one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _read(path: str, extra: tuple[str, ...] = ()) -> tuple[dict[bytes, int], dict[str, int], list[bytes]]:
    """Rank of each piece, ids of special tokens, and the bytes of each id."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    split, model = made["pre_tokenizer"], made["model"]
    if made["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
        raise ValueError(f"{path} is not a plain byte-level BPE")
    byte_of = {ord(c): chr(b) for b, c in enumerate(_alphabet())}
    special = {x["content"]: x["id"] for x in made["added_tokens"]}
    ranks = {t.translate(byte_of).encode("latin-1"): i for t, i in model["vocab"].items() if t not in special}
    n = max([*ranks.values(), *special.values()]) + 1
    special |= {x: n + i for i, x in enumerate(extra)}
    pieces = [b""] * (n + len(extra))
    for piece, i in ranks.items():
        pieces[i] = piece
    for text, i in special.items():
        pieces[i] = text.encode()
    return ranks, special, pieces


def text_of(pieces: list[bytes], ids: np.ndarray) -> str:
    return b"".join(map(pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


_CODERS: dict[str, Coder] = {}
_PIECES: dict[str, list[bytes]] = {}


def coder_of(path: str) -> Coder:
    """The coder of a file, read once in each worker; what reading it took goes back."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
        release_memory()
    return _CODERS[path]


def pieces_of(path: str) -> list[bytes]:
    """The bytes of each id, all that decoding needs: a worker that only decodes makes no coder."""
    if path in _CODERS:
        return _CODERS[path].pieces
    if path not in _PIECES:
        _PIECES[path] = _read(path)[2]
        release_memory()
    return _PIECES[path]


def cuts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Ends of the chunks of each text, counted from its start."""
    value = _GEAR[data]
    for step in (1, 2, 4, 8):
        more = value.copy()
        more[step:] += value[:-step] << np.uint32(step)
        value = more
    found = np.flatnonzero(value < np.uint32((1 << 32) // CHUNK)) + 1
    for _ in range(3):
        inside = np.flatnonzero(found < len(data))
        found[inside] += (data[found[inside]] & 0xC0) == 0x80
    row = np.searchsorted(offsets, found, "right") - 1
    fine = (row < len(offsets) - 1) & (found - offsets[np.minimum(row, len(offsets) - 2)] >= 2 * _WINDOW)
    found, row = found[fine], row[fine]
    begin = np.searchsorted(row, np.arange(len(offsets)))
    out = []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        ends = np.unique(found[begin[i] : begin[i + 1]] - a)
        if b > a:
            ends = ends[ends < b - a]
            out.append(np.append(ends, b - a))
        else:
            out.append(ends[:0])
    return out


def chunks(data: bytes, ends: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
    """Digest, start and end of each chunk."""
    import xxhash

    at = 0
    for end in ends.tolist():
        yield xxhash.xxh3_128_digest(data[at:end]), at, end
        at = end


def _agree_before(data: bytes, low: int, high: int) -> int:
    """The last place p, low < p < high, with a printable character before white space, else low."""
    while True:
        p = max(data.rfind(b" ", low + 1, high), data.rfind(b"\n", low + 1, high))
        if p < 0:
            return low
        if 33 <= data[p - 1] <= 126:
            return p
        high = p


def _agree_after(data: bytes, low: int, high: int) -> int:
    """The first such place with low < p < high, else high."""
    at = low + 1
    while at < high:
        a, b = data.find(b" ", at, high), data.find(b"\n", at, high)
        p = min(x for x in (a, b, high) if x >= 0)
        if p >= high or 33 <= data[p - 1] <= 126:
            return p
        at = p + 1
    return high


def join_parts(data: bytes, spans: list[tuple[int, int, np.ndarray]], coder: Coder) -> np.ndarray:
    """Ids of a whole text from the ids of consecutive parts of it."""
    if not spans:
        return np.zeros(0, np.uint32)
    done = []
    start, end, ids = spans[0]
    for _, more_end, more in spans[1:]:
        left = _agree_before(data, start, end)
        right = _agree_after(data, end, more_end)
        middle = coder.ids(data[left:right].decode())
        if left > start:
            done.append(_until(ids, left - start, coder))
        if right < more_end:
            done.append(middle)
            start, ids = right, _from(more, right - end, coder)
        else:
            start, ids = left, middle
        end = more_end
    return np.concatenate([*done, ids]).astype(np.uint32)


def _place(ids: np.ndarray, size: int, coder: Coder) -> int:
    ends = np.cumsum(coder.lengths[ids])
    k = int(np.searchsorted(ends, size))
    if k == len(ends) or ends[k] != size:
        raise AssertionError("no token ends where encodings must agree")
    return k + 1


def _until(ids: np.ndarray, size: int, coder: Coder) -> np.ndarray:
    return ids[: _place(ids, size, coder)]


def _from(ids: np.ndarray, size: int, coder: Coder) -> np.ndarray:
    return ids[_place(ids, size, coder) :]


def whole(data: bytes, ends: np.ndarray, shared: dict[bytes, np.ndarray], coder: Coder) -> np.ndarray:
    """Ids of a text, given those of its shared chunks."""
    spans: list[tuple[int, int, np.ndarray]] = []
    alone = -1
    for digest, start, end in chunks(data, ends):
        known = shared.get(digest)
        if known is None:
            alone = start if alone < 0 else alone
        else:
            if alone >= 0:
                spans.append((alone, start, coder.ids(data[alone:start].decode())))
                alone = -1
            spans.append((start, end, known))
    if alone >= 0:
        spans.append((alone, len(data), coder.ids(data[alone:].decode())))
    return join_parts(data, spans, coder)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each chunk occurs in each group."""
    for batch in slices(batches, 1):
        data, offsets = raw(batch.column(1))
        group = batch.column(0).to_pylist()
        seen: dict[tuple[bytes, int], int] = {}
        flat = data.tobytes()
        for i, ends in enumerate(cuts(data, offsets)):
            for digest, _, _ in chunks(flat[offsets[i] : offsets[i + 1]], ends):
                key = (digest, group[i])
                seen[key] = seen.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in seen], pa.binary()),
                pa.array([g for _, g in seen], pa.int32()),
                pa.array(list(seen.values()), pa.int64()),
            ],
            names=["chunk", "grp", "n"],
        )


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, 2):
        data, offsets = raw(batch.column(2))
        flat = data.tobytes()
        packed = [press.compress(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["grp", "id", "packed"]
        )


def _unpacked(table: pa.Table) -> Iterator[tuple[bytes, np.ndarray]]:
    import zstandard

    press = zstandard.ZstdDecompressor()
    for item in table.column("packed").to_pylist():
        data = press.decompress(item)
        flat = np.frombuffer(data, np.uint8)
        yield data, cuts(flat, np.array([0, len(flat)]))[0]


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The id column and ``ids``: the token ids of each text, little-endian unsigned 32-bit integers.

    Strings of special tokens in a text get their special id; nothing is added. A null or empty text
    has no ids (an empty value). Every row is kept, repeated rows and null ids too; an empty table
    gives an empty result.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    n_groups = parts(docs, text, GROUP_BYTES)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_column), body), F.lit(n_groups)).cast("int").alias("grp"),
        F.col(id_column).alias("id"),
        body.alias("text"),
    )
    shared = (
        rows.select("grp", "text")
        .mapInArrow(_count, "chunk binary, grp int, n bigint")
        .groupBy("chunk")
        .agg(F.sum("n").alias("n"), F.collect_set("grp").alias("grps"))
        .filter(F.col("n") > 1)
    )
    packed = rows.mapInArrow(_pack, f"grp int, id {kind}, packed binary")

    def encode_chunks(texts: pa.Table, owned: pa.Table) -> pa.Table:
        coder = coder_of(path) if owned.num_rows else None
        todo, out = set(owned.column("chunk").to_pylist()), {}
        for data, ends in _unpacked(texts) if todo else ():
            for digest, start, end in chunks(data, ends):
                if digest in todo:
                    todo.discard(digest)
                    out[digest] = coder.ids(data[start:end].decode()).tobytes()
        return pa.table({"chunk": pa.array(list(out), pa.binary()), "ids": pa.array(list(out.values()), pa.binary())})

    def encode_texts(texts: pa.Table, known: pa.Table) -> pa.Table:
        coder = coder_of(path)
        have = {
            k: np.frombuffer(v, np.uint32)
            for k, v in zip(known.column("chunk").to_pylist(), known.column("ids").to_pylist(), strict=True)
        }
        found = [whole(data, ends, have, coder).tobytes() for data, ends in _unpacked(texts)]
        return pa.table({"id": texts.column("id"), "ids": pa.array(found, pa.binary())})

    owned = shared.select(F.array_min("grps").alias("grp"), "chunk")
    encoded = (
        packed.groupBy("grp").cogroup(owned.groupBy("grp")).applyInArrow(encode_chunks, "chunk binary, ids binary")
    )
    wanted = shared.select(F.explode("grps").alias("grp"), "chunk").join(encoded, "chunk")
    found = (
        packed.groupBy("grp").cogroup(wanted.groupBy("grp")).applyInArrow(encode_texts, f"id {kind}, ids binary")
    )
    return found.withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of the ids; null ids give null, no ids an empty text."""

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for whole_batch, at in ((b, i) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            batch = whole_batch.slice(at, ROWS_AT_ONCE)
            where = batch.schema.get_field_index(ids)
            found = [
                None if v is None else text_of(pieces, np.frombuffer(v, np.uint32)) for v in batch.column(where).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, name]
            )
        release_memory()

    if name in encoded.columns:
        raise ValueError(f"column {name} exists")
    schema = StructType([*encoded.schema.fields, StructField(name, StringType())])
    return encoded.mapInArrow(texts, schema)
