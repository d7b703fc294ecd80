import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from helpers import OTHER, PROSE, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowsmith.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(PATH)


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


def test_documents_equal_the_library(spark, messy, plain):
    found = bpe.decode(bpe.encode(messy, PATH), PATH).collect()
    got = sorted((r.doc_id or -1, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in found)
    want = sorted((d or -1, ids_of(plain, t), plain.decode(ids_of(plain, t), skip_special_tokens=False)) for d, t, *_ in rows())
    assert got == want


def test_empty_table(nothing):
    assert bpe.encode(nothing, PATH).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "a", "the", " 12", "'s", "é", "漢", "<|endoftext|>", ".", " ", "x" * 40]), max_size=60), st.data())
def test_any_parts_join_to_the_whole(parts, data):
    coder, plain = bpe.coder_of(PATH), Tokenizer.from_file(PATH)
    text = "".join(parts)
    size = len(text)
    cuts = sorted({0, size, *data.draw(st.lists(st.integers(0, size), max_size=8))})
    spans, at = [], 0
    for a, b in zip(cuts, cuts[1:], strict=False):
        body = text[a:b]
        spans.append((at, at + len(body.encode()), coder.ids(body)))
        at += len(body.encode())
    got = bpe.join_parts(text.encode(), [s for s in spans if s[1] > s[0]], coder)
    assert got.tolist() == ids_of(plain, text)


def test_chunks_depend_on_content_alone(coder):
    shared = (PROSE + OTHER) * 12
    one, two = shared.encode(), ("Something else before it. " + shared).encode()
    both = []
    for data in (one, two):
        flat = np.frombuffer(data, np.uint8)
        both.append({d for d, _, _ in bpe.chunks(data, bpe.cuts(flat, np.array([0, len(flat)]))[0])})
    assert len(both[0] & both[1]) >= len(both[0]) - 1


def test_shared_chunks_are_used(coder):
    data = ((PROSE + OTHER) * 12).encode()
    ends = bpe.cuts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
    known = {d: coder.ids(data[a:b].decode()) for d, a, b in bpe.chunks(data, ends)}
    assert len(known) > 1
    assert bpe.whole(data, ends, known, coder).tolist() == coder.ids(data.decode()).tolist()


def test_decode_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray())], "doc_id int, ids binary")
    assert [r.decoded for r in bpe.decode(df, PATH).orderBy("doc_id").collect()] == [None, ""]


def test_other_tokenizers_are_refused():
    with pytest.raises((ValueError, KeyError)):
        bpe.Coder(public_tokenizers.path("word_bpe_49k.json"))


def test_slices_keep_rows():
    from rowsmith.llm.text import slices

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 3_000_000, None, "b" * 3_000_000, "c" * 9_000_000, ""])], names=["t"])
    assert [b.num_rows for b in slices([batch], 0)] == [2, 1, 1, 1]


def test_decoding_makes_no_coder(coder, monkeypatch):
    monkeypatch.setattr(bpe, "_CODERS", {})
    assert bpe.pieces_of(PATH) == coder.pieces
    assert not bpe._CODERS
