"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, ``<|role|>ROLE<|text|>TEXT<|end|>`` for each turn, and encoded once.
The three control strings are special tokens, so no token reaches across them. In roles and texts
``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no control string can arise there, and undoing it
is exact. Token offsets are the running sum of the tokens' bytes; the spans of the assistant's
texts, also sorted, are matched with them by binary search.

Turns are grouped by conversation and run of TURNS turn numbers, so that a conversation with a large
share of all rows is formatted by many tasks; the result has a row for each such part. The
read-back streams over a conversation's parts in order and holds one part at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rowsmith.llm.bpe import Coder

TURNS = 256
# The control strings, and the role whose texts are learnt.
ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
LEARNT = "assistant"

_TURN = re.compile(r"<\|role\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The formatted turns, and first and last byte (exclusive) of each learnt text."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{ROLE}{escape(role)}{TEXT}", escape(text)
        start = at + len(head.encode())
        end = start + len(body.encode())
        if role == LEARNT and end > start:
            spans.append((start, end))
        out += [head, body, END]
        at = end + len(END)
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def masked_tokens(ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """First and last token (exclusive) of each byte span, from the tokens' ends."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(starts, spans[:, 0], "left")
    last = np.searchsorted(ends, spans[:, 1], "right")
    if len(spans) and not ((starts[first] == spans[:, 0]).all() and (ends[last - 1] == spans[:, 1]).all()):
        raise AssertionError("a token reaches across a turn's text")
    return np.stack([first, last], axis=1)


def chat_coder(path: str) -> Coder:
    return Coder(path, extra=(ROLE, TEXT, END))


def _groups(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches by their first columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:n_keys] != key:
                yield key, held
                held = []
            key = row[:n_keys]
            held.append(row[n_keys:])
    if held:
        yield key, held


def format_conversations(
    conversations: DataFrame,
    path: str,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Formatted text, token ids and loss mask of each conversation, in parts of TURNS turn numbers.

    Returns ``conv_id`` (under the name given), ``part``, ``formatted``, ``ids`` (array of int) and
    ``mask`` (array of the first and last token, exclusive, of each learnt text). Turns are ordered
    by turn, null first, then role and text; repeated rows are turns of their own. Null roles and
    texts are empty; a null conversation id is one conversation. An empty table gives an empty
    result.
    """
    kind = conversations.schema[conv].dataType.simpleString()
    rows = conversations.select(
        F.col(conv).alias("conv"),
        F.coalesce(F.floor(F.col(turn) / TURNS), F.lit(-(1 << 62))).cast("bigint").alias("part"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )

    def form(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = chat_coder(path)
        for (conv_id, part), turns in _groups(batches, 2):
            formatted, spans = render([t[1:] for t in turns])
            ids = coder.ids(formatted)
            mask = masked_tokens(np.cumsum(coder.lengths[ids]), spans)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([conv_id], batch_type),
                    pa.array([part], pa.int64()),
                    pa.array([formatted], pa.string()),
                    pa.array([ids.tolist()], pa.list_(pa.int32())),
                    pa.array([mask.tolist()], pa.list_(pa.list_(pa.int32()))),
                ],
                names=["conv", "part", "formatted", "ids", "mask"],
            )

    batch_type = to_arrow_type(conversations.schema[conv].dataType)
    found = (
        rows.repartition("conv", "part")
        .sortWithinPartitions("conv", "part", "turn", "role", "text")
        .mapInArrow(form, f"conv {kind}, part bigint, formatted string, ids array<int>, mask array<array<int>>")
    )
    return found.withColumnRenamed("conv", conv)


def read_back(formatted: DataFrame, path: str, conv: str = "conv_id") -> DataFrame:
    """Digests of each conversation, read from formatted text, ids and mask."""
    kind = formatted.schema[conv].dataType.simpleString()
    rows = formatted.select(F.col(conv).alias("conv"), "part", "formatted", "ids", "mask")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = chat_coder(path)
        key, state = None, None

        def closed():
            turns, loss, n_turns, loss_chars, chars = state
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key], batch_type),
                    pa.array([n_turns], pa.int64()),
                    pa.array([turns.hexdigest()]),
                    pa.array([loss_chars], pa.int64()),
                    pa.array([loss.hexdigest()]),
                    pa.array([chars], pa.int64()),
                ],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for batch in batches:
            for conv_id, _, text, ids, mask in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is not None and conv_id != key:
                    yield closed()
                    state = None
                if state is None:
                    key, state = conv_id, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                for role, body in _TURN.findall(text):
                    state[0].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                    state[2] += 1
                ids = np.array(ids, np.int64)
                for first, last in mask:
                    learnt = unescape(coder.text(ids[first:last]))
                    state[1].update(learnt.encode())
                    state[3] += len(learnt)
                state[4] += len(text)
        if state is not None:
            yield closed()

    batch_type = to_arrow_type(formatted.schema[conv].dataType)
    found = (
        rows.repartition("conv")
        .sortWithinPartitions("conv", "part")
        .mapInArrow(
            digest,
            f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
            "formatted_chars bigint",
        )
    )
    return found.withColumnRenamed("conv", conv)
