"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered turn by turn as ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line break, and encoded once
with character offsets; a token is under the loss where its span meets the text of an assistant turn, found by binary
search among the sorted turn spans. Control strings inside roles and texts are escaped: ``<|`` becomes ``<\\|``, ``<\\|``
becomes ``<\\\\|`` and so on, which can be undone exactly. The marks are special tokens, at which any encoding is cut, so a
long conversation is rendered in blocks of whole turns and its encoding is the same as that of the whole.

Null roles and texts read as empty; an empty assistant text adds nothing to the loss. Turns are ordered by number, equal
numbers by role and text, null numbers first; repeated rows are turns of their own. Rows with a null ``conv_id`` form one
conversation. Other columns are not returned. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
BLOCK_CHARS = 200_000  # a block ends with the turn that reaches it
TRAINED = ("assistant",)
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END) + "\n", re.DOTALL)
_FORMATTED = "conv_id long, block int, n_turns int, text string, input_ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str | None) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text) if text else ""


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str | None, str | None]], trained=TRAINED) -> tuple[str, list[tuple[int, int]]]:
    """Text of the turns and the spans of the texts to learn from, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role in trained and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that meet one of the sorted spans."""
    if not spans:
        return np.zeros(len(starts), bool)
    first, last = np.array(spans).T
    at = np.searchsorted(last, starts, side="right")  # the first span that ends after the token begins
    known = at < len(first)
    return known & (ends > first[np.minimum(at, len(first) - 1)]) & (ends > starts)


def load_tokenizer(source: str):
    """A byte-level tokenizer from its JSON text, with the marks as special tokens and offsets that cover blanks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, processors

    tokenizer = Tokenizer.from_str(source)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_special_tokens([START, SEP, END])
    return tokenizer


def _runs(batches, keys: int) -> Iterator[tuple[tuple, bool]]:
    """Rows with a mark where the first column changes."""
    last, first = None, True
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            yield row, first or row[:keys] != last
            last, first = row[:keys], False


def format_conversations(conversations: DataFrame, tokenizer_path: str, trained=TRAINED, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks of every conversation: ``conv_id, block, n_turns, text, input_ids, starts, ends, loss``.

    A partition is sorted and read as a stream, so a conversation of any length needs the memory of one block.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        source = conversations.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file of fixed size

    def blocks(batches):
        block, turns, size, conv = 0, [], 0, None
        for (conv_id, role, text), new in _runs(batches, 1):
            if turns and (new or size >= block_chars):
                yield conv, block, turns
                block, turns, size = block + 1, [], 0
            if new:
                block = 0
            conv = conv_id
            turns.append((role, text))
            size += len(text or "")
        if turns:
            yield conv, block, turns

    def run(batches):
        tokenizer = load_tokenizer(source.value)
        held, size = [], 0
        for conv, block, turns in blocks(batches):
            held.append((conv, block, len(turns), *render(turns, trained)))
            size += len(held[-1][3])
            if size >= 1_000_000:
                yield encode(tokenizer, held)
                held, size = [], 0
        if held:
            yield encode(tokenizer, held)

    def encode(tokenizer, held):
        ids, starts, ends, loss = [], [], [], []
        for (*_, spans), e in zip(held, tokenizer.encode_batch([h[3] for h in held], add_special_tokens=False), strict=True):
            offsets = np.array(e.offsets, dtype=np.int32).reshape(-1, 2)
            ids.append(e.ids)
            starts.append(offsets[:, 0])
            ends.append(offsets[:, 1])
            loss.append(loss_mask(offsets[:, 0], offsets[:, 1], spans))
        numbers = pa.list_(pa.int32())
        columns = [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int32()), pa.array([h[2] for h in held], pa.int32()),
                   pa.array([h[3] for h in held], pa.string()), pa.array(ids, numbers), pa.array(starts, numbers), pa.array(ends, numbers), pa.array(loss, pa.list_(pa.bool_()))]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "block", "n_turns", "text", "input_ids", "starts", "ends", "loss"])

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(run, _FORMATTED)


def loss_texts(text: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The unescaped texts under the mask; characters of several tokens count once."""
    first, last = starts[loss], np.maximum.accumulate(ends[loss])
    if not len(first):
        return []
    cuts = np.flatnonzero(first[1:] > last[:-1]) + 1  # a token that begins after all before it have ended
    begins, stops = first[np.append(0, cuts)], last[np.append(cuts, len(last)) - 1]
    return [unescape(text[a:b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The rows of a list column as views of one array."""
    flat, at = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a - at[0]:b - at[0]] for a, b in zip(at[:-1], at[1:], strict=True)]


def digest(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from its blocks in order."""

    def run(batches):
        state = None
        for b in batches:
            rows = []
            columns = [b.column(0).to_pylist(), b.column(1).to_pylist(), *(_lists(b.column(i)) for i in (2, 3, 4))]
            for conv, text, starts, ends, loss in zip(*columns, strict=True):
                if state is None or conv != state[0]:
                    if state:
                        rows.append(close(state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in _TURN.findall(text):
                    state[1] += 1
                    state[2].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                for learnt in loss_texts(text, starts, ends, loss):
                    state[3] += len(learnt)
                    state[4].update(learnt.encode())
                state[5] += len(text)
            if rows:
                yield batch(rows)
        if state:
            yield batch([close(state)])

    def close(s):
        return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

    def batch(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    rows = formatted.select("conv_id", "block", "text", "starts", "ends", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return rows.drop("block").mapInArrow(run, _DIGEST)
