"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of its assistant
turns are intersected with the sorted spans of the tokens by binary search.

Template: ``<s>[INST] role [/INST]text</s>`` for each turn, in the order of (turn, role, text). Control
strings inside roles and texts get a backslash after their first character; one that already has
backslashes there gets one more, so taking one away restores every text. The four control
strings are special tokens of the encoder, so no token reaches across the border of a turn.

A conversation is one training example and one row: its turns are gathered per conversation, partly
before the shuffle. NULL texts and roles count as empty, NULL turns come first, rows that are repeated are turns of
their own, and a NULL conversation id is a conversation like any other. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .caches import slices

# The control strings of the template.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]"]
_ESCAPE = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](.*?)</s>", re.S)
# Text encoded at a time; the library holds the tokens of a slice as objects.
SLICE_BYTES = 1 << 20
_ENCODERS: dict = {}


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]], trained: str) -> tuple[str, np.ndarray]:
    """The formatted text and the sorted spans (start, end) of the turns of role ``trained``."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>[INST] {escape(role)} [/INST]", escape(text)
        if role == trained and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>"]
        at += len(head) + len(body) + len("</s>")
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def encoder(path: str):
    """The tokenizer of this worker, with the control strings as special tokens."""
    if path not in _ENCODERS:
        from tokenizers import AddedToken, Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROLS])
        _ENCODERS[path] = tokenizer
    return _ENCODERS[path]


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """True for tokens that lie in one of the sorted, disjoint spans: the last span that begins at or before
    the token is found by binary search."""
    if not len(spans) or not len(offsets):
        return np.zeros(len(offsets), bool)
    at = np.searchsorted(spans[:, 0], offsets[:, 0], side="right") - 1
    return (at >= 0) & (offsets[:, 1] <= spans[np.maximum(at, 0), 1]) & (offsets[:, 1] > offsets[:, 0])


def masked_texts(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The stretches of text under the mask, unescaped, joined where tokens touch or share a character."""
    out: list[list[int]] = []
    for start, end in offsets[mask].tolist():
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [unescape(formatted[a:b]) for a, b in out]


def encoded(tokenizer, batch: pa.RecordBatch, trained: str) -> pa.RecordBatch:
    """Conversations (conv_id, roles, texts) rendered, encoded with offsets, and masked."""
    rendered = [render(list(zip(r, t)), trained) for r, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
    found = tokenizer.encode_batch([f for f, _ in rendered], add_special_tokens=False)
    offsets = [np.array(e.offsets, np.int32).reshape(-1, 2) for e in found]
    ids = [np.array(e.ids, np.int32) for e in found]
    masks = [loss_mask(o, spans) for o, (_, spans) in zip(offsets, rendered)]
    ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
    flat = np.concatenate([np.empty((0, 2), np.int32), *offsets])
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(v))) for v in (np.concatenate([np.empty(0, np.int32), *ids]), flat[:, 0], flat[:, 1], np.concatenate([np.empty(0, bool), *masks]))]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array([f for f, _ in rendered], pa.string()), *lists], names=["conv_id", "formatted", "ids", "starts", "ends", "loss_mask"])


def format_conversations(rows: DataFrame, tokenizer_path: str, trained: str = "assistant", conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, formatted, ids, offsets_start, offsets_end and loss_mask per conversation."""
    quoted = [F.col(f"`{c}`") for c in (turn, role, text)]
    turns = rows.select(F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"), F.struct(
        quoted[0].cast("bigint").alias("turn"), F.coalesce(quoted[1], F.lit("")).alias("role"), F.coalesce(quoted[2], F.lit("")).alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform("turns", lambda t: t["text"]).alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of a stage take all cores
        tokenizer = encoder(tokenizer_path)
        for batch in batches:
            texts = batch.column(2)
            upto = np.concatenate([[0], np.cumsum(pc.binary_length(texts.values).to_numpy(zero_copy_only=False), dtype=np.int64)])
            for lo, hi in slices(np.diff(upto[texts.offsets.to_numpy()]).tolist(), SLICE_BYTES):
                yield encoded(tokenizer, batch.slice(lo, hi - lo), trained)

    return whole.mapInArrow(run, "conv_id bigint, formatted string, ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the output of ``format_conversations``: turns from the text, the loss text from offsets and mask."""

    def lists(column: pa.ListArray) -> list[np.ndarray]:
        """The lists of a column without Python objects for their numbers."""
        borders, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        return [values[a:b] for a, b in zip(borders[:-1], borders[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, starts, ends, mask in zip(batch.column(0).to_pylist(), batch.column(1), *(lists(batch.column(k)) for k in (2, 3, 4))):
                text = text.as_py()
                turns = parse(text)
                loss = "".join(masked_texts(text, np.stack([starts, ends], axis=1), mask))
                rows.append((i, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), len(starts), int(mask.sum())))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "loss_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=names)

    return formatted.select("conv_id", "formatted", "starts", "ends", "loss_mask").mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint, loss_tokens bigint")
