"""SentencePiece encoding and decoding by a merge-type prefix table.

For every prefix of a text the encoding of that prefix ends in one particular token. A table holds
that last token per prefix: among the tokens that end at the place (found by an automaton over all
pieces), it is the one that is *compatible* with the last token of the prefix before it, i.e. the
merge rules, applied to the two tokens' characters alone, give back just these two. The ids are then read
from the end: last token, the prefix before it, its last token, and so on.

Merges never cross from a character to a following word mark, a character outside the vocabulary is
a barrier, and a run of word marks only pairs up within itself; so a text falls into stretches that are
encoded on their own, and a worker remembers the stretches it has met.

NULL and empty texts have no ids. Texts of any length are encoded whole, in time that grows with
their length.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .caches import WordCache, give_back, slices
from .columns import as_rows

MARK = "▁"
# Stretches remembered per worker and generation, at some 400 bytes each.
KEPT_STRETCHES = 600_000
_CODECS: dict = {}


class PieceCodec:
    """Encoder and decoder of one merge-type model file with byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes_at = {}
        self.shown: list[bytes] = []
        self.raw: dict[int, int] = {}
        self.skipped = {i for i in range(model.get_piece_size()) if model.is_control(i)}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.raw[i] = int(piece[1:-1], 16)
                self.bytes_at[self.raw[i]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.score[piece], self.ids[piece] = model.get_score(i), i
            shown = b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else bytes([self.raw[i]]) if i in self.raw else piece.replace(MARK, " ").encode()
            self.shown.append(shown)
        if len(self.bytes_at) != 256 or any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("needs byte fallback and pieces with word marks only in front")
        self.text_of = {i: p for p, i in self.ids.items()}
        self.letters = {p for p in self.ids if len(p) == 1}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [i]:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        inside = "".join(map(re.escape, sorted(self.letters)))
        self.known = re.compile(f"[{inside}]+|[^{inside}]")
        # A run of marks, then either one separator-like character or a word.
        self.stretch = re.compile(f"{MARK}+[^{MARK}\\n]*|[^{MARK}\\n]+|\\n+")
        self.cache = WordCache(lambda stretches: [self._packed(s) for s in stretches], KEPT_STRETCHES)

    def merged(self, text: str) -> list[int]:
        """The merge rules as they are defined: best score first, then leftmost. For single pieces,
        pairs and runs of marks; characters must be in the vocabulary."""
        parts, right, left = list(text), [*range(1, len(text)), -1], list(range(-1, len(text) - 1))
        queue: list = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (s := self.score.get(parts[a] + parts[b])) is not None:
                heapq.heappush(queue, (-s, a, b, parts[a] + parts[b]))

        for k in range(len(parts) - 1):
            offer(k, k + 1)
        while queue:
            _, a, b, whole = heapq.heappop(queue)
            if parts[a] is None or parts[b] is None or right[a] != b or parts[a] + parts[b] != whole:
                continue
            parts[a], parts[b] = whole, None
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [self.ids[p] for p in parts if p is not None]

    def compatible(self, a: int, b: int) -> bool:
        """True when merging the characters of both tokens gives back just the two."""
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) >= 500_000:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.text_of[a] + self.text_of[b]) == [a, b]
        return known

    def table(self, text: str) -> list[int]:
        """Ids of a text of known characters, by the last token of every prefix."""
        last, pairs = [-1] * (len(text) + 1), self.pairs
        sizes = [0] * (len(text) + 1)
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                before = last[end - size]
                if end == size or (before >= 0 and (pairs[before, token] if (before, token) in pairs else self.compatible(before, token))):
                    last[end], sizes[end] = token, size
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= sizes[at]
        return ids[::-1]

    def _stretch(self, text: str) -> list[int]:
        ids: list[int] = []
        marks = len(text) - len(text.lstrip(MARK))
        if marks > 1:
            # Word merges come before merges of marks, so the last mark goes with the word if it can.
            tail = self._stretch(text[marks - 1 :])
            alone = tail[0] == self.ids[MARK]
            return self.merged(MARK * (marks if alone else marks - 1)) + tail[alone:]
        for part in self.known.findall(text):
            if part[0] in self.letters:
                ids += self.table(part)
            else:
                ids += [self.bytes_at[b] for b in part.encode()]
        return ids

    def _packed(self, text: str) -> tuple[bytes, bytes]:
        ids = self._stretch(text)
        return np.array(ids, "<i4").tobytes(), ",".join(map(str, ids)).encode()

    def cut(self, text: str) -> list[str]:
        return self.stretch.findall(MARK + text.replace(" ", MARK)) if text else []

    def stretches(self, texts: list[str]) -> Iterator[list[tuple[bytes, bytes]]]:
        """For each text, per stretch its ids, packed and as decimal text."""
        for lo, hi in slices([len(t) for t in texts]):
            yield from self.cache.many([self.cut(t) for t in texts[lo:hi]])

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([p for p, _ in self.cache.get(self.cut(text))]), "<i4")

    def decode(self, ids) -> str:
        """The text of ids, as the library decodes them: the first word mark goes, bytes that are no UTF-8 show as U+FFFD."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else list(ids)
        shown = self.shown
        whole = b"".join([shown[i] for i in ids])
        if not self.skipped.isdisjoint(ids):
            return self._by_runs(ids)
        if ids and self.text_of.get(ids[0], "").startswith(MARK):
            whole = whole[1:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return self._by_runs(ids)

    def _by_runs(self, ids: list[int]) -> str:
        """The same for ids that hold control ids or broken byte sequences: bytes join only with their neighbours."""
        out, run, fresh = [], bytearray(), True
        for i in [*ids, -1]:
            if i in self.raw:
                run.append(self.raw[i])
                fresh = False
                continue
            out.append(run.decode("utf-8", "byte_replace"))
            run.clear()
            if i >= 0:
                shown = self.shown[i].decode()
                out.append(shown[1:] if fresh and not out[-1] and self.text_of.get(i, "").startswith(MARK) else shown)
            fresh = fresh and i in self.skipped and not out[-1]
        return "".join(out)


def codec(path: str) -> PieceCodec:
    """The codec of this worker for a model file."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def forget_codec(path: str) -> None:
    """Drops what this worker remembers for a model file and gives the memory back."""
    if path in _CODECS:
        _CODECS.pop(path).cache.forget()
    give_back()


def _byte_replace(error):
    return "�", error.start + 1


import codecs  # noqa: E402

codecs.register_error("byte_replace", _byte_replace)


def encode_documents(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with further columns ``piece_ids`` (array of int) and ``decoded_text`` (decoded from these ids).

    Columns of these names are replaced.
    """
    names = [c for c in docs.columns if c not in ("piece_ids", "decoded_text")]
    rows = docs.select(as_rows(docs.select(*[f"`{c}`" for c in names])), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            ids = [np.frombuffer(b"".join([p for p, _ in parts]), "<i4") for parts in c.stretches(batch.column(1).to_pylist())]
            offsets = np.cumsum([0, *map(len, ids)])
            flat = pa.array(np.concatenate([np.empty(0, "<i4"), *ids]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat), pa.array([c.decode(i) for i in ids], pa.string())],
                names=["r", "i", "d"])
            del batch, ids, offsets, flat
        # The worker may serve other stages next, which need the memory. Stretches take most of it, pairs of pieces much of the rest.
        del c
        forget_codec(model_path)

    out = rows.mapInArrow(run, f"r {rows.schema[0].dataType.simpleString()}, i array<int>, d string")
    return out.select(*[F.col("r")[c].alias(c) for c in names], F.col("i").alias("piece_ids"), F.col("d").alias("decoded_text"))


def digest_documents(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of ids, digest of the ids and digest of the text decoded from them, per document."""
    import hashlib

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint"), F.coalesce(F.col(f"`{text}`"), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            counts, id_sha, text_sha = [], [], []
            for parts in c.stretches(batch.column(1).to_pylist()):
                ids = np.frombuffer(b"".join([p for p, _ in parts]), "<i4")
                counts.append(len(ids))
                id_sha.append(hashlib.sha256(b",".join([d for _, d in parts])).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(id_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
