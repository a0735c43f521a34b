"""Removal of byte strings that also start earlier, by a suffix order built column by column.

A whole-corpus order would need a round per byte of the longest document. Only strings of ``LENGTH`` bytes
matter, so the collection whose order is built consists of short segments:

1. Every string of ``LENGTH`` bytes has an anchor, the rarest-looking ``GRAM`` bytes in it (least hash, then the
   last place). Equal strings have equal anchors at equal places. Per anchor a document has one *segment*: the stretch of
   all strings with this anchor.
2. Segments are dealt by their anchor. Of equal segments all but the first are repeats as a whole;
   segments whose anchor occurs in one form only are done.
3. For the rest, segments with equal anchors are put together. The order of their suffixes and the common
   prefixes of neighbours are built column-wise over many segments at once: each round inserts one symbol per segment,
   in front of what is there, as one sequential pass over the arrays of the round before (``columns``). Strings whose common prefix with
   a neighbour reaches ``LENGTH`` are equal; all but the first of each run are repeats.
4. Repeats are gathered per document, joined with the text and cut out.

A task holds ``CHUNK`` segments or so. Anchors with more forms than ``HOT`` go another exact way: their strings are single
rows, counted by their hash, combined before the shuffle.

NULL and empty texts stay empty. Rows that repeat an id count as one document, the one with the
smallest text. A NULL id comes before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .shingles import mix, prefix_sums, span_hash

LENGTH = 100
GRAM = 24
CHUNK = 20_000
HOT = 20_000
NULL_ID = -(1 << 63)
# Segments are packed as place of the anchor, bytes before it in the first and in the last string.
_BITS = 7
_MASK = (1 << _BITS) - 1


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by running minima of blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor key, hash of the segment and packed place for every segment of a text of ``length`` bytes or more."""
    sums = prefix_sums(raw)
    starts = np.arange(len(raw) - gram + 1)
    hashes = span_hash(sums, starts, starts + gram)
    low = np.uint64(0xFFFFFFFF)
    keys = (hashes & ~low) | (low - starts.astype(np.uint64))
    anchors = (low - (_smallest(keys, length - gram + 1) & low)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    last = np.append(first[1:], len(anchors)) - 1
    at = anchors[first]
    packed = (at << (2 * _BITS)) | ((at - first) << _BITS) | (at - last)
    whole = span_hash(sums, first, last + length)
    shape = ((at - first) << _BITS | (at - last)).astype(np.uint64)
    return hashes[at], mix(whole + mix(shape)), packed


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last string start of packed places."""
    at = packed >> (2 * _BITS)
    return at, at - ((packed >> _BITS) & _MASK), at - (packed & _MASK)


def _least_between(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo:hi]) for many non-empty ranges, by tables of doubling width."""
    levels, width = [values], 1
    longest = int((hi - lo).max(initial=1))
    while 2 * width <= longest:
        levels.append(np.minimum(levels[-1][:-width], levels[-1][width:]))
        width *= 2
    out = np.empty(len(lo), values.dtype)
    level = np.floor(np.log2(hi - lo)).astype(np.int64)
    for k in np.unique(level):
        mine = level == k
        out[mine] = np.minimum(levels[k][lo[mine]], levels[k][hi[mine] - (1 << int(k))])
    return out


def columns(texts: list[bytes], before: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Suffix order of segments, one symbol per segment and round.

    ``before`` is the number of bytes before each segment's anchor. Yields (column, order, common): the segments in the order
    of their suffixes from this column, counted from the anchor, and the common prefix of each with the
    one before it, cut at ``length``. A segment without a symbol in a column comes first and has nothing in common.
    """
    n = len(texts)
    left, right = int(before.max()), max(len(t) - int(b) for t, b in zip(texts, before))
    symbols = np.full((left + right, n), -1, np.int16)
    for k, (t, b) in enumerate(zip(texts, before)):
        begin = left - int(b)
        symbols[begin : begin + len(t), k] = np.frombuffer(t, np.uint8)
    order, common = np.arange(n), np.zeros(n, np.int32)
    for row in range(left + right - 1, -1, -1):
        heads = symbols[row][order]
        moved = np.argsort(heads, kind="stable")
        now = heads[moved]
        fresh = np.zeros(n, np.int32)
        alike = np.flatnonzero((now[1:] == now[:-1]) & (now[1:] >= 0)) + 1
        if len(alike):
            fresh[alike] = np.minimum(_least_between(common, moved[alike - 1] + 1, moved[alike] + 1) + 1, length)
        order, common = order[moved], fresh
        yield row - left, order, common


def repeats(docs: np.ndarray, packed: np.ndarray, keys: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, start) of every string in the segments that equals an earlier one with the same anchor."""
    at, lo, hi = unpack(packed)
    found = []
    for column, order, common in columns(texts, at - lo, length):
        if column > 0:
            continue
        start = at[order] + column
        real = (start >= lo[order]) & (start <= hi[order])
        run = np.cumsum(common < length)
        several = np.bincount(run)[run] > 1
        chosen = np.flatnonzero(real & several)
        if not len(chosen):
            continue
        rows = order[chosen]
        by = np.lexsort((start[chosen], docs[rows], keys[rows], run[chosen]))
        same = (run[chosen][by][1:] == run[chosen][by][:-1]) & (keys[rows][by][1:] == keys[rows][by][:-1])
        later = by[1:][same]
        found.append((rows[later], start[chosen][later]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _runs(docs: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (doc, start, end) of string starts, joined where they follow each other."""
    by = np.lexsort((starts, docs))
    d, s = docs[by], starts[by]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1)]) if len(d) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(d)) - 1 if len(first) else first
    return d[first], s[first], s[last] + length


def _first_of_batch(key, mark, doc, packed):
    """Rows sorted by (key, mark, doc, place), and which of them is the first of its (key, mark)."""
    by = np.lexsort((packed, doc, mark, key))
    k, m = key[by], mark[by]
    first = np.concatenate([[True], (k[1:] != k[:-1]) | (m[1:] != m[:-1])]) if len(by) else np.empty(0, bool)
    return by, first


_ROW = "kind int, key bigint, mark bigint, doc bigint, packed bigint"
_NAMES = ["kind", "key", "mark", "doc", "packed"]


def _rows(kind, key, mark, doc, packed) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), *[pa.array(np.asarray(c).astype(np.int64, copy=False), pa.int64()) for c in (key, mark, doc, packed)]], names=_NAMES)


def _segment_rows(bodies: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments of all documents; kind 0: a repeat of one in the same batch (dealt by document), kind 1: another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, docs = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = np.frombuffer(t.as_buffer(), np.uint8)
                if len(raw) >= length:
                    parts.append(segments(raw, length, gram))
                    docs.append(np.full(len(parts[-1][0]), i, np.int64))
            if not parts:
                continue
            key, mark, packed = (np.concatenate([p[k] for p in parts]).view(np.int64) for k in range(3))
            doc = np.concatenate(docs)
            by, first = _first_of_batch(key, mark, doc, packed)
            key = np.where(first, key[by], mix(doc[by].view(np.uint64)).view(np.int64))
            yield _rows(first.astype(np.int32), key, mark[by], doc[by], packed[by])

    return bodies.mapInArrow(run, _ROW)


def _sorted_out(rows: DataFrame) -> DataFrame:
    """Of the segments with one anchor and form all but the first become kind 0; the first stay when the anchor has several forms."""
    dealt = rows.repartition("key").sortWithinPartitions("key", "kind", "mark", "doc", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last first-row, while it is not known whether its anchor has other forms
        last = None  # (key, mark) of the last row of kind 1; and whether a first row of its key went out
        for batch in batches:
            kind, key, mark, doc, packed = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            ready = kind == 0
            yield _rows(kind[ready], key[ready], mark[ready], doc[ready], packed[ready])
            key, mark, doc, packed = key[~ready], mark[~ready], doc[~ready], packed[~ready]
            if not len(key):
                continue
            if held is not None:
                key, mark, doc, packed = (np.concatenate([[h], c]) for h, c in zip(held, (key, mark, doc, packed)))
            elif last is not None:
                key, mark, doc, packed = (np.concatenate([[h], c]) for h, c in zip((*last, 0, 0), (key, mark, doc, packed)))
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])])
            group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]]))
            forms = np.bincount(group, new)
            several = new & (forms[group] > 1)
            alone_last = forms[group[-1]] == 1
            known = held is None and last is not None  # row 0 only stands for what went out before
            if known:
                several[0] = False
            out0, out1 = ~new, several
            yield _rows(np.zeros(out0.sum(), np.int32), key[out0], mark[out0], doc[out0], packed[out0])
            yield _rows(np.ones(out1.sum(), np.int32), key[out1], mark[out1], doc[out1], packed[out1])
            last = (key[-1], mark[-1])
            tail = np.flatnonzero(new & (group == group[-1]))[-1]
            held = (key[tail], mark[tail], doc[tail], packed[tail]) if alone_last and not (known and tail == 0) else None

    return dealt.mapInArrow(run, _ROW)


def _zipped(bodies: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack.compress(t.as_buffer()) for t in batch.column(1)], pa.binary())], names=["doc", "z"])

    return bodies.mapInArrow(run, "doc bigint, z binary")


def _segment_texts(some: DataFrame, bodies: DataFrame, length: int) -> DataFrame:
    """(key, doc, packed, bytes) for rows of segments, cut from their documents."""
    lists = some.groupBy("doc").agg(F.collect_list("key").alias("keys"), F.collect_list("packed").alias("packed"))
    both = lists.join(_zipped(bodies), "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack_text = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc, keys, packed, z in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3)):
                raw = unpack_text.decompress(z.as_buffer())
                packed = packed.values.to_numpy()
                _, lo, hi = unpack(packed)
                cut = [raw[a : b + length] for a, b in zip(lo.tolist(), hi.tolist())]
                yield pa.RecordBatch.from_arrays([keys.values, pa.array(np.full(len(cut), doc), pa.int64()), pa.array(packed, pa.int64()), pa.array(cut, pa.binary())],
                                                 names=["key", "doc", "packed", "bytes"])

    return both.select("doc", "keys", "packed", "z").mapInArrow(run, "key bigint, doc bigint, packed bigint, bytes binary")


_SPAN = "doc bigint, start bigint, end bigint"


def _span_rows(doc, start, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64), pa.int64()) for c in (doc, start, end)], names=["doc", "start", "end"])


def _by_columns(texts: DataFrame, length: int, chunk: int) -> DataFrame:
    """Repeats inside groups of segments with one anchor, many groups at a time."""
    dealt = texts.repartition("key").sortWithinPartitions("key")

    def solve(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables)
        docs, packed, keys = (table.column(c).to_numpy() for c in ("doc", "packed", "key"))
        rows, starts = repeats(docs, packed, keys, table.column("bytes").to_pylist(), length)
        return _span_rows(*_runs(docs[rows], starts, length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if n + batch.num_rows > chunk:
                # Cut before the last anchor met, so that every anchor is whole in a chunk.
                keys = batch.column(0).to_numpy()
                first = int(np.searchsorted(keys, keys[-1]))
                if first:
                    yield solve([*waiting, batch.slice(0, first)])
                    waiting, n, batch = [], 0, batch.slice(first)
                elif waiting and waiting[-1].column(0)[-1].as_py() != keys[0]:
                    yield solve(waiting)
                    waiting, n = [], 0
            waiting.append(batch)
            n += batch.num_rows
        if waiting:
            yield solve(waiting)

    return dealt.select("key", "doc", "packed", "bytes").mapInArrow(run, _SPAN)


def _by_strings(texts: DataFrame, length: int) -> DataFrame:
    """Repeats of anchors with very many forms: every string a row, the first of each found by an aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, packed, text in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                _, lo, hi = unpack(np.array([packed]))
                sums = prefix_sums(np.frombuffer(text, np.uint8))
                places = np.arange(int(hi[0] - lo[0]) + 1)
                h = span_hash(sums, places, places + length).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(np.full(len(h), doc), pa.int64()), pa.array(places + lo[0], pa.int64())], names=["h", "doc", "start"])

    strings = materialize(texts.select("key", "doc", "packed", "bytes").mapInArrow(run, "h bigint, doc bigint, start bigint"), "hot-strings")
    firsts = strings.groupBy("h").agg(F.min(F.struct("doc", "start")).alias("f"))
    later = strings.join(firsts, "h").filter(F.struct("doc", "start") > F.col("f"))
    return later.select("doc", "start", (F.col("start") + length).alias("end"))


def _cut(spans: list[list[int]], size: int) -> list[tuple[int, int]]:
    """Sorted disjoint union of spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, min(b, size)) for a, b in out]


def repeat_spans(bodies: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK, hot: int = HOT) -> DataFrame:
    """(doc, start, end) spans of repeated strings; they may touch and overlap."""
    found = materialize(_sorted_out(_segment_rows(bodies, length, gram)), "segments")
    at = F.shiftright("packed", 2 * _BITS)
    whole = found.filter("kind = 0").select("doc", (at - F.shiftright("packed", _BITS).bitwiseAND(_MASK)).alias("start"), (at - F.col("packed").bitwiseAND(_MASK) + length).alias("end"))
    open_rows = found.filter("kind = 1").select("key", "doc", "packed")
    many = materialize(open_rows.groupBy("key").count().filter(F.col("count") > hot).select("key"), "hot-anchors")
    texts = materialize(_segment_texts(open_rows, bodies, length), "segment-texts")
    out = whole.union(_by_columns(texts.join(many, "key", "left_anti"), length, chunk))
    return out if many.isEmpty() else out.union(_by_strings(texts.join(many, "key", "left_semi"), length))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK, hot: int = HOT) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed and n_spans of every document."""
    bodies = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NULL_ID)).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("t"))
    ids = bodies.groupBy("doc").count()
    if not ids.filter("count > 1").isEmpty():
        bodies = bodies.groupBy("doc").agg(F.min("t").alias("t"))
    spans = materialize(repeat_spans(bodies, length, gram, chunk, hot), "repeat-spans")
    lists = spans.groupBy("doc").agg(F.collect_list(F.array("start", "end")).alias("spans"))
    both = _zipped(bodies).join(lists, "doc", "left").select("doc", "z", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack_text = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, sizes, removed, counts = [], [], [], []
            for z, spans in zip(batch.column(1), batch.column(2).to_pylist()):
                raw = unpack_text.decompress(z.as_buffer())
                cut = _cut(spans or [], len(raw))
                ends = [0, *[b for _, b in cut]]
                kept.append(b"".join([raw[a:b] for a, b in zip(ends, [*[a for a, _ in cut], len(raw)])]))
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept[-1]))
                counts.append(len(cut))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64())],
                                             names=["doc", "kept", "n_bytes", "n_removed", "n_spans"])

    out = both.mapInArrow(run, "doc bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
    return out.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "kept", "n_bytes", "n_removed", "n_spans")
