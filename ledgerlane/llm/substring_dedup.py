"""Removal of long word sequences that occur more than once, by a compacted de Bruijn graph.

Every run of ``LENGTH`` words (a window) is an edge of the graph, its vertices being the runs of one word less. Only
edges that occur at two places or more matter, and chains of them without branches are put together
to paths, so that a passage is one path and a row per place instead of a row per word.

1. *Bundles.* Every window has an anchor, the ``GRAM`` words in it with the least hash (then the last place).
   Neighbouring windows with one anchor make a bundle, a ready chain of up to ``LENGTH - GRAM + 1`` edges; a
   row is (anchor, content hash, document, place). Equal windows have equal anchors, so windows of bundles with
   an anchor that occurs once are unique and go no further.
2. *Edges.* Bundles are counted by content. Where all bundles of an anchor are equal, the whole bundle
   is repeated and stays a chain. The other distinct bundles are opened, once each, at the
   coordinates of one of their places, into single edges; edges are counted over bundles.
3. *Paths.* A chain or an edge X is followed by Y without a branch when all places of X are followed by Y and all
   places of Y follow X. Then the first places of X and Y are next to each other too, so a join on first
   coordinates finds Y, and order-free sums over all places (chains) or the neighbouring edges (single edges) tell
   whether the vertex branches. Links within a document are numbered to paths.
4. *Spans.* The places of a path are those of its first part, joined back to the bundles. Every span
   is cut from the text by its coordinates and a digest of its words is compared over all places of
   the path; spans whose words are not those of another place are dropped, so a clash of hashes removes nothing.

Joins are on hashes and on coordinates; common bundles are counted before the shuffle, and the rows of a bundle that
has very many places meet one row each, so the planner can split them. Sums over the places of a chain take
part of a hash (32 bits); where documents share an id, the id and the text together name a document.

NULL and empty texts have no words. Rows that repeat id and text are documents of their own, which repeat each
other. A NULL id is an id like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .shingles import mix, number_sums, prefix_sums, span_hash, word_spans

LENGTH = 35
GRAM = 8
# A place is packed as first word of a bundle and its number of windows.
_BITS = 8
_MASK = (1 << _BITS) - 1
NULL_ID = -(1 << 63)


def _least_last(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes the place of the least, the last of equal ones."""
    low = np.uint64(0xFFFFFFFF)
    keys = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, ~np.uint64(0))
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (low - (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low)).astype(np.int64)


def word_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text, and running sums that give the hash of any run of them."""
    starts, ends = word_spans(raw)
    return starts, ends, number_sums(span_hash(prefix_sums(raw), starts, ends))


def bundles(sums: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, content hash and packed place of every bundle of a text of ``length`` words or more."""
    places = np.arange(len(sums) - gram)
    grams = span_hash(sums, places, places + gram)
    anchors = _least_last(grams, length - gram + 1)
    first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    last = np.append(first[1:], len(anchors)) - 1
    return grams[anchors[first]], mix(span_hash(sums, first, last + length) + (last - first).astype(np.uint64)), first << _BITS | (last - first + 1)


def _batch(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c).view(np.int64) if np.asarray(c).dtype == np.uint64 else np.asarray(c, np.int64), pa.int64()) for c in columns], names=names)


def _anchor_rows(bodies: DataFrame, length: int, gram: int, whole: bool) -> DataFrame:
    """(anchor) of every bundle, or (anchor, content, key, place) when ``whole``."""
    names = ["anchor", "content", "key", "place"] if whole else ["anchor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, keys = [], []
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, _, sums = word_sums(np.frombuffer(t.as_buffer(), np.uint8))
                if len(sums) > length:
                    parts.append(bundles(sums, length, gram))
                    keys.append(np.full(len(parts[-1][0]), key))
            if parts:
                anchor, content, place = (np.concatenate([p[k] for p in parts]) for k in range(3))
                yield _batch(names, [anchor, content, np.concatenate(keys), place][: len(names)])

    return bodies.select("key", "t").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def zipped(bodies: DataFrame, *further: str) -> DataFrame:
    """Texts compressed for the shuffle, with the key and ``further`` columns of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pack.compress(t.as_buffer()) for t in batch.column(0)], pa.binary()), *batch.columns[1:]], names=["z", "key", *further])

    return bodies.select("t", "key", *further).mapInArrow(run, "z binary, key bigint" + "".join(f", {c} bigint" for c in further))


def _mark(*columns: str | Column) -> Column:
    """32 bits of a hash of coordinates; their sum over the places of a chain does not depend on the order."""
    return F.xxhash64(*columns).bitwiseAND(0xFFFFFFFF)


def counted_bundles(bodies: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Bundles with an anchor that occurs again, as places, and by content.

    By content: places (n), windows, the first place (key, at), order-free sums over where the places begin
    and where they end, and whether the anchor has other bundles (open).
    """
    again = _anchor_rows(bodies, length, gram, whole=False).groupBy("anchor").count().filter("count > 1").select("anchor")
    places = materialize(_anchor_rows(bodies, length, gram, whole=True).join(materialize(again, "anchors"), "anchor", "left_semi"), "bundle-places")
    at, windows = F.shiftright("place", _BITS), F.col("place").bitwiseAND(_MASK)
    by_content = places.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.first(windows).alias("windows"), *_first_place("key", at),
        F.sum(_mark("key", at)).alias("begins"), F.sum(_mark("key", at + windows)).alias("ends"))
    by_content = materialize(by_content.withColumn("at", _word("first")).drop("first"), "bundles")
    # A written table, so that the planner can split the rows of an anchor with very many bundles.
    forms = materialize(by_content.groupBy("anchor").agg((F.count("*") > 1).alias("open")), "anchor-forms")
    return places, by_content.join(forms, "anchor")


def _first_place(key: str, at: Column) -> list[Column]:
    """Aggregates for the first place: ordered by part of a hash of the key, then by word, in one number, as only
    numbers are aggregated by hashing. The order of keys does not matter as long as it is one."""
    order = F.shiftleft(F.xxhash64(key).bitwiseAND((1 << 35) - 1), 28).bitwiseOR(at)
    return [F.min_by(key, order).alias("key"), F.min(order).alias("first")]


def _word(first: str) -> Column:
    return F.col(first).bitwiseAND((1 << 28) - 1)


_EDGE = ["anchor", "content", "offset", "edge", "n", "before", "after", "key", "at"]


def opened(bundles: DataFrame, bodies: DataFrame, length: int) -> DataFrame:
    """The edges of bundles, read from the text at the first place of each: a row per edge, with its neighbours in the bundle (0: none)."""
    lists = bundles.groupBy("key").agg(F.collect_list(F.struct("anchor", "content", "at", "windows", "n")).alias("b"))
    both = lists.join(zipped(bodies), "key").select("key", "b.anchor", "b.content", "b.at", "b.windows", "b.n", "z")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for k, (key, z) in enumerate(zip(batch.column(0).to_pylist(), batch.column(6))):
                anchor, content, at, windows, n = (batch.column(c)[k].values.to_numpy() for c in range(1, 6))
                _, _, sums = word_sums(np.frombuffer(unpack.decompress(z.as_buffer()), np.uint8))
                which = np.repeat(np.arange(len(at)), windows)
                offset = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
                starts = at[which] + offset
                edge = span_hash(sums, starts, starts + length)
                before, after = np.roll(edge, 1), np.roll(edge, -1)
                before[offset == 0] = 0
                after[offset == windows[which] - 1] = 0
                yield _batch(_EDGE, [anchor[which], content[which], offset, edge, n[which], before, after, np.full(len(which), key), starts])

    return both.mapInArrow(run, ", ".join(f"{c} bigint" for c in _EDGE))


def _only(column: str) -> Column:
    """The one value that all rows have, if it is one and not 0."""
    return F.when((F.min(column) == F.max(column)) & (F.min(column) != 0), F.min(column))


def path_spans(bodies: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, start, end, path): every place of every path, in words."""
    places, by_content = counted_bundles(bodies, length, gram)
    by_content = materialize(by_content, "counted-bundles")
    rows = materialize(opened(by_content.filter("open"), bodies, length), "edges")
    edges = rows.groupBy("anchor", "edge").agg(F.sum("n").alias("n"), _only("before").alias("before"), _only("after").alias("after"), *_first_place("key", F.col("at"))).filter("n > 1")
    edges = edges.select("anchor", F.col("edge").alias("id"), F.lit(True).alias("open"), "key", _word("first").alias("at"), F.lit(1).cast("bigint").alias("windows"),
                         F.when(F.col("before").isNotNull(), F.xxhash64("before", "edge")).alias("entry"), F.when(F.col("after").isNotNull(), F.xxhash64("edge", "after")).alias("exit"))
    chains = by_content.filter("NOT open").select("anchor", F.col("content").alias("id"), "open", "key", "at", "windows", F.xxhash64("begins", "n").alias("entry"), F.xxhash64("ends", "n").alias("exit"))
    parts = materialize(chains.unionByName(edges), "parts")
    # A part is no head when one ends where it begins, at a vertex without a branch.
    before = parts.filter("exit IS NOT NULL").select("key", (F.col("at") + F.col("windows")).alias("at"), F.col("exit").alias("entry"), F.lit(False).alias("head"))
    linked = parts.join(before, ["key", "at", "entry"], "left").withColumn("head", F.coalesce("head", F.lit(True)))
    numbered = linked.withColumn("path", F.sum(F.col("head").cast("int")).over(Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    total = F.sum("windows").over(Window.partitionBy("key", "path"))
    heads = materialize(numbered.withColumn("windows", total).filter("head").select("anchor", "id", "open", "windows", F.xxhash64("anchor", "id").alias("path")), "paths")
    ways = heads.filter("NOT open").select("anchor", F.col("id").alias("content"), F.lit(0).cast("bigint").alias("offset"), "windows", "path")
    inside = rows.select("anchor", "content", "offset", F.col("edge").alias("id")).join(heads.filter("open"), ["anchor", "id"])
    ways = ways.unionByName(inside.select("anchor", "content", "offset", "windows", "path"))
    found = places.select("anchor", "content", "key", F.shiftright("place", _BITS).alias("at")).join(ways, ["anchor", "content"])
    start = F.col("at") + F.col("offset")
    return found.select("key", start.alias("start"), (start + F.col("windows") + (length - 1)).alias("end"), "path")


_CUT = "doc bigint, kept binary, n_words bigint, n_removed bigint, start array<bigint>, end array<bigint>, path array<bigint>, digest array<bigint>, key bigint"


def _cut(bodies: DataFrame, spans: DataFrame) -> DataFrame:
    """Per document the words outside of the spans, joined by one space and compressed, and the spans with digests of their words."""
    lists = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end", "path")).alias("s"))
    both = zipped(bodies, "doc").join(lists, "key", "left").select("doc", "z", "s.start", "s.end", "s.path", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(3), zstandard.ZstdDecompressor()
        for batch in batches:
            kept, sizes, removed, digests = [], [], [], []
            for z, starts, ends in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = unpack.decompress(z.as_buffer()).split()
                sizes.append(len(words))
                digests.append([int.from_bytes(hashlib.blake2b(b" ".join(words[a:b]), digest_size=8).digest(), "little", signed=True) for a, b in zip(starts or [], ends or [])])
                left, upto = [], 0
                for a, b in sorted(zip(starts or [], ends or [])):
                    left += words[upto:a]
                    upto = max(upto, b)
                left += words[upto:]
                removed.append(len(words) - len(left))
                kept.append(pack.compress(b" ".join(left)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), *[batch.column(k) for k in (2, 3, 4)],
                pa.array(digests, pa.list_(pa.int64())), batch.column(5)], names=["doc", "kept", "n_words", "n_removed", "start", "end", "path", "digest", "key"])

    return both.mapInArrow(run, _CUT)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, kept (the remaining words), n_words, n_removed and spans (start, end, path; in words) of every row of ``docs``."""
    doc, t = F.col(f"`{doc_id}`").cast("bigint"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    alike = not docs.groupBy(doc).count().filter("count > 1").isEmpty()
    key = F.xxhash64(doc, t) if alike else F.coalesce(doc, F.lit(NULL_ID))
    bodies = docs.select(doc.alias("doc"), key.alias("key"), t.cast("binary").alias("t"))
    cut = materialize(_cut(bodies, path_spans(bodies, length, gram).distinct() if alike else path_spans(bodies, length, gram)), "cut")
    seen = cut.select("key", F.explode(F.arrays_zip("start", "end", "path", "digest")).alias("s")).select("key", "s.*")
    alone = materialize(seen.groupBy("path", "digest").count().filter("count = 1").select("path", "digest"), "unverified")
    if not alone.isEmpty():
        cut = materialize(_cut(bodies, seen.join(alone, ["path", "digest"], "left_anti").select("key", "start", "end", "path").distinct()), "cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            kept = pa.array([unpack.decompress(z.as_buffer()).decode() for z in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), kept, *batch.columns[2:]], names=["doc_id", "kept", "n_words", "n_removed", "start", "end", "path"])

    out = cut.select("doc", "kept", "n_words", "n_removed", "start", "end", "path").mapInArrow(
        run, "doc_id bigint, kept string, n_words bigint, n_removed bigint, start array<bigint>, end array<bigint>, path array<bigint>")
    return out.select("doc_id", "kept", "n_words", "n_removed", F.coalesce(F.arrays_zip("start", "end", "path"), F.array().cast("array<struct<start:bigint,end:bigint,path:bigint>>")).alias("spans"))
