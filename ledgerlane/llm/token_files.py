"""Token ids in files of bit planes.

``write_tokens`` encodes texts and writes one file per range of document ids; ``read_documents``
reads files back. A file holds blocks of a fixed number of ids. A block is turned by 90 degrees:
plane k has bit k of every id, so that slowly changing high bits become long runs; each plane is
compressed by itself and left out when it has no bit set. The index at the end of the file has the
place of every plane, so single blocks can be read.

Layout (little endian): ``MAGIC``, planes of block 0, planes of block 1, ..., index (compressed),
length of the index as 8 bytes, ``MAGIC``. The index is, as 64-bit numbers: ids per block, number of ids,
number of documents, document ids (``NO_ID`` for NULL), ids per document, then for each block its
offset and 32 plane lengths.

A task writes under a name of its own and the file counts only when the task's row has arrived in
the written manifest, so that a repeated or lost task leaves no half a file in use. NULL and empty
texts are documents of the end id alone. Rows that share a document id stay next to each other, in
the order of their texts; NULL ids come first. An empty table gives no files.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array as pack
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize, workspace
from .caches import WordCache, slices

MAGIC = b"BITPLANE"
BLOCK_IDS = 1 << 16
NO_ID = -(1 << 63)
MANIFEST = "file string, first_id bigint, n_docs bigint, n_ids bigint"


def to_planes(ids: np.ndarray) -> list[bytes]:
    """32 packed bit planes of ids, b"" for a plane without bits."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    raw = ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    bits = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1)
    return [plane.tobytes() if plane.any() else b"" for plane in bits] + [b""] * (32 - 8 * width)


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of ``n`` places back from their planes."""
    width = 4 if any(planes[16:]) else 2
    bits = np.zeros((8 * width, (n + 7) // 8), np.uint8)
    for k, plane in enumerate(planes[: 8 * width]):
        if plane:
            bits[k] = np.frombuffer(plane, np.uint8)
    raw = np.packbits(np.unpackbits(bits, axis=1, count=n).T, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view(f"<u{width}").ravel().astype(np.uint32)


class TokenWriter:
    """Writes one file, block by block; holds one block and the document index."""

    def __init__(self, sink, block_ids: int = BLOCK_IDS, level: int = 3):
        self.sink, self.block_ids, self.zip = sink, block_ids, zstandard.ZstdCompressor(level)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.docs: list[int] = []
        self.lengths: list[int] = []
        self.places: list[int] = []
        self.at = len(MAGIC)
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block_ids:
            rest = np.concatenate(self.waiting)
            whole = len(rest) // self.block_ids * self.block_ids
            for k in range(0, whole, self.block_ids):
                self._block(rest[k : k + self.block_ids])
            self.waiting, self.n_waiting = [rest[whole:]], len(rest) - whole

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.zip.compress(p) if p else b"" for p in to_planes(ids)]
        self.places += [self.at, *map(len, packed)]
        body = b"".join(packed)
        self.sink.write(body)
        self.at += len(body)
        self.n_ids += len(ids)

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        numbers = [self.block_ids, self.n_ids, len(self.docs), *self.docs, *self.lengths, *self.places]
        index = self.zip.compress(np.array(numbers, "<i8").tobytes())
        self.sink.write(index + len(index).to_bytes(8, "little") + MAGIC)
        self.sink.close()


class TokenReader:
    """Reads one file; ``documents`` gives (doc_id, ids) in file order with one block in memory."""

    def __init__(self, source):
        self.source, self.unzip = source, zstandard.ZstdDecompressor()
        size = source.size()
        source.seek(size - 16)
        tail = source.read(16)
        source.seek(0)
        if tail[8:] != MAGIC or source.read(8) != MAGIC:
            raise ValueError("not a token file")
        length = int.from_bytes(tail[:8], "little")
        source.seek(size - 16 - length)
        numbers = np.frombuffer(self.unzip.decompress(source.read(length)), "<i8")
        self.block_ids, self.n_ids, n = (int(x) for x in numbers[:3])
        self.docs, self.lengths = numbers[3 : 3 + n], numbers[3 + n : 3 + 2 * n]
        self.places = numbers[3 + 2 * n :].reshape(-1, 33)

    def block(self, k: int) -> np.ndarray:
        self.source.seek(int(self.places[k, 0]))
        planes = [self.unzip.decompress(self.source.read(int(m))) if m else b"" for m in self.places[k, 1:]]
        return from_planes(planes, min(self.block_ids, self.n_ids - k * self.block_ids))

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        k, have, used = 0, np.empty(0, np.uint32), 0
        for doc, n in zip(self.docs.tolist(), self.lengths.tolist()):
            parts = [have[used : used + n]]
            used, missing = used + n, n - len(parts[0])
            while missing:
                have, k = self.block(k), k + 1
                parts.append(have[:missing])
                used, missing = len(parts[-1]), missing - len(parts[-1])
            yield None if doc == NO_ID else doc, np.concatenate(parts)


# Words remembered per worker and generation, at some 200 bytes each.
KEPT_WORDS = 1_000_000
# Text encoded at a time.
SLICE_BYTES = 4 << 20


def encode_texts(texts: pa.Array, encoder: WordCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and where those of each text end.

    Words are cut at ASCII white space and made distinct in Arrow, so the cache sees every word of a slice once. A-Z are lowered as the tokenizer
    does, but not in texts that may hold special tokens, which keep their case.
    """
    special = pc.match_substring(texts, "<|")
    words = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
    distinct = words.flatten().dictionary_encode()
    ids = encoder.get(distinct.dictionary.cast(pa.binary()).to_pylist())
    sizes = np.array([len(i) >> 2 for i in ids], np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4")))
    order = distinct.indices
    upto = np.concatenate([[0], np.cumsum(sizes[order.to_numpy()])]) if len(order) else np.zeros(1, np.int64)
    ends = words.offsets.to_numpy()
    return lists.take(order).flatten().to_numpy(), upto[ends - ends[0]]


def word_encoder(path: str) -> WordCache:
    """Words to their ids as bytes. The tokenizer drops white space, lowers letters and never joins across white space, so a
    text's ids are those of its words, one after the other. It never joins a letter with a full stop or
    a comma either, so a word and the same word before such an ending are encoded once."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    endings = {e: np.array(tokenizer.encode(e.decode(), add_special_tokens=False).ids, "<u4").tobytes() for e in (b".", b",")}

    def encode(words: list[bytes]) -> list[bytes]:
        known = cache.known
        bare = [w[:-1] if w[-1:] in endings and b"a" <= w[-2:-1] <= b"z" else w for w in words]
        new = list({b for b in bare if b not in known})
        found = dict(zip(new, [pack("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)]))
        if max(map(len, new), default=0) <= 200:
            known.update(found)
            found = known
        return [(found[b] if b in found else known[b]) + (endings[w[-1:]] if len(b) < len(w) else b"") for w, b in zip(words, bare)]

    cache = WordCache.of(("ids", path), encode, KEPT_WORDS)
    return cache


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS) -> tuple[DataFrame, str]:
    """Encode every text, append ``end_id``, write files by ascending ``doc_id``; the manifest and the folder."""
    folder = workspace(docs.sparkSession, "token-files")
    body = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    ordered = body.repartitionByRange("id").sortWithinPartitions("id", "t")
    end = np.uint32(end_id)

    def write(batches):
        encoder = writer = first = None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo, hi in slices(pc.binary_length(texts).to_pylist(), SLICE_BYTES):
                if writer is None:
                    # The tasks of a stage take all cores; the library's own threads would only be more of them.
                    os.environ["TOKENIZERS_PARALLELISM"] = "false"
                    encoder, first = word_encoder(tokenizer_path), ids[0]
                    store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
                    store.create_dir(base)
                    name = f"{uuid.uuid4().hex}.tok"
                    writer = TokenWriter(store.open_output_stream(f"{base}/{name}", compression=None), block_ids)
                found, ends = encode_texts(texts.slice(lo, hi - lo), encoder)
                for i, start, stop in zip(ids[lo:hi], ends[:-1], ends[1:]):
                    writer.add(i, np.append(found[start:stop], end))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "first_id": [first], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]},
                                             schema=pa.schema([("file", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return materialize(ordered.mapInArrow(write, MANIFEST), "token-manifest"), folder


def read_documents(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the files.

    Only the manifest, a row per file, goes through one task, to add up the ids before each file.
    """
    before = F.sum("n_ids").over(Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", F.coalesce(before, F.lit(0)).alias("start"), "n_ids")
    n = max(1, spark.sparkContext.defaultParallelism)
    files = files.repartition(n * 4)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
                with store.open_input_file(f"{base}/{name}") as source:
                    found = [(d, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, ids in TokenReader(source).documents()]
                lengths = [n for _, n, _ in found]
                starts = list(accumulate([start, *lengths]))[:-1]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array([f[2] for f in found], pa.int64())], schema=schema)

    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
