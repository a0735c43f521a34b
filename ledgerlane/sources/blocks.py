"""Cutting files into units when where a unit ends depends on everything before it.

A quoted field may hold line breaks and a JSON array is one long line, so a reader that starts in the middle of a file cannot
know whether it is inside a string. Files are read in *pieces* ended by a separator, in parallel blocks, and

1. every block is scanned once for every phase it may begin in (outside, inside a string, ...), which gives the
   block's effect: the phase it ends in and by how much it changes the nesting depth;
2. effects are composed in the order of blocks, a row per block, which gives the phase and depth each
   block really begins with;
3. every block is scanned again from there and gives its units; only the pieces at its borders, which belong to units of
   two or more blocks, are put together by a shuffle.

A delimited file may end inside a quoted field. The record with that quote is given with its first line alone, marked as
broken; what follows it in the file is part of it and is not read again. An array file that ends inside an element is an error.

So a file of any size is read by many tasks, and no task holds more than a block's batch and one unit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize

# Blocks whose index is broadcast, at some 100 bytes each; beyond it pieces are dealt by block.
INDEX_BLOCKS = 100_000
_WHOLE, _HEAD, _TAIL, _THROUGH = 0, 1, 2, 3


@dataclass(frozen=True)
class JsonElements:
    """Elements of the top-level array of a file. Phases: outside and inside of a string."""

    separator: str = ","
    phases: int = 2

    def scan(self, pieces: pa.Array, phase: int, depth: int, unit_depth: int) -> tuple[int, int, np.ndarray]:
        """Phase and depth after the pieces, and after which of them a unit ends."""
        first, last = _range(pieces)
        raw = np.frombuffer(pieces.buffers()[2], np.uint8)[first:last] if last > first else np.empty(0, np.uint8)
        ends = _offsets(pieces)[1:] - first
        places = np.arange(len(raw))
        # A quote counts unless an odd number of backslashes stands before it.
        other = np.maximum.accumulate(np.where(raw != 92, places, -1)) if len(raw) else places
        before = np.concatenate([[-1], other[:-1]]) if len(raw) else places
        quotes = (raw == 34) & ((places - 1 - before) % 2 == 0)
        inside = (np.cumsum(quotes) + phase) % 2 == 1
        step = np.where(inside | quotes, 0, np.isin(raw, (91, 123)).astype(np.int64) - np.isin(raw, (93, 125)))
        level = depth + np.cumsum(step)
        at = np.maximum(ends - 1, 0)
        # An empty piece ends as the one before it did.
        in_after = np.where(ends > 0, inside[at], phase == 1) if len(raw) else np.full(len(ends), phase == 1)
        level_after = np.where(ends > 0, level[at], depth) if len(raw) else np.full(len(ends), depth)
        if not len(ends):
            return phase, depth, np.empty(0, bool)
        return int(in_after[-1]), int(level_after[-1]), ~in_after & (level_after == unit_depth)

    def unit_depth(self, start: str) -> int:
        """Commas that end a unit: those right inside the array; none (-1) in a file that is one object or value."""
        return 1 if start.lstrip("﻿ \t\r\n").startswith("[") else -1

    def broken(self, phase: int, depth: int) -> bool:
        return phase != 0 or depth != 0


@dataclass(frozen=True)
class DelimitedRecords:
    """Records of a delimited file. Phases: at the start of a record, inside a quoted field, and inside an
    unquoted field whose line break was escaped."""

    delimiter: str
    quote: str
    escape: str | None  # inside of quotes; a doubled quote counts always
    escape_unenclosed: str | None  # outside of quotes
    separator: str = "\n"
    phases: int = 3

    def line_phase(self, line: str, phase: int) -> int:
        """Phase after a line that begins in ``phase``."""
        quoted, begins, k = phase == 1, phase == 0, 0
        marks = re.compile("[" + re.escape(self.quote + self.delimiter[0] + (self.escape or "") + (self.escape_unenclosed or "")) + "]")
        while (m := marks.search(line, k)) is not None:
            c, at = m.group(), m.start()
            plain = at > k
            k = at + 1
            if quoted:
                if c == self.escape:
                    k += 1
                elif c == self.quote:
                    if line.startswith(self.quote, k):
                        k += 1
                    else:
                        quoted, begins = False, False
            elif c == self.escape_unenclosed:
                if k >= len(line):
                    return 2
                k, begins = k + 1, False
            elif line.startswith(self.delimiter, at):
                k, begins = at + len(self.delimiter), True
            elif c == self.quote and begins and not plain:
                quoted = True
            else:
                begins = False
        return int(quoted)

    def special(self, pieces: pa.Array) -> np.ndarray:
        """Lines that can change the phase."""
        found = pc.match_substring(pieces, self.quote)
        if self.escape_unenclosed:
            found = pc.or_(found, pc.or_(pc.ends_with(pieces, self.escape_unenclosed), pc.ends_with(pieces, self.escape_unenclosed + "\r")))
        return np.flatnonzero(found.to_numpy(zero_copy_only=False))

    def scan(self, pieces: pa.Array, phase: int, depth: int, unit_depth: int) -> tuple[int, int, np.ndarray]:
        cuts, at = np.ones(len(pieces), bool), 0
        for s in [*self.special(pieces).tolist(), len(pieces)]:
            if phase == 1:
                cuts[at:s] = False
            elif s > at:
                phase = 0
            if s < len(pieces):
                line = pieces[s].as_py()
                phase = self.line_phase(line.removesuffix("\r") if phase != 1 else line, phase)
                cuts[s] = phase == 0
            at = s + 1
        return phase, 0, cuts

    def unit_depth(self, start: str) -> int:
        return 0

    def broken(self, phase: int, depth: int) -> bool:
        return phase == 1


def _offsets(pieces: pa.Array) -> np.ndarray:
    return np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)


def _range(pieces: pa.Array) -> tuple[int, int]:
    borders = _offsets(pieces)
    return int(borders[0]), int(borders[-1])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Stretches of a batch that are of one block: (first column, second column, rows)."""
    a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else []
    for lo, hi in zip(starts, [*starts[1:], len(a)]):
        yield int(a[lo]), int(b[lo]), batch.slice(lo, hi - lo)


def read_pieces(spark: SparkSession, paths: str | list[str], separator: str) -> DataFrame:
    """file, block, row and text of every piece; rows of a block follow each other in one task, in order."""
    return spark.read.text(paths, lineSep=separator).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("piece"))


def block_effects(pieces: DataFrame, cutter) -> DataFrame:
    """A row per block: pieces in it, its first text, and per phase it may begin in the phase it ends in, the change of
    depth, and the number of units that end in it."""
    fields = "file_id bigint, block bigint, n bigint, start string, phase array<int>, depth array<bigint>, cuts array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, []

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)], names=["file_id", "block", "n", "start", "phase", "depth", "cuts"])

        for batch in batches:
            for file_id, block, rows in _runs(batch):
                if now is None or now[:2] != [file_id, block]:
                    if now:
                        found.append(now)
                    now = [file_id, block, 0, "", list(range(cutter.phases)), [0] * cutter.phases, [0] * cutter.phases]
                texts = rows.column(2)
                if block == 0 and not now[3].strip():
                    # White space before the array may fill whole pieces.
                    now[3] = next((t for t in texts.to_pylist() if t.strip()), "").lstrip()[:64]
                now[2] += len(texts)
                for p in range(cutter.phases):
                    now[4][p], now[5][p], cuts = cutter.scan(texts, now[4][p], now[5][p], 0)
                    now[6][p] += int(cuts.sum())
            if found:
                yield flush()
                found.clear()
        if now:
            found.append(now)
            yield flush()

    rows = pieces.select(F.xxhash64("file").alias("file_id"), "block", "piece").mapInArrow(run, fields)
    names = pieces.select("file", F.xxhash64("file").alias("file_id")).distinct()
    return rows.join(names, "file_id")


def block_entries(effects: DataFrame, cutter) -> DataFrame:
    """Per block the phase and depth it begins with, the pieces before it, whether a unit begins with it, and how its file ends.

    Composed per file in the order of blocks: a row per block, no text.
    """
    fields = "file string, block bigint, id bigint, phase int, depth bigint, unit_depth int, before bigint, fresh boolean, last boolean, broken boolean, stop boolean, lost boolean"

    def run(frame):
        import pandas as pd

        frame = frame.sort_values("block")
        phase = depth = before = 0
        unit_depth = cutter.unit_depth(next((s for s in frame["start"] if s.strip()), ""))
        out, fresh, stop = [], True, 0
        for k, r in enumerate(frame.itertuples()):
            out.append((r.file, r.block, phase, depth, unit_depth, before, fresh, k == len(frame) - 1))
            stop = k if r.cuts[phase] else stop
            phase, depth, before = int(r.phase[phase]), depth + int(r.depth[phase]), before + r.n
            fresh = phase == 0 and depth == max(unit_depth, 0) and unit_depth >= 0
        found = pd.DataFrame(out, columns=["file", "block", "phase", "depth", "unit_depth", "before", "fresh", "last"])
        found["broken"] = cutter.broken(phase, depth)
        # The last block of a broken file in which a record ends; the open one begins there.
        found["stop"], found["lost"] = found["broken"] & (found.index == stop), found["broken"] & (found.index > stop)
        found["id"] = 0
        return found[["file", "block", "id", "phase", "depth", "unit_depth", "before", "fresh", "last", "broken", "stop", "lost"]]

    return effects.groupBy("file").applyInPandas(run, fields).withColumn("id", F.xxhash64("file", "block"))


def cut_files(spark: SparkSession, paths: str | list[str], cutter, index_blocks: int = INDEX_BLOCKS) -> DataFrame:
    """file, first (1-based number of the unit's first piece), text, ends_file and broken (its file ends within a unit) of every unit."""
    pieces = read_pieces(spark, paths, cutter.separator)
    index = materialize(block_entries(block_effects(pieces, cutter), cutter), "block-entries")
    small = index.count() <= index_blocks
    if isinstance(cutter, JsonElements):
        complaint = F.concat(F.lit("array not closed in "), F.col("file"))
        index = index.filter(F.when(F.col("broken"), F.raise_error(complaint).cast("boolean")).otherwise(F.lit(True)))
    entry = index.filter("NOT lost").select("file", "block", "id", "phase", "depth", "unit_depth", "before", "fresh", "last", "stop")
    placed = pieces.join(F.broadcast(entry) if small else entry, ["file", "block"])
    if not small:
        placed = placed.repartition("id").sortWithinPartitions("id", "row")
    placed = placed.select("id", "before", "phase", "depth", "unit_depth", "fresh", "last", "stop", "piece")
    fields = "id bigint, first bigint, kind int, ends_file boolean, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state, waiting, start, place, open_head, last, stop = None, None, [], 1, 1, False, False, False
        out: list[tuple] = []

        def close(kind: int, ends: bool = False) -> None:
            out.append((block, start, kind, ends, cutter.separator.join(waiting)))
            waiting.clear()

        def finish() -> None:
            """The end of a block: what is left goes on in the next one, or ends with the file."""
            if waiting and stop:
                del waiting[1:]
            if waiting:
                ends = last or stop
                close((_HEAD if open_head else _WHOLE) if ends else (_THROUGH if open_head else _TAIL), ends)

        for batch in batches:
            for key, before, rows in _runs(batch):
                if key != block:
                    if block is not None:
                        finish()
                    phase, depth, unit_depth, fresh, last, stop = (rows.column(k)[0].as_py() for k in range(2, 8))
                    block, state, start, place, open_head = key, (phase, depth), before + 1, before + 1, not fresh
                texts = rows.column(8)
                *state, cuts = cutter.scan(texts, *state, unit_depth)
                texts, at = texts.to_pylist(), 0
                for cut in np.flatnonzero(cuts).tolist():
                    waiting += texts[at : cut + 1]
                    close(_HEAD if open_head else _WHOLE)
                    open_head, at = False, cut + 1
                    start = place + at
                waiting += texts[at:]
                place += len(texts)
            yield _units(out)
            out.clear()
        if block is not None:
            finish()
            yield _units(out)

    def _units(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["id", "first", "kind", "ends_file", "text"])

    names = index.select("id", "file", "block", "broken")
    found = placed.mapInArrow(run, fields).join(F.broadcast(names) if small else names, "id").drop("id")
    whole = found.filter(F.col("kind") == _WHOLE).select("file", "first", "text", "ends_file", "broken")
    # A unit over several blocks begins with a tail; what follows up to the next tail belongs to it.
    number = F.count_if(F.col("kind") == _TAIL).over(Window.partitionBy("file").orderBy("block", "first").rowsBetween(Window.unboundedPreceding, 0))
    parts = found.filter(F.col("kind") != _WHOLE).withColumn("unit", number)
    joined = parts.groupBy("file", "unit").agg(
        F.min("first").alias("first"), F.sort_array(F.collect_list(F.struct("block", "first", "text"))).alias("p"), F.bool_or("ends_file").alias("ends_file"), F.first("broken").alias("broken"))
    return whole.unionByName(joined.select("file", "first", F.array_join(F.transform("p", lambda x: x["text"]), cutter.separator).alias("text"), "ends_file", "broken"))
