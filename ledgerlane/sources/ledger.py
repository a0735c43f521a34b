"""Loading every file once, with a ledger of the files that were loaded.

A file is known by its path, size, time and a digest of its lines. A load has an id: its rows and its ledger entries lie in folders
of that id, the entries written last, so a load that is repeated under its id replaces itself, and rows of a load
that never got to its entries are not read. A file that is in the ledger already is not loaded again; one that has other content
under a known path is reported and left out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.latest import latest_per_key
from ..operators.tables import read_or_empty
from ..session import materialize
from .blocks import read_pieces
from .delimited import CONTINUE, CsvFormat, Field, load_report, load_rows, tag_rows
from .files import list_files

# What became of a file.
NEW, SAME, CHANGED = "NEW", "SAME", "CHANGED"
_ENTRY = ("file string, length long, modified timestamp, digest long, number long, row_parsed long, row_count long, error_count long, "
          "first_error_message string, status string, loaded_at timestamp, load_id string")


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file and a digest of its lines, whatever tasks read them."""
    lines = read_pieces(spark, paths, "\n").withColumn("h", F.xxhash64("piece"))
    sums = lines.groupBy("file").agg(F.count("*").alias("n"), F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("low"), F.sum(F.shiftrightunsigned("h", 32)).alias("high"))
    return sums.select("file", F.xxhash64("n", "low", "high").alias("digest"))


@dataclass
class LoadLedger:
    """Entries of loaded files below ``path``. One load at a time."""

    path: str

    def entries(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.path, _ENTRY)

    def number(self, spark: SparkSession, load_id: str) -> int:
        """The number of a load: its own when it is there already, else the next one."""
        found = self.entries(spark).agg(F.max("number"), F.max(F.when(F.col("load_id") == load_id, F.col("number")))).first()
        return found[1] if found[1] is not None else (found[0] or 0) + 1

    def compare(self, spark: SparkSession, files: DataFrame, load_id: str) -> DataFrame:
        """``files`` (file, length, modified) with their state against the entries of other loads."""
        known = latest_per_key(self.entries(spark).filter(F.col("load_id") != load_id), ["file"], ["number"])
        known = known.select("file", F.col("length").alias("k_length"), F.col("modified").alias("k_modified"), F.col("digest").alias("k_digest"))
        both = materialize(files.join(known, "file", "left"), "files")
        untouched = (F.col("length") == F.col("k_length")) & (F.col("modified") == F.col("k_modified"))
        first = F.when(F.col("k_digest").isNull(), NEW).when(untouched, SAME)
        doubtful = [r.file for r in both.filter(first.isNull()).select("file").collect()]
        if not doubtful:
            return both.select("file", "length", "modified", first.alias("state"))
        digests = file_digests(spark, doubtful)
        state = F.coalesce(first, F.when(F.col("digest") == F.col("k_digest"), SAME).otherwise(CHANGED))
        return both.join(digests, "file", "left").select("file", "length", "modified", state.alias("state"))


def load_new_files(
    spark: SparkSession,
    paths: str | list[str],
    spec: Sequence[Field],
    table: str,
    ledger: LoadLedger,
    load_id: str,
    now: dt.datetime,
    fmt: CsvFormat = CsvFormat(),
    on_error: str = CONTINUE,
    partition_by: Sequence[str] = (),
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Load the files that the ledger does not have; per file its state and, for new ones, the report of the load."""
    listed = list_files(spark, paths).select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    files = materialize(ledger.compare(spark, listed, load_id), "file-states")
    new = [r.file for r in files.filter(F.col("state") == NEW).select("file").collect()]
    number = ledger.number(spark, load_id)
    if not new:
        return files.withColumns({c: F.lit(None).cast("long") for c in ("row_parsed", "row_count", "error_count")}).withColumn("status", F.lit(None).cast("string"))
    tagged = tag_rows(spark, new, spec, fmt)
    rows = load_rows(tagged, on_error).withColumns(extra or {}).write.mode("overwrite")
    (rows.partitionBy(*partition_by) if partition_by else rows).parquet(f"{table}/load_id={load_id}")
    report = load_report(tagged).withColumnRenamed("file_name", "file")
    # A file without rows has an entry as well.
    entries = files.filter(F.col("state") == NEW).join(report, "file", "left").join(file_digests(spark, new), "file", "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("row_parsed", "row_count", "error_count")}
    entries = entries.withColumns({**counts, "digest": F.coalesce("digest", F.lit(0)), "number": F.lit(number).cast("long"), "loaded_at": F.lit(now).cast("timestamp")})
    entries.select(*[c.split()[0] for c in _ENTRY.split(", ")][:-1]).write.mode("overwrite").parquet(f"{ledger.path}/load_id={load_id}")
    return files.join(ledger.entries(spark).filter(F.col("load_id") == load_id).select("file", "row_parsed", "row_count", "error_count", "first_error_message", "status"), "file", "left")


def loaded_rows(spark: SparkSession, table: str, ledger: LoadLedger, load_id: str | None = None) -> DataFrame:
    """Rows of all finished loads, or of one."""
    rows = spark.read.parquet(table)
    done = ledger.entries(spark).select("load_id").distinct()
    rows = rows.withColumn("load_id", F.col("load_id").cast("string")).join(done, "load_id", "left_semi")
    return (rows if load_id is None else rows.filter(F.col("load_id") == load_id)).drop("load_id")
