"""Load new delimited files once each, with the error handling of the batch loader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.delimited import CsvFormat, Field, LOADED, good_rows, load_report, tag_rows


def start(query, trigger: dict | None) -> StreamingQuery:
    """Start a writer. Default trigger: take what is there, then stop."""
    return query.trigger(**(trigger or {"availableNow": True})).start()


def load_new_files(
    spark: SparkSession,
    path: str,
    spec: Sequence[Field],
    table_path: str,
    log_path: str,
    checkpoint: str,
    table: str,
    fmt: CsvFormat = CsvFormat(),
    trigger: dict | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Append the good rows of every new file and log one row per file.

    The stream gives the names of new files only; a micro-batch, of at most ``max_files`` files, then loads them as the batch loader does. The
    checkpoint remembers which files were taken. Each micro-batch writes folders of its own
    number, so a batch that is repeated after a failure replaces itself.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", max_files).load(path).select("path")

    def write(batch: DataFrame, batch_id: int) -> None:
        names = [r.path for r in batch.distinct().collect()]
        if not names:
            return
        tagged = tag_rows(spark, names, spec, fmt)
        good_rows(tagged).write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
        load_log(load_report(tagged), table).write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    writer = files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return start(writer, trigger)


def load_log(report: DataFrame, table: str) -> DataFrame:
    """Log rows of a daily load from its report: files that loaded without any error."""
    return report.filter(F.col("status") == LOADED).select(
        F.lit(table).alias("table_name"),
        F.lit("DAILY_LOAD").alias("check_type"),
        F.lit("SUCCESS").alias("check_result"),
        F.col("row_count").alias("affected_rows"),
        F.concat(F.lit("Loaded from file: "), F.col("file_name")).alias("details"),
    )
