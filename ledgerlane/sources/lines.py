"""Whole lines with exact line numbers, numbered in parallel.

Spark reads a file in blocks. Inside a block ``row`` grows by one per line, so a line number is
the distance from the first line of the block plus the lines of the earlier blocks of the file.
The per-block table is the only thing that is ordered per file; it has one row per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize


def raw_lines(spark: SparkSession, path: str | list[str], line_sep: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Each line as one column, header included, with its file, block and running row id."""
    reader = spark.read.option("encoding", encoding)
    return reader.text(path, lineSep=line_sep).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )


def block_index(lines: DataFrame) -> DataFrame:
    """One row per block: id of its first row, lines in it and lines before it. Written once."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("lines_in"))
    return materialize(blocks.withColumn("lines_before", F.coalesce(F.sum("lines_in").over(earlier), F.lit(0))), "blocks")


def place_lines(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Add ``line_no`` (1-based) to rows that carry file, block and row.

    A row whose block is not in the index means the files were cut differently in two scans;
    that is an error, never a lost row.
    """
    known = F.col("lines_before").isNotNull()
    number = F.col("lines_before") + F.col("row") - F.col("first_row") + 1
    return (
        rows.join(index, ["file", "block"], "left")
        .withColumn("line_no", F.when(known, number).otherwise(F.raise_error(F.lit("block missing in line index")).cast("bigint")))
        .drop("block", "row", "first_row", "lines_in", "lines_before")
    )


def line_slice(spark: SparkSession, path: str | list[str], offset: int, limit: int) -> DataFrame:
    """Lines ``offset + 1`` to ``offset + limit`` of every file.

    Only the blocks that overlap the slice take part in the join.
    """
    lines = raw_lines(spark, path)
    index = block_index(lines)
    wanted = index.filter((F.col("lines_before") < offset + limit) & (F.col("lines_before") + F.col("lines_in") > offset))
    inside = lines.join(wanted.select("file", "block"), ["file", "block"], "left_semi")
    return place_lines(inside, wanted).filter((F.col("line_no") > offset) & (F.col("line_no") <= offset + limit))
