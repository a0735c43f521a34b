"""File listings and JSON array files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .blocks import JsonElements, cut_files


def list_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """path, length, modificationTime of all files below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "length", "modificationTime")
    )
    return files if pattern is None else files.filter(F.col("path").rlike(pattern))


def read_json_array(spark: SparkSession, path: str | list[str], whole_files: bool = True) -> DataFrame:
    """One variant row per element of files whose top level is an array; a file that is one object gives one row.

    Large files are cut into elements by many tasks (see ``blocks``); only texts of single elements are parsed. An element that
    is no JSON, or an array without an end, fails the job. With ``whole_files=False`` every line is an array of its own.
    """
    if not whole_files:
        return spark.read.text(path).select(F.explode(F.from_json("value", "array<variant>")).alias("v"))
    units = cut_files(spark, path, JsonElements())
    opened = F.regexp_replace("text", r"^[\uFEFF\s]*\[", "")
    text = F.when(F.col("first") == 1, opened).otherwise(F.col("text"))
    closed = F.when(F.col("ends_file") & ~((F.col("first") == 1) & (opened == F.col("text"))), F.regexp_replace(text, r"\]\s*$", "")).otherwise(text)
    return units.select(closed.alias("t")).filter(F.trim(F.regexp_replace("t", r"\s", " ")) != "").select(F.parse_json("t").alias("v"))
