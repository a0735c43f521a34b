"""Exact distinct counts without expanding rows.

``count(DISTINCT a), count(DISTINCT b)`` in one aggregation makes Spark write every row once per counted column. Here every column is counted by
itself, from a scan that reads only it and the keys: whole numbers as bitmaps, of which a task sends one per group and
stretch of 32,768 numbers instead of the numbers, other types as their distinct values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType


def distinct_count(df: DataFrame, keys: list[str], column: str, name: str, bitmaps: bool | None = None) -> DataFrame:
    """keys and the number of distinct values of ``column``, NULL not counted; groups without a value have 0.

    ``bitmaps`` decides the way; by default whole numbers go by bitmaps, which suits ids that lie close together.
    """
    rows = df.select(*keys, F.col(column).alias("__v"))
    if bitmaps is None:
        bitmaps = isinstance(rows.schema["__v"].dataType, IntegralType)
    if bitmaps:
        number = F.col("__v").cast("bigint")
        placed = rows.select(*keys, F.bitmap_bucket_number(number).alias("__bucket"), F.bitmap_bit_position(number).alias("__bit"))
        # A NULL value keeps its group, with a bitmap of nothing.
        maps = placed.groupBy(*keys, "__bucket").agg(F.bitmap_count(F.bitmap_construct_agg("__bit")).alias("__n"))
        return maps.groupBy(*keys).agg(F.sum("__n").alias(name))
    return rows.distinct().groupBy(*keys).agg(F.count("__v").alias(name))


def distinct_counts(df: DataFrame, keys: list[str], columns: dict[str, str], bitmaps: bool | None = None) -> DataFrame:
    """keys and, for every (name, column), the number of distinct values."""
    parts = [distinct_count(df, keys, column, name, bitmaps) for name, column in columns.items()]

    def both(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        return left.join(right, same).drop(*[f"__{k}" for k in keys])

    return reduce(both, parts)
