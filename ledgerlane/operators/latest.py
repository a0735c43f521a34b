"""Latest row per key, and the best k rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _ordering(order: list[Column | str]) -> list[Column]:
    return [o if isinstance(o, Column) else F.col(o).desc() for o in order]


def top_per_key(df: DataFrame, keys: list[str], order: list[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of every key.

    The rank filter lets the planner keep only k rows per key in every task before the shuffle
    (window group limit), so a hot key never travels whole. ``order`` must be a full tie-break
    when the result has to be the same on every run; plain names sort descending.
    """
    window = Window.partitionBy(*keys).orderBy(*_ordering(order))
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= k).drop("__rank")


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the greatest by ``order``."""
    return top_per_key(df, keys, order, 1)
