"""Joins that stay even when one key holds a large part of the rows.

Nothing here hints a broadcast. A small side is broadcast by the planner, which knows its size
(``spark.sql.autoBroadcastJoinThreshold``). Beyond that there are three cases:

* rows per key are few by construction (both sides aggregated to about the key): plain join, which
  reuses the partitioning of the aggregation;
* both sides come straight from a shuffle and nothing downstream needs their partitioning: plain
  join, adaptive execution splits a hot key (``spark.sql.adaptive.skewJoin``);
* a hot key meets a side that was aggregated on that key, where adaptive execution cannot split:
  ``spread_join``, with every key spread when the other side is small next to the rows, or with
  only the hot keys spread when it is not.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

FAN_OUT = 16
HOT_ROWS = 5_000_000
_SALT = "__salt"


def planned_size(df: DataFrame) -> int | None:
    """The planner's size estimate in bytes, None where the session does not expose it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # a remote session has no local plan
        return None


def fits_broadcast(df: DataFrame) -> bool:
    """True when the planner itself will broadcast this side."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    text = limit.lower().rstrip("b")
    bytes_limit = int(text[:-1]) * units[text[-1]] if text[-1:] in units else int(text)
    size = planned_size(df)
    return size is not None and 0 <= size <= bytes_limit


def spread_join(
    large: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: list[str] | None = None,
    fan_out: int = FAN_OUT,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join of a large, possibly skewed side with a smaller one.

    ``how`` is inner, left, left_semi or left_anti. When ``dim`` fits a broadcast it is a plain
    join. Otherwise rows of ``large`` get a salt from their own values (so a recomputed task gives
    the same salt) and ``dim`` is repeated once per salt: a key that holds a third of the rows is
    handled by ``fan_out`` tasks. With ``hot``, a small table of keys, only those keys are salted
    and repeated; see ``hot_keys``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join does not do {how!r}")
    if fits_broadcast(dim):
        return large.join(dim, on, how)
    spread_by = spread_by or [c for c in large.columns if c not in on] or on
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(fan_out)).cast("int")
    last = F.lit(fan_out - 1)
    if hot is not None:
        mark = hot.select(*on, F.lit(True).alias("__hot"))
        large, dim = large.join(mark, on, "left"), dim.join(mark, on, "left")
        salt = F.when(F.col("__hot"), salt).otherwise(F.lit(0))
        last = F.when(F.col("__hot"), last).otherwise(F.lit(0))
    salted = large.withColumn(_SALT, salt).drop("__hot")
    repeated = dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0), last))).drop("__hot")
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def hot_keys(counts: DataFrame, on: list[str], count: str = "n", min_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``min_rows`` rows, from a written table of counts; None when there are none.

    At most total rows / ``min_rows`` keys can qualify. The result is written, so the planner sees
    its true size when it decides about a broadcast.
    """
    known = reduce(and_, (F.col(c).isNotNull() for c in on))
    hot = counts.filter((F.col(count) > min_rows) & known).select(*on)
    return None if hot.isEmpty() else materialize(hot, "hot-keys")


def key_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Rows per key. Combined before the shuffle, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rows_without_parent(child: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``child`` whose key has no parent; a NULL key has none.

    Both sides reach the join straight from their shuffle, so adaptive execution can split a key
    that many child rows share. Repeated parent keys do no harm.
    """
    return child.join(parent.select(*on), on, "left_anti")


def keys_without_parent(child: DataFrame, parent: DataFrame, on: list[str], count: str = "n") -> DataFrame:
    """Distinct child keys without a parent, with their number of rows.

    Both sides are reduced to their keys before the shuffle and the join reuses that partitioning.
    """
    return rows_without_parent(key_counts(child, on, count), parent.select(*on).distinct(), on)


def rows_not_in(child: DataFrame, key: str, parent: DataFrame, parent_key: str, distinct_parent: bool = False) -> DataFrame:
    """SQL ``key NOT IN (SELECT parent_key ...)`` without sending the parent to every task.

    ``distinct_parent`` suits a child that has one row per key already. Three rules: a NULL child key is not kept; one NULL among the parent keys empties the
    result; an empty parent keeps every row, NULL keys too.
    """
    parents = parent.select(F.col(parent_key).alias(key))
    # Two numbers about the parent, computed once as scalar subqueries.
    n_parents = parents.agg(F.count(F.lit(1))).scalar()
    n_null_parents = parents.agg(F.count_if(F.col(key).isNull())).scalar()
    known = parents.filter(F.col(key).isNotNull())
    left_over = rows_without_parent(child, known.distinct() if distinct_parent else known, [key])
    return left_over.filter((n_parents == 0) | ((n_null_parents == 0) & F.col(key).isNotNull()))


def with_group_total(df: DataFrame, value: str, keys: list[str], name: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Join detail rows back to the total of their group (rows with a NULL key drop out).

    The totals are aggregated first (combined before the shuffle) and written, together with the
    group sizes; groups above ``min_rows`` are then joined in several tasks, where a window would
    gather each of them in one.
    """
    totals = materialize(df.groupBy(*keys).agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("__n")), "totals")
    hot = hot_keys(totals, keys, "__n", min_rows)
    totals = totals.drop("__n")
    return df.join(totals, keys) if hot is None else spread_join(df, totals, keys, hot=hot)


def join_on_expression(large: DataFrame, large_key: Column, dim: DataFrame, dim_key: Column, how: str = "inner") -> DataFrame:
    """Equi join on a computed key; the key is computed once per side and then dropped.

    ``dim`` should have few rows per key: aggregate it to the key first when only totals matter.
    """
    name = "__join_key"
    spread_by = large.columns
    return spread_join(large.withColumn(name, large_key), dim.withColumn(name, dim_key), [name], how, spread_by).drop(name)
