"""Pivots and ordered text lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import percent


def fixed_pivot(df: DataFrame, keys: list[str], column: str, values: dict[str, str], total: Column, other: str | None = None) -> DataFrame:
    """Conditional sums: one column per listed value, an optional rest column, and the total.

    ``values`` maps a value of ``column`` to the output name. NULL values count in the total
    only. One aggregation, combined before the shuffle.
    """
    cells = [F.coalesce(F.sum(F.when(F.col(column) == v, total)), F.lit(0)).alias(n) for v, n in values.items()]
    if other:
        cells.append(F.coalesce(F.sum(F.when(~F.col(column).isin(*values), total)), F.lit(0)).alias(other))
    return df.groupBy(*keys).agg(*cells, F.sum(total).alias("total"))


def max_pivot(df: DataFrame, keys: list[str], column: str, values: dict[str, str], cell: str) -> DataFrame:
    """One column per listed value with the greatest cell, NULL where there is none."""
    cells = [F.max(F.when(F.col(column) == v, F.col(cell))).alias(n) for v, n in values.items()]
    return df.groupBy(*keys).agg(*cells)


def distinct_values(df: DataFrame, column: str, limit: int | None = None) -> list[str]:
    """The values that become columns. A caller may give a ``limit``; a wider pivot is then refused, not cut."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct()
    found = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values, too many for columns")
    return sorted(r[0] for r in found)


def share_rows(df: DataFrame, keys: list[str], column: str, cell: str, places: int = 2) -> DataFrame:
    """The shares of ``share_pivot`` as rows (keys, column, share): needs no list of values, whatever their number."""
    sums = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.sum(cell).alias("__sum"))
    totals = sums.groupBy(*keys).agg(F.sum("__sum").alias("__total"))
    return sums.join(totals, keys).select(*keys, column, percent(F.col("__sum"), "__total", places).alias("share"))


def share_pivot(df: DataFrame, keys: list[str], column: str, cell: str, values: list[str] | None = None, places: int = 2) -> DataFrame:
    """Pivot on every value, empty cells 0, each cell in percent of the row total."""
    values = distinct_values(df, column) if values is None else values
    sums = [F.coalesce(F.sum(F.when(F.col(column) == v, F.col(cell))), F.lit(0)).alias(v) for v in values]
    wide = df.filter(F.col(column).isNotNull()).groupBy(*keys).agg(*sums, F.sum(cell).alias("__total"))
    return wide.select(*keys, *[percent(F.col(f"`{v}`"), "__total", places).alias(v) for v in values])


def text_list(df: DataFrame, keys: list[str], value: str, name: str, separator: str = ", ") -> DataFrame:
    """Distinct values of each group, ordered, joined into one text.

    Values are made distinct and range-sorted over all tasks first; every task then joins only
    its own stretch of a group, and the last step sees one text per stretch. A group that holds
    a third of the values is therefore sorted by many tasks, not by one.
    """
    distinct = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    stretches = (
        distinct.repartitionByRange(*keys, value)
        .withColumn("__stretch", F.spark_partition_id())
        .groupBy(*keys, "__stretch")
        .agg(F.array_join(F.array_sort(F.collect_list(value)), separator).alias("__text"))
    )
    whole = F.array_sort(F.collect_list(F.struct("__stretch", "__text")))
    return stretches.groupBy(*keys).agg(F.array_join(F.transform(whole, lambda s: s["__text"]), separator).alias(name))
