"""Registration of queries and of the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .roles import Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Plain column types, equal in every engine: decimals as double, dates and times as text."""
    columns = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        columns.append(col.alias(f.name))
    return df.select(*columns)


def query(key: str, sql: str | None = None) -> Callable:
    """Register ``fn(roles) -> DataFrame`` under ``key``, with its SQL twin if there is one."""

    def register(fn: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: plain(fn(Roles(spark, sf_dir)))
        if sql is not None:
            SQL[key] = sql.strip()
        return fn

    return register
