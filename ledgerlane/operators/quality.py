"""Quality checks (PASS/FAIL rows for a log) and column metrics (long result rows).

Everything a check needs is aggregated before it is shuffled, so a key or value that fills a
third of a table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import as_column
from ..functions.temporal import elapsed
from .joins import key_counts, keys_without_parent, rows_not_in

# The names that appear in the quality log.
NULL_CHECK, DUPLICATE_CHECK, REFERENCE_CHECK = "NULL_CHECK", "DUPLICATE_CHECK", "REFERENTIAL_INTEGRITY"
PASS, FAIL = "PASS", "FAIL"

LOG_COLUMNS = ["table_name", "check_type", "check_result", "affected_rows", "details"]


def check_row(counts: DataFrame, affected: Column, table: str, check: str, details: str) -> DataFrame:
    """One log row from a one-row DataFrame."""
    n = affected.cast("bigint")
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_type"),
        F.when(n == 0, PASS).otherwise(FAIL).alias("check_result"),
        n.alias("affected_rows"),
        F.lit(details).alias("details"),
    )


def any_null(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def null_check(df: DataFrame, table: str, columns: list[str], details: str | None = None) -> DataFrame:
    """Rows with a NULL in any required column."""
    counts = df.agg(F.count_if(any_null(columns)).alias("n"))
    return check_row(counts, F.col("n"), table, NULL_CHECK, details or f"NULL values found in: {', '.join(columns)}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return key_counts(df, keys).filter(F.col("n") > 1)


def duplicate_check(df: DataFrame, table: str, keys: list[str], details: str | None = None) -> DataFrame:
    """Number of keys (not rows) that occur more than once."""
    counts = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n"))
    return check_row(counts, F.col("n"), table, DUPLICATE_CHECK, details or f"Duplicate {' + '.join(keys)} found")


def fk_check(child: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str, distinct: bool = False, details: str | None = None) -> DataFrame:
    """Child rows, or distinct child keys, without a parent. A NULL key counts as an orphan."""
    parents = parent.select(F.col(parent_key).alias(key))
    orphans = keys_without_parent(child, parents, [key])
    affected = F.count(F.lit(1)) if distinct else F.coalesce(F.sum("n"), F.lit(0))
    counts = orphans.agg(affected.alias("affected"))
    return check_row(counts, F.col("affected"), table, REFERENCE_CHECK, details or f"{table} with non-existent {key}")


def table_checks(df: DataFrame, table: str, required: list[str], keys: list[str]) -> DataFrame:
    """NULL check and duplicate check of one table in one scan and one shuffle."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(any_null(required)).alias("nulls"))
    counts = per_key.agg(F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"), F.count_if(F.col("n") > 1).alias("duplicates"))
    entries = F.array(
        F.struct(F.lit(NULL_CHECK).alias("check_type"), F.col("nulls").alias("n"), F.lit(f"NULL values found in: {', '.join(required)}").alias("details")),
        F.struct(F.lit(DUPLICATE_CHECK).alias("check_type"), F.col("duplicates").alias("n"), F.lit(f"Duplicate {' + '.join(keys)} found").alias("details")),
    )
    return counts.select(F.explode(entries).alias("e")).select(
        F.lit(table).alias("table_name"), F.col("e.check_type"), F.when(F.col("e.n") == 0, PASS).otherwise(FAIL).alias("check_result"),
        F.col("e.n").cast("bigint").alias("affected_rows"), F.col("e.details"),
    )


def check_log(checks: list[DataFrame], at: Column) -> DataFrame:
    """All check rows with their time, ready to append to the log."""
    rows = reduce(DataFrame.unionByName, checks)
    return rows.select(*LOG_COLUMNS).withColumn("check_timestamp", as_column(at).cast("timestamp"))


def report(log: DataFrame, failed_only: bool = False) -> DataFrame:
    """The log, newest first."""
    rows = log.filter(F.col("check_result") == FAIL) if failed_only else log
    columns = ["table_name", "check_type", "affected_rows", "details", "check_timestamp"] if failed_only else [
        "table_name", "check_type", "check_result", "affected_rows", "check_timestamp"]
    return rows.select(*columns).orderBy(F.col("check_timestamp").desc(), "table_name", "check_type")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# ---- column metrics ------------------------------------------------------------------------


def null_count(column: str, as_of: Column) -> Column:
    return F.count_if(F.col(column).isNull())


def unique_count(column: str, as_of: Column) -> Column:
    """Distinct values, NULL not counted."""
    return F.count_distinct(F.col(column))


def duplicate_count(column: str, as_of: Column) -> Column:
    """Surplus rows: values that are there minus distinct values."""
    return F.count(F.col(column)) - F.count_distinct(F.col(column))


def row_count(column: str | None, as_of: Column) -> Column:
    return F.count(F.lit(1))


def freshness(column: str, as_of: Column) -> Column:
    """Whole seconds from the newest value to ``as_of``."""
    return elapsed("SECOND", F.max(F.col(column)), as_of)


METRICS: dict[str, Callable[[str | None, Column], Column]] = {
    "NULL_COUNT": null_count,
    "UNIQUE_COUNT": unique_count,
    "DUPLICATE_COUNT": duplicate_count,
    "ROW_COUNT": row_count,
    "FRESHNESS": freshness,
}


def metrics(df: DataFrame, table: str, spec: list[tuple[str, str | None]], as_of: Column) -> DataFrame:
    """Evaluate all metrics of one table in one aggregation and return them as long rows."""
    cells = [METRICS[name](column, as_of).cast("bigint").alias(f"m{i}") for i, (name, column) in enumerate(spec)]
    rows = F.array(*[
        F.struct(F.lit(name).alias("metric_name"), F.lit(column).cast("string").alias("column_name"), F.col(f"m{i}").alias("value"))
        for i, (name, column) in enumerate(spec)
    ])
    return (
        df.agg(*cells)
        .select(F.explode(rows).alias("r"))
        .select(as_column(as_of).cast("timestamp").alias("measurement_time"), F.lit(table).alias("table_name"), "r.*")
    )


def fk_metric(child: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str, as_of: Column, name: str = "FK_EXISTS") -> DataFrame:
    """Custom metric over a table: keys that are NOT IN the parent, with SQL's NULL rules."""
    orphans = rows_not_in(key_counts(child, [key]), key, parent, parent_key, distinct_parent=True)
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("value")).select(
        as_column(as_of).cast("timestamp").alias("measurement_time"),
        F.lit(table).alias("table_name"),
        F.lit(name).alias("metric_name"),
        F.lit(key).alias("column_name"),
        "value",
    )


@dataclass
class Suite:
    """Metrics attached to tables; evaluated together."""

    attached: dict[str, list[tuple[str, str | None]]] = field(default_factory=dict)
    foreign_keys: list[tuple[str, str, str, str]] = field(default_factory=list)

    def attach(self, table: str, metric: str, column: str | None = None) -> "Suite":
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}")
        self.attached.setdefault(table, []).append((metric, column))
        return self

    def detach(self, table: str, metric: str, column: str | None = None) -> "Suite":
        self.attached[table].remove((metric, column))
        return self

    def attach_fk(self, table: str, key: str, parent: str, parent_key: str) -> "Suite":
        self.foreign_keys.append((table, key, parent, parent_key))
        return self

    def listing(self, spark) -> DataFrame:
        """Which metric sits on which table and column."""
        rows = [(t, m, c) for t, spec in self.attached.items() for m, c in spec]
        rows += [(t, "FK_EXISTS", k) for t, k, _, _ in self.foreign_keys]
        return spark.createDataFrame(rows, "table_name string, metric_name string, column_name string")

    def run(self, tables: dict[str, DataFrame], as_of: Column) -> DataFrame:
        parts = [metrics(tables[t], t, spec, as_of) for t, spec in self.attached.items() if spec]
        parts += [fk_metric(tables[t], t, k, tables[p], pk, as_of) for t, k, p, pk in self.foreign_keys]
        return reduce(DataFrame.unionByName, parts)


def latest_results(results: DataFrame) -> DataFrame:
    """Measurement history in the order of the monitoring view: table, metric, newest first."""
    return results.orderBy("table_name", "metric_name", "column_name", F.col("measurement_time").desc())
