"""Keyed updates on plain DataFrames and partitioned parquet tables.

Functions return the new state; nothing is changed in place. ``replace_partitions`` is the one
writer for tables that are updated: it writes the new rows aside first and then swaps only the
partitions they belong to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import discard, materialize
from ..sources import folders
from .latest import latest_per_key

OLD_SIDE, NEW_SIDE = "__old", "__new"


def paired(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on the key: the key columns plus structs ``__old`` and ``__new``.

    A struct is NULL when that side has no row, so a NULL *value* in a present row is kept apart
    from a missing row. Keys must be unique on each side. A NULL in a key equals a NULL, so a run
    that is repeated finds its own rows again.
    """
    left = old.select(*[F.col(k).alias(f"__old_{k}") for k in keys], F.struct(*old.columns).alias(OLD_SIDE))
    right = new.select(*[F.col(k).alias(f"__new_{k}") for k in keys], F.struct(*new.columns).alias(NEW_SIDE))
    both = left.join(right, [F.col(f"__old_{k}").eqNullSafe(F.col(f"__new_{k}")) for k in keys], "full_outer")
    return both.select(*[F.coalesce(f"__old_{k}", f"__new_{k}").alias(k) for k in keys], OLD_SIDE, NEW_SIDE)


def once_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` as it is; the job that reads it fails, naming the key, when a key has several rows."""
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys])
    several = F.raise_error(F.concat(F.lit("several source rows for key "), shown)).cast("boolean")
    counted = df.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return counted.filter(F.when(F.col("__rows") > 1, several).otherwise(F.lit(True))).drop("__rows")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], stamp: tuple[str, Column] | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key; all others stay.

    There is no delete: an old key missing from ``new`` is kept. ``stamp`` is a column set on
    every row that was inserted or updated. Columns only ``old`` has keep their value on update.
    The types are those of ``old``, the table; a new value that does not fit them is an error, and so are several rows of
    ``new`` with one key.
    """
    new = once_per_key(new, keys)
    types = {f.name: f.dataType for f in old.schema.fields}
    stamp_name = stamp[0] if stamp else None
    present = F.col(NEW_SIDE).isNotNull()
    columns = []
    for name in old.columns:
        kept = F.col(f"{OLD_SIDE}.{name}")
        if name == stamp_name:
            columns.append(F.when(present, stamp[1]).otherwise(kept).alias(name))
        elif name in new.columns:
            columns.append(F.when(present, F.col(f"{NEW_SIDE}.{name}").cast(types[name])).otherwise(kept).alias(name))
        else:
            columns.append(kept.alias(name))
    return paired(old, new, keys).select(*columns)


def update_where(df: DataFrame, predicate: Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE; a NULL predicate leaves the row alone."""
    types = dict(df.dtypes)
    return df.withColumns(
        {name: F.when(predicate, value).otherwise(F.col(name)).cast(types[name]) for name, value in values.items()}
    )


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """DELETE ... WHERE; a NULL predicate keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def missing_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``old``. A NULL in a key equals a NULL."""
    there = old.select(*[F.col(k).alias(f"__old_{k}") for k in keys]).distinct()
    return new.join(there, [F.col(k).eqNullSafe(F.col(f"__old_{k}")) for k in keys], "left_anti")


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.unionByName(missing_rows(old, new, keys).select(*old.columns))


def close_and_reissue(old: DataFrame, new: DataFrame, date_column: str, as_of: Column, status: str = "alert_status", opened: str = "OPEN", closed: str = "CLOSED") -> DataFrame:
    """Close the day's open rows, then add all current ones as open."""
    is_open_today = (F.col(date_column) == as_of) & (F.col(status) == opened)
    kept = update_where(old, is_open_today, {status: F.lit(closed)})
    return kept.unionByName(new.withColumn(status, F.lit(opened)).select(*old.columns))


def state_before(log: DataFrame, keys: list[str], version, version_column: str = "version", op_column: str = "op", deleted: str = "DELETE") -> DataFrame:
    """The table as it was just before ``version``, rebuilt from its change log.

    The log has one row per change: key, version, operation and the full new row. Versions of one
    key are distinct.
    """
    earlier = log.filter(F.col(version_column) < F.lit(version))
    last = latest_per_key(earlier, keys, [version_column])
    return last.filter(F.col(op_column) != deleted).drop(version_column, op_column)


def rollback(log: DataFrame, keys: list[str], version, new_version, version_column: str = "version", op_column: str = "op", deleted: str = "DELETE") -> DataFrame:
    """Change-log rows that bring the table back to its state before ``version``.

    Appending them as ``new_version`` undoes every change made since: keys that have to go get a
    delete row, keys that differ get their old row again, and equal keys get nothing. History is
    kept.
    """
    names = (version_column, op_column, deleted)
    before = state_before(log, keys, version, *names)
    now = state_before(log, keys, new_version, *names)
    values = [c for c in before.columns if c not in keys]
    same = reduce(
        Column.__and__,
        [F.col(f"{OLD_SIDE}.{c}").eqNullSafe(F.col(f"{NEW_SIDE}.{c}")) for c in values],
        F.col(OLD_SIDE).isNotNull() & F.col(NEW_SIDE).isNotNull(),
    )
    pairs = paired(now, before, keys).filter(~same)
    gone = F.col(NEW_SIDE).isNull()
    return pairs.select(
        *keys,
        F.lit(new_version).alias(version_column),
        F.when(gone, F.lit(deleted)).otherwise(F.when(F.col(OLD_SIDE).isNull(), F.lit("INSERT")).otherwise(F.lit("UPDATE"))).alias(op_column),
        *[F.when(gone, F.col(f"{OLD_SIDE}.{c}")).otherwise(F.col(f"{NEW_SIDE}.{c}")).alias(c) for c in values],
    ).select(*log.columns)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).limit(0)
        return True
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], schema)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], stage: bool = True, rebalance: bool = True) -> None:
    """Swap exactly the partitions that occur in ``df``; all other partitions stay.

    ``df`` may read from ``path``: it is written to the shared folder before anything in ``path``
    is touched, so a failed run can be repeated from there. ``stage=False`` is for rows that are a
    written table already. ``rebalance`` gathers the rows of each partition into files of a
    sensible size, large partitions over many tasks; rows of a single partition do not need it.
    """
    rows = materialize(df, "staged") if stage else df
    if rebalance:
        rows = rows.hint("rebalance", *partition_by)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    if stage:
        discard(rows)


def delete_stored(spark: SparkSession, path: str, predicate: Column, partition_by: list[str]) -> None:
    """DELETE ... WHERE on a partitioned table: only partitions with such rows are rewritten, and those left empty are removed.

    A run that failed in between finds what is left to delete again.
    """
    table = spark.read.parquet(path)
    hit = F.coalesce(predicate, F.lit(False))
    touched = materialize(table.filter(hit).select(*partition_by).distinct(), "touched")
    same = [table[c].eqNullSafe(touched[c]) for c in partition_by]
    kept = materialize(table.filter(~hit).join(touched, same, "left_semi"), "kept")
    if not kept.isEmpty():
        replace_partitions(kept, path, partition_by, stage=False)
    left = kept.select(*partition_by).distinct()
    empty = touched.join(left, [touched[c].eqNullSafe(left[c]) for c in partition_by], "left_anti")
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for row in empty.select(*[F.col(c).cast("string") for c in partition_by]).toLocalIterator():  # names of partitions
        folders.remove(spark, "/".join([path.rstrip("/"), *[name(c, row[c]) for c in partition_by]]))
    spark.catalog.refreshByPath(path)


def publish_new(df: DataFrame, path: str) -> DataFrame:
    """Create a table from a query. Refuses to write over an existing path."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
