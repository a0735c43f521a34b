"""Appends with column defaults and small exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import workspace
from . import folders


def with_defaults(df: DataFrame, schema: StructType, defaults: dict[str, Column]) -> DataFrame:
    """The columns of ``schema``: given ones cast, missing ones from their default or NULL."""
    extra = set(df.columns) - set(schema.fieldNames())
    if extra:
        raise ValueError(f"columns not in the table: {sorted(extra)}")
    columns = []
    for f in schema.fields:
        value = F.col(f.name) if f.name in df.columns else defaults.get(f.name, F.lit(None))
        columns.append(value.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def append(df: DataFrame, path: str, schema: StructType, defaults: dict[str, Column] | None = None, partition_by: list[str] | None = None, load_id: str | None = None) -> None:
    """Add rows to a table. With ``load_id`` they lie in a folder of that load, and the same load once more replaces them; without it every
    call adds its rows."""
    rows = with_defaults(df, schema, defaults or {}).write.mode("append" if load_id is None else "overwrite")
    (rows.partitionBy(*partition_by) if partition_by else rows).parquet(path if load_id is None else f"{path}/load_id={load_id}")


def unload_csv(df: DataFrame, path: str, single: bool = False, header: bool = False, compression: str = "none") -> None:
    """Export as CSV, in parallel. ``single`` gives one file of any size, in the order of ``df``.

    All tasks write parts, in the order of the result; the parts are then put together as bytes, in the order of their names. Parts of gzip are
    one gzip file when they follow each other, others can't be joined.
    """
    if not single:
        df.write.mode("overwrite").option("compression", compression).option("header", header).csv(path)
        return
    if compression not in ("none", "uncompressed", "gzip"):
        raise ValueError(f"parts of {compression!r} cannot be put together")
    spark = df.sparkSession
    parts = workspace(spark, "unload")
    if header:
        names = spark.createDataFrame([tuple(df.columns)], ", ".join(f"`{c}` string" for c in df.columns))
        names.coalesce(1).write.option("compression", compression).csv(f"{parts}/header")
    df.write.option("compression", compression).csv(f"{parts}/rows")
    found = [f"{parts}/{kind}/{n}" for kind in (["header"] if header else []) + ["rows"] for n in folders.names(spark, f"{parts}/{kind}") if n.startswith("part-")]
    folders.remove(spark, path)
    folders.concatenate(spark, found, f"{path}/part-00000.csv{'.gz' if compression == 'gzip' else ''}")
    folders.remove(spark, parts)
