"""Column metrics of a growing table from stored states, with their history.

Every file of the table leaves a state that can be added up: rows, NULLs and newest value per column. Distinct values are kept exactly, one
row per column and value in a layered table, so a new file adds what is new in it and nothing is counted twice. A run
reads only files that it does not know, adds their states, and stores its results beside those of earlier runs.

A file is known by path, size and time. When one that was counted is gone or another, its values cannot be taken back, and the run starts over
with all files; the result is that of a full scan in either case. Runs are numbered; a run that is repeated replaces itself. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources.files import list_files
from .layers import LayeredTable
from .tables import read_or_empty

_STATE = "file string, length long, modified timestamp, generation int, column_name string, n long, nulls long, newest timestamp, fresh_values long"
_RESULT = "measurement_time timestamp, table_name string, metric_name string, column_name string, value long"
DISTINCT = ("UNIQUE_COUNT", "DUPLICATE_COUNT")


@dataclass
class MetricStore:
    """``spec`` has (metric, column) pairs; ROW_COUNT has no column."""

    path: str
    table: str
    spec: list[tuple[str, str | None]]

    def _states(self, spark: SparkSession, before: int) -> DataFrame:
        return read_or_empty(spark, f"{self.path}/states", _STATE + ", run int").filter(F.col("run") < before)

    def _values(self, generation: int) -> LayeredTable:
        return LayeredTable(f"{self.path}/values-{generation}", StructType.fromDDL("column_name string, value string"), ["column_name", "value"], "value")

    def _columns(self) -> list[str]:
        return sorted({c for _, c in self.spec if c})

    def run(self, spark: SparkSession, table_path: str, run: int, now: dt.datetime) -> DataFrame:
        """Measure the table as run number ``run`` (growing); the results, as stored."""
        files = list_files(spark, table_path, r"\.parquet$").select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
        states = self._states(spark, run)
        generation = states.agg(F.max("generation")).first()[0] or 0
        known = states.filter((F.col("generation") == generation) & F.col("file").isNotNull()).select("file", "length", "modified").distinct()
        here = ["file", "length", "modified"]
        if not known.join(files, here, "left_anti").isEmpty():
            generation, known = generation + 1, known.limit(0)
        new = files.join(known, here, "left_anti")
        names = [r.file for r in new.select("file").collect()]
        if names:
            self._add(spark, new, names, generation, run)
        return self._measure(spark, generation, run, now)

    def _add(self, spark: SparkSession, new: DataFrame, names: list[str], generation: int, run: int) -> None:
        rows = spark.read.parquet(*names).withColumn("__file", F.col("_metadata.file_path"))
        columns = self._columns()
        newest = {c for m, c in self.spec if m == "FRESHNESS"}
        cells = [F.struct(F.lit(None).cast("string").alias("column_name"), F.count("*").alias("n"), F.lit(0).cast("long").alias("nulls"), F.lit(None).cast("timestamp").alias("newest"))]
        for c in columns:
            last = F.max(F.col(c)).cast("timestamp") if c in newest else F.lit(None).cast("timestamp")
            cells.append(F.struct(F.lit(c).alias("column_name"), F.count("*").alias("n"), F.count_if(F.col(c).isNull()).alias("nulls"), last.alias("newest")))
        per_file = rows.groupBy(F.col("__file").alias("file")).agg(F.array(*cells).alias("s")).select("file", F.explode("s").alias("s")).select("file", "s.*")
        # Files without rows are known as well.
        states = new.join(per_file, "file", "left").withColumns({"generation": F.lit(generation), "n": F.coalesce("n", F.lit(0)), "fresh_values": F.lit(0).cast("long")})
        counted = sorted({c for m, c in self.spec if m in DISTINCT})
        if counted:
            values = self._values(generation)
            values.merge(spark, run)
            cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in counted])
            seen = rows.select(F.explode(cells).alias("v")).select("v.*").filter("value IS NOT NULL").distinct()
            if not values.empty(spark, run):
                seen = seen.join(values.rows(spark, run), ["column_name", "value"], "left_anti")
            fresh = values.write(seen, run).groupBy("column_name").agg(F.count("*").alias("fresh_values"))
            states = states.unionByName(fresh.withColumn("generation", F.lit(generation)), allowMissingColumns=True)
        states.select(*[c.split()[0] for c in _STATE.split(", ")]).write.mode("overwrite").parquet(f"{self.path}/states/run={run}")

    def _measure(self, spark: SparkSession, generation: int, run: int, now: dt.datetime) -> DataFrame:
        states = self._states(spark, run + 1).filter(F.col("generation") == generation)
        # A row per column of the specification, and one for the table.
        sums = {r.column_name: r for r in states.groupBy("column_name").agg(
            F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.max("newest").alias("newest"), F.sum("fresh_values").alias("values"),
            (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.max("newest"))).alias("age")).collect()}
        rows = states.filter("column_name IS NULL AND file IS NOT NULL").agg(F.sum("n")).first()[0] or 0

        def value(metric: str, column: str | None) -> int | None:
            s = sums.get(column)
            if metric == "ROW_COUNT":
                return rows
            if s is None:
                return None if metric == "FRESHNESS" else 0
            return {"NULL_COUNT": s.nulls or 0, "UNIQUE_COUNT": s["values"] or 0, "DUPLICATE_COUNT": (s.n or 0) - (s.nulls or 0) - (s["values"] or 0), "FRESHNESS": s.age}[metric]

        found = spark.createDataFrame([(now, self.table, m, c, value(m, c)) for m, c in self.spec], _RESULT)
        path = f"{self.path}/history/run={run}"
        found.write.mode("overwrite").parquet(path)
        return spark.read.schema(_RESULT).parquet(path)

    def history(self, spark: SparkSession) -> DataFrame:
        """All results with the number of their run."""
        return read_or_empty(spark, f"{self.path}/history", _RESULT + ", run int")

    def trend(self, spark: SparkSession) -> DataFrame:
        """Per metric the latest value and the one of the run before."""
        last = F.max_by(F.struct("value", "measurement_time"), "run")
        runs = self.history(spark)
        latest = runs.groupBy("table_name", "metric_name", "column_name").agg(F.max("run").alias("run"), last.alias("l"))
        key = ["table_name", "metric_name"]
        earlier = runs.alias("e").join(latest.alias("n"), [F.col(f"e.{k}") == F.col(f"n.{k}") for k in key] + [F.col("e.column_name").eqNullSafe(F.col("n.column_name")), F.col("e.run") < F.col("n.run")])
        before = earlier.groupBy(*[F.col(f"e.{k}").alias(f"b_{k}") for k in [*key, "column_name"]]).agg(F.max_by("e.value", "e.run").alias("previous"))
        same = [F.col(k) == F.col(f"b_{k}") for k in key] + [F.col("column_name").eqNullSafe(F.col("b_column_name"))]
        return latest.join(before, same, "left").select(*key, "column_name", F.col("l.measurement_time").alias("measurement_time"), F.col("l.value").alias("value"), "previous")
