"""A keyed table with its history as validity intervals.

Every row has the version that wrote it (``valid_from``) and, once another version replaced or deleted it, that version (``valid_to``). Rows that
are valid now are in a layered table; a batch adds its rows there and puts the rows that they replace into
a folder of the batch's own. The state before a version is then a filter: rows written earlier that are still valid or were replaced in it or
later. Folders of replaced rows carry the version that replaced them, so only those from that version on are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .layers import LayeredTable
from .tables import NEW_SIDE, OLD_SIDE, once_per_key, paired, read_or_empty

FROM, TO, GONE = "valid_from", "valid_to", "is_deleted"


@dataclass
class VersionedTable:
    """``schema`` has keys and values. Versions grow; one writer at a time, and a version that is written again replaces itself."""

    path: str
    schema: StructType
    keys: list[str]

    @property
    def _now(self) -> LayeredTable:
        return LayeredTable(f"{self.path}/now", StructType([*self.schema.fields]).add(FROM, "long").add(GONE, "boolean"), self.keys, self.keys[0])

    def _replaced(self, spark: SparkSession) -> DataFrame:
        schema = StructType([*self.schema.fields]).add(FROM, "long").add(GONE, "boolean").add(TO, "long")
        return read_or_empty(spark, f"{self.path}/replaced", schema)

    def apply(self, changes: DataFrame, version: int, op_column: str = "op", deleted: str = "DELETE") -> None:
        """Write ``changes``, a full row per key and its operation, as ``version``."""
        spark, names = changes.sparkSession, self.schema.fieldNames()
        self._now.merge(spark, version)
        rows = once_per_key(changes, self.keys).select(*names, F.lit(version).cast("long").alias(FROM), (F.col(op_column) == deleted).alias(GONE))
        written = self._now.write(rows, version)
        old = self._now.rows(spark, version, written.select(*self.keys))
        if not self._now.empty(spark, version):
            old.write.mode("overwrite").parquet(f"{self.path}/replaced/{TO}={version}")

    def load(self, log: DataFrame, version_column: str = "version", op_column: str = "op", deleted: str = "DELETE") -> None:
        """Take over a change log, whole rows with version and operation, into an empty table; one pass over it."""
        spark, names = log.sparkSession, self.schema.fieldNames()
        if not self._now.empty(spark):
            raise ValueError(f"{self.path} has versions already")
        following = F.lead(version_column).over(Window.partitionBy(*self.keys).orderBy(version_column))
        rows = log.select(*names, F.col(version_column).cast("long").alias(FROM), (F.col(op_column) == deleted).alias(GONE), following.cast("long").alias(TO))
        rows = materialize(rows, "history")
        rows.filter(F.col(TO).isNotNull()).hint("rebalance", TO).write.mode("overwrite").partitionBy(TO).parquet(f"{self.path}/replaced")
        last = log.agg(F.max(version_column)).first()[0]
        if last is not None:
            self._now.write(rows.filter(F.col(TO).isNull()).drop(TO), int(last))

    def current(self, spark: SparkSession) -> DataFrame:
        return self._now.rows(spark).filter(~F.col(GONE)).select(*self.schema.fieldNames())

    def _before(self, spark: SparkSession, version: int) -> DataFrame:
        kept = self._now.rows(spark).filter(F.col(FROM) < version).drop(TO)
        return kept.unionByName(self._undone(spark, version))

    def _undone(self, spark: SparkSession, version: int) -> DataFrame:
        """Rows that were valid before ``version`` and are not any more."""
        return self._replaced(spark).filter((F.col(TO) >= version) & (F.col(FROM) < version)).drop(TO)

    def as_of(self, spark: SparkSession, version: int) -> DataFrame:
        """The table as it was just before ``version``."""
        return self._before(spark, version).filter(~F.col(GONE)).select(*self.schema.fieldNames())

    def rollback(self, spark: SparkSession, version: int, new_version: int) -> DataFrame:
        """Bring the table back to its state before ``version``, as a version of its own; the changes that did it.

        Only keys that were written since are read: their rows of now beside the rows that they had then.
        """
        names = self.schema.fieldNames()
        live = lambda df: df.filter(~F.col(GONE)).select(*names)
        since = live(self._now.rows(spark, new_version).filter(F.col(FROM) >= version))
        both = paired(since, live(self._undone(spark, version)), self.keys).filter(~F.col(OLD_SIDE).eqNullSafe(F.col(NEW_SIDE)))
        gone = F.col(NEW_SIDE).isNull()
        op = F.when(gone, "DELETE").when(F.col(OLD_SIDE).isNull(), "INSERT").otherwise("UPDATE")
        undo = materialize(both.select(F.coalesce(NEW_SIDE, OLD_SIDE).alias("r"), op.alias("op")).select("r.*", "op"), "undo")
        self.apply(undo, new_version)
        return undo
