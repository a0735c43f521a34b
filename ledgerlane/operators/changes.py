"""Net changes between two states of a keyed table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .tables import NEW_SIDE, OLD_SIDE, paired, table_exists

ACTION, IS_UPDATE, ROW_ID = "action", "is_update", "row_id"
OFFSET = "OFFSET"
PART = "__part"


def net_changes(old: DataFrame, new: DataFrame, keys: list[str], compare: list[str] | None = None) -> DataFrame:
    """What changed from ``old`` to ``new``, one key at a time.

    only new: one INSERT. only old: one DELETE. changed: a DELETE with the old values and an
    INSERT with the new ones, both marked ``is_update``. unchanged: nothing. Steps in between do
    not show, whatever happened to a key since ``old``. ``row_id`` is a hash of the key.
    """
    columns = new.columns
    compare = compare or [c for c in columns if c not in keys]
    has_old, has_new = F.col(OLD_SIDE).isNotNull(), F.col(NEW_SIDE).isNotNull()
    same = reduce(
        Column.__and__,
        [F.col(f"{OLD_SIDE}.{c}").eqNullSafe(F.col(f"{NEW_SIDE}.{c}")) for c in compare],
        has_old & has_new,
    )

    def event(side: str, action: str) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(*fields, F.lit(action).alias(ACTION), (has_old & has_new).alias(IS_UPDATE))

    removed = F.when(has_old, event(OLD_SIDE, "DELETE"))
    added = F.when(has_new, event(NEW_SIDE, "INSERT"))
    events = paired(old, new, keys).filter(~same).select(
        F.explode(F.array_compact(F.array(removed, added))).alias("e")
    )
    return events.select("e.*").withColumn(ROW_ID, F.sha2(F.concat_ws("\u001f", *[F.col(k).cast("string") for k in keys]), 256))


# Rows that one digest stands for, and the most digests that are compared.
DIGEST_ROWS = 100_000
MOST_PARTS = 4096


def row_hash(columns: list[str]) -> Column:
    """A hash of whole rows; a NULL is a value of its own, in its own column."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def part_of(keys: list[str], parts: int) -> Column:
    return F.pmod(row_hash(keys), F.lit(parts)).cast("int")


def parts_for(rows: int) -> int:
    return min(MOST_PARTS, 1 << max(4, (rows // DIGEST_ROWS).bit_length()))


def part_digests(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Per part of the keys: rows, and sums of both halves of their hashes. The order of rows does not matter."""
    row = row_hash(df.columns)
    sums = (F.count("*").alias("n"), F.sum(row.bitwiseAND(0xFFFFFFFF)).alias("low"), F.sum(F.shiftrightunsigned(row, 32)).alias("high"))
    return df.groupBy(part_of(keys, parts).alias("part")).agg(*sums)


def _by_part(digests: DataFrame) -> dict[int, tuple]:
    """At most ``MOST_PARTS`` rows."""
    return {r.part: (r.n, r.low, r.high) for r in digests.select("part", "n", "low", "high").collect()}


def net_changes_by_digest(old: DataFrame, new: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """``net_changes`` of two states with the same columns that agree in most parts of their keys.

    Both are summed up to a digest per part first, without a shuffle of their rows; only rows of parts that differ are joined.
    """
    old = old.select(*new.columns)
    parts = parts or parts_for(new.count())
    one, two = (_by_part(part_digests(df, keys, parts)) for df in (old, new))
    differing = [k for k in one.keys() | two.keys() if one.get(k) != two.get(k)]
    if len(differing) == parts:
        return net_changes(old, new, keys)
    here = part_of(keys, parts).isin(differing)
    return net_changes(old.filter(here), new.filter(here), keys)


def apply_changes(state: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Bring ``state`` forward by a set of net changes."""
    deleted = changes.filter((F.col(ACTION) == "DELETE") & ~F.col(IS_UPDATE)).select(*keys)
    written = changes.filter(F.col(ACTION) == "INSERT").select(*state.columns)
    touched = deleted.unionByName(written.select(*keys))
    return state.join(touched, keys, "left_anti").unionByName(written)


@dataclass
class ConsumedChanges:
    """A table of published versions, the log of its net changes, and how far the log has consumed them.

    All is in ``path``. A log folder holds the changes up to its version and, in the same write, a row that marks the
    version as consumed; the offset is the last version so marked. Reading ``pending`` never moves it. One writer at a time.
    """

    path: str
    keys: list[str]

    def _version(self, spark: SparkSession) -> int:
        versions = f"{self.path}/versions"
        return spark.read.parquet(versions).agg(F.max("version")).first()[0] if table_exists(spark, versions) else 0

    def _state(self, spark: SparkSession, version: int, parts: list[int] | None = None) -> DataFrame:
        """A version; only some parts of its keys when these are named."""
        rows = spark.read.parquet(f"{self.path}/table/v{version}")
        return (rows if parts is None else rows.filter(F.col(PART).isin(parts))).drop(PART)

    def _digests(self, spark: SparkSession, version: int) -> tuple[int, dict[int, tuple]]:
        """Number of parts that a version is cut into, and the digests of those that have rows."""
        rows = spark.read.parquet(f"{self.path}/digests/v{version}").collect()
        return rows[0].parts, {r.part: (r.n, r.low, r.high) for r in rows if r.part is not None}

    def publish(self, state: DataFrame) -> int:
        """Write the next version of the table, cut into parts by its keys, and its digests; it counts once its number is written.
        The first one starts the log."""
        spark = state.sparkSession
        last = self._version(spark)
        version, rows = last + 1, state.count()
        parts, wanted = self._digests(spark, last)[0] if last else 0, parts_for(rows)
        # While the size is within a factor of two the parts stay, so that versions can be compared part by part.
        parts = parts if wanted // 2 <= parts <= 2 * wanted else wanted
        state.withColumn(PART, part_of(self.keys, parts)).hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(f"{self.path}/table/v{version}")
        written = spark.read.schema(state.schema).parquet(f"{self.path}/table/v{version}").select(*state.columns)
        digests = part_digests(written, self.keys, parts).withColumn("parts", F.lit(parts))
        mark = spark.createDataFrame([(parts,)], "parts int")
        digests.unionByName(mark, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/digests/v{version}")
        if version == 1:
            self._record(net_changes(state, state, self.keys).limit(0), 1)
        spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return version

    def _record(self, changes: DataFrame, version: int) -> None:
        mark = changes.sparkSession.createDataFrame([(OFFSET,)], f"{ACTION} string")
        changes.unionByName(mark, allowMissingColumns=True).write.mode("overwrite").parquet(f"{self.path}/log/version={version}")

    def offset(self, spark: SparkSession) -> int:
        """The last version that was consumed."""
        return spark.read.parquet(f"{self.path}/log").filter(F.col(ACTION) == OFFSET).agg(F.max("version")).first()[0]

    def pending(self, spark: SparkSession) -> DataFrame:
        """Net changes since the last consumed version; only parts whose digests differ are read."""
        old, new = self.offset(spark), self._version(spark)
        (parts, one), (others, two) = self._digests(spark, old), self._digests(spark, new)
        differing = sorted(k for k in one.keys() | two.keys() if one.get(k) != two.get(k)) if parts == others else None
        return net_changes(self._state(spark, old, differing), self._state(spark, new, differing), self.keys)

    def consume(self, spark: SparkSession) -> None:
        """Write the pending changes to the log, which moves the offset."""
        version = self._version(spark)
        if version > self.offset(spark):
            self._record(self.pending(spark), version)

    def logged(self, spark: SparkSession) -> DataFrame:
        """All consumed changes with the version that brought them."""
        return spark.read.parquet(f"{self.path}/log").filter(F.col(ACTION) != OFFSET)
