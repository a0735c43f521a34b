"""Jobs on a change feed: the current positions, their change log, and summaries kept up by differences.

The feed has one row per change: the key, ``seq`` (grows per key), ``deleted`` and the full new
values. Deleted keys stay as marks with their ``seq``, so a change that comes late or twice never wins over a newer one.

All state is in ``LayeredTable``s, so a batch writes as many rows as it changes. The summaries are sums of exact numbers: every changed
position gives the difference between what it counted for before and what it counts for now, and every
changed price gives the difference for the positions with that stock. Customers whose sums or attributes moved get a new
summary row, and the difference between their old and new rows moves the segments.

Customers and prices are held against a digest per bucket of their keys; only buckets that differ are compared row by row with
the rows that the summaries were last computed with, and only rows that differ are written. What is in layer n was computed
from what is below n, so a repeated batch gives the same.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.numeric import mean_of, percent
from ..operators.changes import net_changes, row_hash
from ..operators.latest import latest_per_key
from ..operators.layers import LayeredTable
from ..operators.tables import NEW_SIDE, OLD_SIDE, paired
from ..session import discard, let_go, materialize
from .loader import start

POSITION_KEY = ["customer_id", "stock_code"]
# Rows that a digest stands for.
DIGEST_ROWS = 50_000


def _schema(text: str) -> StructType:
    return StructType.fromDDL(text)


def newest_changes(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of every key in a batch."""
    return latest_per_key(batch, keys, ["seq"])


@dataclass
class PositionState:
    """Current positions. ``schema`` is that of the feed."""

    path: str
    schema: StructType

    @property
    def table(self) -> LayeredTable:
        return LayeredTable(self.path, self.schema, POSITION_KEY, "customer_id", "stock_code")

    def live(self, spark: SparkSession, below: int | None = None, among: DataFrame | None = None) -> DataFrame:
        return self.table.rows(spark, below, among).filter(~F.col("deleted"))

    def take(self, batch: DataFrame, number: int, spark: SparkSession | None = None) -> DataFrame:
        """Write the changes that win as layer ``number``; a row per key with the structs of before (``__old``, NULL when new) and now (``__new``).

        ``spark`` is the session to work in; a stream hands its batches out in one that does not plan adaptively.
        """
        spark, columns = spark or batch.sparkSession, self.schema.fieldNames()
        self.table.merge(spark, number)
        changes = materialize(newest_changes(batch, POSITION_KEY).select(*columns), "changes", reader=spark)
        let_go(spark)
        before = self.table.rows(spark, number, changes.select(*POSITION_KEY))
        wins = F.col(OLD_SIDE).isNull() | (F.col(f"{NEW_SIDE}.seq") >= F.col(f"{OLD_SIDE}.seq"))
        moved = paired(before, changes, POSITION_KEY).filter(F.col(NEW_SIDE).isNotNull() & wins)
        # A row of the layer is its own new side.
        written = self.table.write(moved.select(f"{NEW_SIDE}.*", OLD_SIDE), number)
        discard(changes)
        let_go(spark)
        return written.select(*POSITION_KEY, OLD_SIDE, F.struct(*columns).alias(NEW_SIDE))


@dataclass
class Dimension:
    """The rows of a dimension that the summaries were last computed with, and a digest per bucket of its keys."""

    path: str
    key: str
    schema: StructType  # key and values

    @property
    def table(self) -> LayeredTable:
        return LayeredTable(f"{self.path}/rows", StructType([*self.schema.fields]).add("present", "boolean"), [self.key], self.key)

    @property
    def digests(self) -> LayeredTable:
        return LayeredTable(f"{self.path}/digests", _schema("part int, parts int, n long, low long, high long"), ["part", "parts"])

    def take(self, now: DataFrame, number: int) -> DataFrame | None:
        """Bring the rows up to ``now`` as layer ``number``; a row per changed key with ``__old`` and ``__new``, None when nothing changed."""
        spark = now.sparkSession
        for table in (self.table, self.digests):
            table.merge(spark, number)
        names = [n for n in self.schema.fieldNames() if n != self.key]
        now = now.select(self.key, *names)
        # One digest per DIGEST_ROWS rows or so comes to the driver.
        known = {(r.part, r.parts): (r.n, r.low, r.high) for r in self.digests.rows(spark, number).filter("n > 0").collect()}
        rows = sum(d[0] for d in known.values())
        parts = max((p for _, p in known), default=0)
        wanted = 1 << max(4, ((rows or now.count()) // DIGEST_ROWS).bit_length())
        # The number of parts follows the size; while it is within a factor of two the old one stays.
        parts = parts if parts and wanted // 2 <= parts <= 2 * wanted else wanted
        part = lambda: F.pmod(F.xxhash64(self.key), F.lit(parts)).cast("int")
        row = row_hash([self.key, *names])
        found = now.groupBy(part().alias("part")).agg(F.count("*"), F.sum(row.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(row, 32))).collect()
        fresh = {(r[0], parts): tuple(r[1:]) for r in found}
        differing = {k: fresh.get(k, (0, 0, 0)) for k in known.keys() | fresh.keys() if known.get(k) != fresh.get(k)}
        if not differing:
            return None
        touched = [k for k, of in differing if of == parts]
        here = part().isin(touched)
        old = self.table.rows(spark, number).filter("present").drop("present").filter(here)
        moved = paired(old, now.filter(here), [self.key]).filter(~F.col(OLD_SIDE).eqNullSafe(F.col(NEW_SIDE)))
        moved = self.table.write(moved.select(self.key, *[F.col(f"{NEW_SIDE}.{n}").alias(n) for n in names], F.col(NEW_SIDE).isNotNull().alias("present"), OLD_SIDE, NEW_SIDE), number)
        self.digests.write(spark.createDataFrame([(*k, *d) for k, d in differing.items()], self.digests.schema), number)
        return moved.select(self.key, OLD_SIDE, NEW_SIDE)

    def now(self, spark: SparkSession, number: int, among: DataFrame) -> DataFrame:
        """The rows after batch ``number``."""
        return self.table.rows(spark, number + 1, among).filter("present").drop("present")


_TOTALS = "customer_id {key}, customer_name string, risk_tolerance string, listed boolean, stock_count long, total_investment decimal(38,2), total_current_value decimal(38,2), overall_return_pct decimal(28,2)"
_SEGMENTS = "risk_tolerance string, customer_count long, sum_return decimal(38,2), n_return long, total_investment decimal(38,2), total_current_value decimal(38,2)"
_SUMS = ["stock_count", "total_investment", "total_current_value"]


@dataclass
class Summaries:
    """All tables of the customer and the segment summary below one folder. ``feed`` is the schema of the change feed."""

    path: str
    feed: StructType

    def _type(self, column: str) -> str:
        return self.feed[column].dataType.simpleString()

    @property
    def positions(self) -> PositionState:
        return PositionState(f"{self.path}/positions", self.feed)

    @property
    def prices(self) -> Dimension:
        return Dimension(f"{self.path}/prices", "stock_code", _schema(f"stock_code {self._type('stock_code')}, closing_price decimal(12,2)"))

    @property
    def customers(self) -> Dimension:
        return Dimension(f"{self.path}/customers", "customer_id", _schema(f"customer_id {self._type('customer_id')}, customer_name string, risk_tolerance string"))

    @property
    def totals(self) -> LayeredTable:
        return LayeredTable(f"{self.path}/summary", _schema(_TOTALS.format(key=self._type("customer_id"))), ["customer_id"], "customer_id")

    @property
    def segments(self) -> LayeredTable:
        return LayeredTable(f"{self.path}/segments", _schema(_SEGMENTS), ["risk_tolerance"])

    def refresh(self, batch: DataFrame, number: int, customers: DataFrame, prices: DataFrame, spark: SparkSession | None = None) -> None:
        """Take in a batch of changes, and whatever changed in customers and prices since the last one.

        ``batch`` may be empty. Writes rows in proportion to what changed; repeating it replaces its own layers.
        """
        spark = spark or batch.sparkSession
        for table in (self.totals, self.segments):
            table.merge(spark, number)
        # Three tables that do not depend on each other, at the same time.
        with ThreadPoolExecutor(3) as together:
            taken = [together.submit(self.prices.take, prices, number), together.submit(self.customers.take, customers, number), together.submit(self.positions.take, batch, number, spark)]
            repriced, renamed, moved = (t.result() for t in taken)
        deltas = self._deltas(spark, number, moved, repriced)
        if renamed is not None:
            deltas = deltas.unionByName(renamed.select("customer_id", *[F.lit(0).alias(c) for c in _SUMS]))
        deltas = materialize(deltas.groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in _SUMS]), "deltas")
        among = deltas.select("customer_id")
        old = self.totals.rows(spark, number, among).select("customer_id", F.struct(*self.totals.schema.fieldNames()).alias(OLD_SIDE))
        attributes = self.customers.now(spark, number, among).withColumn("known", F.lit(True))
        # A NULL customer is never listed, so a plain join loses nothing that is shown.
        both = deltas.join(old, "customer_id", "left").join(attributes, "customer_id", "left")
        sums = {c: (F.col(c) + F.coalesce(F.col(f"{OLD_SIDE}.{c}"), F.lit(0))).cast("long" if c == "stock_count" else "decimal(38,2)") for c in _SUMS}
        rows = both.select("customer_id", "customer_name", "risk_tolerance", "known", OLD_SIDE, *[v.alias(c) for c, v in sums.items()])
        rows = rows.withColumn("listed", F.coalesce("known", F.lit(False)) & (F.col("stock_count") > 0)).withColumn(
            "overall_return_pct", percent(F.col("total_current_value") - F.col("total_investment"), "total_investment", 2))
        self._move_segments(spark, number, self.totals.write(rows.filter("customer_id IS NOT NULL").drop("known"), number))

    def _deltas(self, spark: SparkSession, number: int, moved: DataFrame, repriced: DataFrame | None) -> DataFrame:
        """What each change adds to the sums of its customer."""

        def counts(side: str, price: Column, sign: int) -> list[Column]:
            there = F.col(side).isNotNull() & ~F.col(f"{side}.deleted") & price.isNotNull()
            own = (F.lit(1), F.col(f"{side}.quantity") * F.col(f"{side}.avg_purchase_price"), F.col(f"{side}.quantity") * price)
            return [F.when(there, v * sign).otherwise(0) for v in own]

        def row(new: list[Column], old: list[Column]) -> list[Column]:
            return ["customer_id", *[(a + b).cast("decimal(38,2)").alias(c) for a, b, c in zip(new, old, _SUMS)]]

        # Positions that changed count with the new price; what they counted before, with the new price too, as changed prices are brought in below.
        stocks = moved.select("stock_code").filter("stock_code IS NOT NULL")
        priced = moved.join(self.prices.now(spark, number, stocks), "stock_code", "left")
        price = F.col("closing_price")
        found = priced.select(*row(counts(NEW_SIDE, price, 1), counts(OLD_SIDE, price, -1)))
        if repriced is None:
            return found
        held = self.positions.live(spark, number, repriced.select("stock_code"))
        both = held.withColumn("__p", F.struct(*held.columns)).join(repriced, "stock_code")
        was, now = F.col(f"{OLD_SIDE}.closing_price"), F.col(f"{NEW_SIDE}.closing_price")
        return found.unionByName(both.select(*row(counts("__p", now, 1), counts("__p", was, -1))))

    def _move_segments(self, spark: SparkSession, number: int, rows: DataFrame) -> None:
        def side(prefix: str, sign: int) -> DataFrame:
            at = lambda c: F.col(f"{prefix}{c}")
            return rows.filter(at("listed")).select(
                at("risk_tolerance").alias("risk_tolerance"), F.lit(sign).cast("long").alias("customer_count"), (at("overall_return_pct") * sign).cast("decimal(38,2)").alias("sum_return"),
                F.when(at("overall_return_pct").isNotNull(), sign).otherwise(0).cast("long").alias("n_return"),
                (at("total_investment") * sign).cast("decimal(38,2)").alias("total_investment"), (at("total_current_value") * sign).cast("decimal(38,2)").alias("total_current_value"))

        sums = [c for c in self.segments.schema.fieldNames() if c != "risk_tolerance"]
        change = side("", 1).unionByName(side(f"{OLD_SIDE}.", -1)).groupBy("risk_tolerance").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
        added = paired(self.segments.rows(spark, number), change, ["risk_tolerance"]).filter(F.col(NEW_SIDE).isNotNull())
        self.segments.write(added.select("risk_tolerance", *[(F.coalesce(F.col(f"{OLD_SIDE}.{c}"), F.lit(0)) + F.col(f"{NEW_SIDE}.{c}")).alias(c) for c in sums]), number)

    def read_customers(self, spark: SparkSession) -> DataFrame:
        return self.totals.rows(spark).filter("listed").drop("listed")

    def read_segments(self, spark: SparkSession) -> DataFrame:
        """One row per risk class."""
        return self.segments.rows(spark).filter("customer_count > 0").select(
            "risk_tolerance", "customer_count", mean_of("sum_return", "n_return").alias("avg_return_pct"), "total_investment", "total_current_value")


def refresh_summary(
    changes: DataFrame,
    dims: Callable[[], tuple[DataFrame, DataFrame]],
    summaries: Summaries,
    checkpoint: str,
    dim_changes: DataFrame | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the customer summary, and the segment summary built on it, up to date.

    ``dims`` gives (customers, latest prices) at the time of a batch, one row per customer and per stock. ``dim_changes`` is a
    stream that has a row, of any kind, when one of them changed; it starts a batch also when no
    holdings come. ``trigger`` is the freshness target, for example ``{"processingTime": "5 minutes"}``.
    """
    if dim_changes is not None:
        # Their rows only wake the job.
        changes = changes.withColumn("__wake", F.lit(False)).unionByName(dim_changes.select(F.lit(True).alias("__wake")), allowMissingColumns=True)

    spark = changes.sparkSession

    def refresh(batch: DataFrame, batch_id: int) -> None:
        rows = batch.filter(~F.col("__wake")).drop("__wake") if dim_changes is not None else batch
        summaries.refresh(rows, batch_id, *dims(), spark)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(refresh)
    return start(writer, trigger)


def change_log_sink(changes: DataFrame, state: PositionState, log_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the net changes of every batch to a log, with the time at which the batch was taken in.

    The log folder carries the batch number and follows from the state below it, so the log of a repeated batch replaces itself.
    """

    spark = changes.sparkSession

    def record(batch: DataFrame, batch_id: int) -> None:
        moved = state.take(batch, batch_id, spark)
        old, new = (moved.filter(F.col(s).isNotNull()).select(f"{s}.*").filter(~F.col("deleted")).drop("seq", "deleted") for s in (OLD_SIDE, NEW_SIDE))
        found = net_changes(old, new, POSITION_KEY).withColumn("change_timestamp", F.current_timestamp())
        # Half of the bytes are hashes in hexadecimal, of which this takes half.
        found.write.mode("overwrite").option("compression", "zstd").parquet(f"{log_path}/batch_id={batch_id}")
        let_go(spark)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(record)
    return start(writer, trigger)
