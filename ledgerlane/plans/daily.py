"""The daily chain: load prices, value positions, compare with targets, issue alerts, report.

Each step reads what its predecessor wrote and writes one entry to the run log. Tables live
below one root folder; the keyed ones are partitioned by their date, and a run rewrites only the
partition of its own day. Price files are loaded once each, as their ledger knows them; the latest price of every stock is kept beside the
history, so a day reads its own files only. A run is known by its date and time: one that is repeated
replaces its rows and its log entries.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.layers import LayeredTable
from ..operators.tables import missing_rows, replace_partitions, table_exists, upsert
from ..session import discard, let_go, materialize
from ..sources.delimited import CsvFormat, fields
from ..sources.ledger import NEW, LoadLedger, load_new_files, loaded_rows
from ..sources.sinks import with_defaults
from ..streaming.loader import load_log
from . import alerts as al, portfolio as pf
from .runlog import run_step

PRICE_FIELDS = fields(
    ("stock_code", "string"), ("stock_name", "string"), ("sector", "string"), ("price_date", "date"),
    ("closing_price", "decimal(12,2)"), ("volume", "bigint"), ("week52_high", "decimal(12,2)"), ("week52_low", "decimal(12,2)"),
)
HOLDING_FIELDS = fields(
    ("customer_id", "string"), ("stock_code", "string"), ("quantity", "decimal(10,0)"),
    ("avg_purchase_price", "decimal(12,2)"), ("purchase_date", "date"),
)
CUSTOMER_FIELDS = fields(
    ("customer_id", "string"), ("customer_name", "string"), ("risk_tolerance", "string"),
    ("contract_date", "date"), ("sales_rep", "string"),
)
TRADE_FIELDS = fields(
    ("trade_date", "date"), ("customer_id", "string"), ("stock_code", "string"), ("trade_type", "string"),
    ("quantity", "decimal(10,0)"), ("execution_price", "decimal(12,2)"), ("commission", "decimal(12,2)"),
)
TARGET_FIELDS = fields(("risk_tolerance", "string"), ("sector", "string"), ("target_ratio", "decimal(5,2)"))

LOG_SCHEMA = (
    StructType()
    .add("table_name", "string").add("check_type", "string").add("check_result", "string")
    .add("affected_rows", "long").add("details", "string").add("check_timestamp", "timestamp")
)


@dataclass
class DailyTables:
    """Paths of the tables a run writes."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table as written, or an empty one with the schema of ``like``."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], like.schema)
    return spark.read.parquet(path).select(*like.columns)


def upsert_day(path: str, rows: DataFrame, keys: list[str], date_column: str, as_of: Column, now: Column) -> DataFrame:
    """Merge the day's rows into a table partitioned by date; returns the day as stored.

    Both have the same columns, so an old row stays as it is or goes whole. Which ones stay is found by the keys alone, and whole
    rows are not joined. Each step is written, and its shuffles are let go, before the next.
    """
    spark = rows.sparkSession
    stamped = materialize(rows.withColumn("load_timestamp", now.cast("timestamp")), "day-rows", compression="zstd")
    let_go(spark)
    old = _stored(spark, path, stamped).filter(F.col(date_column) == as_of)
    left = materialize(missing_rows(stamped, old.select(*keys), keys).select(*[F.col(k).alias(f"__left_{k}") for k in keys]), "left-keys")
    kept = old.join(left, [F.col(k).eqNullSafe(F.col(f"__left_{k}")) for k in keys], "left_semi")
    taken = upsert(old.limit(0), stamped, keys, ("load_timestamp", now.cast("timestamp")))
    replace_partitions(kept.unionByName(taken), path, [date_column], rebalance=False)
    for table in (stamped, left):
        discard(table)
    let_go(spark)
    return _stored(spark, path, stamped).filter(F.col(date_column) == as_of)


def latest_prices(tables: DailyTables) -> LayeredTable:
    """The newest price row of every stock."""
    schema = StructType.fromDDL(", ".join(f"{f.name} {f.type}" for f in PRICE_FIELDS)).add("load_timestamp", "timestamp")
    return LayeredTable(tables.path("latest_prices"), schema, ["stock_code"], "stock_code")


def load_prices(spark: SparkSession, tables: DailyTables, files: str | list[str], load_id: str, now: dt.datetime, fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """Load price files that were not loaded before, by their dates, and bring the latest prices up to them; the report of the files."""
    ledger, table, latest = LoadLedger(tables.path("load_ledger")), tables.path("market_prices"), latest_prices(tables)
    report = materialize(load_new_files(spark, files, PRICE_FIELDS, table, ledger, load_id, now, fmt, partition_by=["price_date"], extra={"load_timestamp": F.lit(now).cast("timestamp")}), "load-report")
    if not report.filter(F.col("state") == NEW).isEmpty():
        number, names = ledger.number(spark, load_id), latest.schema.fieldNames()
        latest.merge(spark, number)
        rows = materialize(pf.latest_prices(loaded_rows(spark, table, ledger, load_id).select(*names)), "day-prices")
        before = latest.rows(spark, number, rows.select("stock_code"))
        latest.write(pf.latest_prices(before.unionByName(rows)), number)
    return report


def run_day(
    spark: SparkSession,
    tables: DailyTables,
    price_files: str | list[str] | None,
    holdings: DataFrame,
    customers: DataFrame,
    targets: DataFrame,
    as_of: dt.date,
    now: dt.datetime,
    price_format: CsvFormat = CsvFormat(),
) -> DataFrame:
    """Run all five steps for one day and return the mail report rows."""
    day, clock = F.lit(as_of), F.lit(now).cast("timestamp")
    run_id = f"{as_of:%Y%m%d}-{now:%Y%m%dT%H%M%S}"
    steps = count(1)

    def log(rows: DataFrame) -> None:
        entry = with_defaults(rows, LOG_SCHEMA, {"check_timestamp": clock})
        entry.write.mode("overwrite").parquet(f"{tables.path('run_log')}/run={run_id}/step={next(steps)}")

    if price_files is not None:
        report = load_prices(spark, tables, price_files, run_id, now, price_format)
        log(load_log(report.filter(F.col("state") == NEW).withColumnRenamed("file", "file_name"), "MARKET_PRICES"))
    prices = latest_prices(tables).rows(spark)

    valued = pf.snapshot(pf.positions(holdings, prices), day)
    snapshots = upsert_day(tables.path("portfolio_snapshot"), valued, pf.SNAPSHOT_KEY, "snapshot_date", day, clock)
    log(run_step(snapshots, "PORTFOLIO_SNAPSHOT", "DAILY_UPDATE", F.concat(F.lit("Updated snapshot for date: "), day.cast("string"))))

    compared = pf.allocation(snapshots, customers, targets, day)
    alloc = upsert_day(tables.path("customer_allocation"), compared, pf.ALLOCATION_KEY, "snapshot_date", day, clock)
    log(run_step(alloc, "CUSTOMER_ALLOCATION", "DAILY_UPDATE", F.concat(F.lit("Updated allocation for date: "), day.cast("string"))))

    current = al.alerts(alloc, customers, day)
    alerts_path = tables.path("rebalance_alerts")
    existing = _stored(spark, alerts_path, al.with_status(current)).filter(F.col("alert_date") == day)
    replace_partitions(al.reissue(existing, current, day), alerts_path, ["alert_date"], rebalance=False)
    issued = _stored(spark, alerts_path, al.with_status(current))
    log(run_step(
        al.on_day(issued, day, True), "REBALANCE_ALERTS", "ALERT_GENERATION",
        F.concat(F.lit("Generated "), F.col("n").cast("string"), F.lit(" alerts for date: "), day.cast("string")),
    ))

    report = al.rep_detail(issued, day)
    log(run_step(
        al.on_day(issued, day, True), "EMAIL_ALERTS", "EMAIL_PREPARATION",
        F.concat(F.lit("Prepared email alerts for "), F.col("affected").cast("string"), F.lit(" sales representatives")),
        F.count_distinct("sales_rep"),
    ))
    return report
