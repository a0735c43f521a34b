"""Keyed updates, versions and net changes between two states made from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import changes as ch, tables as tb
from ..operators.versions import VersionedTable
from ..plans import alerts as al, daily, portfolio as pf
from ..session import materialize, workspace
from ..sources import lines as ln
from ..sources.sinks import append, unload_csv, with_defaults
from .registry import query
from .roles import ALERTS, ALLOC, AS_OF, NOW, POS, Roles, dbl, pct

EARLIER = "2002-01-01 00:00:00"
_STAMP = f"'{NOW}' AS load_timestamp"
_OLD_STAMP = f"'{EARLIER}' AS load_timestamp"

# The first run of the day knew other quantities and some positions that were sold since.
_SNAP = f"""{POS}, snap AS (
  SELECT customer_id, stock_code, sector, quantity, market_value, {pct('unrealized_pl', 'book_value', 4)} AS pl_pct FROM pos),
new_rows AS (SELECT * FROM snap WHERE (customer_id + stock_code) % 10 <> 0),
old_rows AS (SELECT customer_id, stock_code, sector, quantity - 1 AS quantity, market_value, pl_pct FROM snap WHERE (customer_id + stock_code) % 10 < 5)"""
_SNAP_COLUMNS = f"'{AS_OF}' AS snapshot_date, customer_id, stock_code, sector, {dbl('quantity')} AS quantity, {dbl('market_value')} AS market_value, pl_pct AS unrealized_pl_pct"


def _two_runs(r: Roles) -> tuple[DataFrame, DataFrame]:
    columns = ["snapshot_date", "customer_id", "stock_code", "sector", "quantity", "market_value", "unrealized_pl_pct"]
    rest = (F.col("customer_id") + F.col("stock_code")) % 10
    rows = r.snapshots.select(*columns)
    old = rows.filter(rest < 5).withColumn("quantity", F.col("quantity") - 1).withColumn("load_timestamp", F.lit(EARLIER).cast("timestamp"))
    return old, rows.filter(rest != 0)


@query("upsert_snapshot", f"""{_SNAP}
SELECT {_SNAP_COLUMNS}, {_STAMP} FROM new_rows
UNION ALL SELECT {_SNAP_COLUMNS}, {_OLD_STAMP} FROM old_rows WHERE (customer_id + stock_code) % 10 = 0""")
def upsert_snapshot(r: Roles) -> DataFrame:
    old, new = _two_runs(r)
    return tb.upsert(old, new, pf.SNAPSHOT_KEY, ("load_timestamp", r.now))


_ALLOC_OUT = f"""'{AS_OF}' AS snapshot_date, customer_id, risk_tolerance, sector, {dbl('market_value')} AS market_value,
  {dbl('allocation_ratio')} AS allocation_ratio, {dbl('target_ratio')} AS target_ratio, {dbl('deviation')} AS deviation, rebalance_flag"""


@query("upsert_allocation", f"""{ALLOC}
SELECT {_ALLOC_OUT}, {_STAMP} FROM alloc WHERE customer_id % 4 <> 0
UNION ALL SELECT {_ALLOC_OUT.replace('deviation, rebalance_flag', 'deviation, NOT rebalance_flag AS rebalance_flag')}, {_OLD_STAMP}
FROM alloc WHERE customer_id % 4 = 0""")
def upsert_allocation(r: Roles) -> DataFrame:
    """The stored day holds every second customer with other flags; the new run leaves out every fourth."""
    rows = materialize(r.allocation, "allocation")
    old = rows.filter(F.col("customer_id") % 2 == 0).withColumn("rebalance_flag", ~F.col("rebalance_flag")).withColumn("load_timestamp", F.lit(EARLIER).cast("timestamp"))
    return tb.upsert(old, rows.filter(F.col("customer_id") % 4 != 0), pf.ALLOCATION_KEY, ("load_timestamp", r.now))


@query("upsert_day_table", f"""{_SNAP}
SELECT {_SNAP_COLUMNS}, {_STAMP} FROM new_rows
UNION ALL SELECT {_SNAP_COLUMNS}, {_STAMP} FROM old_rows WHERE (customer_id + stock_code) % 10 = 0
UNION ALL SELECT {_SNAP_COLUMNS.replace(AS_OF, '2002-01-30')}, {_STAMP} FROM old_rows""")
def upsert_day_table(r: Roles) -> DataFrame:
    """Two runs into a stored table partitioned by day; the partition of another day stays."""
    old, new = (materialize(rows, "run") for rows in _two_runs(r))
    path = workspace(r.spark, "snapshot-table")
    first = old.drop("load_timestamp")
    before = F.lit("2002-01-30").cast("date")
    daily.upsert_day(path, first.withColumn("snapshot_date", before), pf.SNAPSHOT_KEY, "snapshot_date", before, r.now)
    daily.upsert_day(path, first, pf.SNAPSHOT_KEY, "snapshot_date", r.as_of, r.now)
    daily.upsert_day(path, new, pf.SNAPSHOT_KEY, "snapshot_date", r.as_of, r.now)
    return r.spark.read.parquet(path)


_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


@query("update_where", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 100000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders""")
def update_where(r: Roles) -> DataFrame:
    orders = r.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return tb.update_where(orders, (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000), {"o_orderstatus": F.lit("X")})


@query("delete_where", """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 61 <> 0 THEN p_type END AS sector FROM part)
SELECT p_partkey, sector FROM p WHERE sector IS NULL OR sector <> 'ECONOMY'""")
def delete_where(r: Roles) -> DataFrame:
    parts = r.prices.select(F.col("stock_code").alias("p_partkey"), "sector")
    return tb.delete_where(parts, F.col("sector") == "ECONOMY")


_ALERT = f"customer_id, sector, {dbl('deviation')} AS deviation"


@query("delete_stored", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F' AND NOT (o_orderstatus = 'O' AND o_orderkey % 2 = 0)""")
def delete_stored(r: Roles) -> DataFrame:
    """Rows deleted from a stored table: one partition loses all its rows, one some, the others are not touched."""
    path = workspace(r.spark, "deleted")
    r.table("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    tb.delete_stored(r.spark, path, (F.col("o_orderstatus") == "F") | ((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 2 == 0)), ["o_orderstatus"])
    return r.spark.read.parquet(path)


@query("insert_if_absent", f"""{ALERTS}, known AS (SELECT * FROM alert_rows)
SELECT {_ALERT}, alert_status FROM known WHERE customer_id % 3 = 0 UNION ALL SELECT {_ALERT}, 'OPEN' FROM known WHERE customer_id % 3 <> 0""")
def insert_if_absent(r: Roles) -> DataFrame:
    """A third of the alerts is there already, some of them closed: those are not issued again."""
    stored = materialize(r.alerts, "alerts")
    existing = stored.filter(F.col("customer_id") % 3 == 0)
    return al.issue_missing(existing, stored.drop("alert_status")).select("customer_id", "sector", "deviation", "alert_status")


@query("close_and_reissue", f"""{ALERTS}
SELECT {_ALERT}, 'CLOSED' AS alert_status FROM alert_rows UNION ALL SELECT {_ALERT}, 'OPEN' FROM alert_rows""")
def close_and_reissue(r: Roles) -> DataFrame:
    stored = materialize(r.alerts, "alerts")
    return al.reissue(stored, stored.drop("alert_status"), r.as_of).select("customer_id", "sector", "deviation", "alert_status")


# Change log of the orders: every order is inserted, every third updated, every seventh deleted.
_LOG = """log AS (
  SELECT o_orderkey, 1 AS version, 'INSERT' AS op, o_orderstatus, o_totalprice FROM orders
  UNION ALL SELECT o_orderkey, 2, 'UPDATE', 'U', o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 3, 'DELETE', o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL SELECT o_orderkey, 4, 'UPDATE', 'oops', o_totalprice FROM orders WHERE o_orderkey % 7 <> 0),
state AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn FROM log WHERE version < 4) WHERE rn = 1 AND op <> 'DELETE')"""


def _order_log(r: Roles) -> DataFrame:
    key = F.col("o_orderkey")
    orders = r.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")

    def change(version: int, op: str, rows: DataFrame) -> DataFrame:
        return rows.select("o_orderkey", F.lit(version).alias("version"), F.lit(op).alias("op"), "o_orderstatus", "o_totalprice")

    updated = orders.filter(key % 3 == 0).withColumns({"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") + 1})
    spoiled = orders.filter(key % 7 != 0).withColumn("o_orderstatus", F.lit("oops"))
    return (
        change(1, "INSERT", orders).unionByName(change(2, "UPDATE", updated))
        .unionByName(change(3, "DELETE", orders.filter(key % 7 == 0))).unionByName(change(4, "UPDATE", spoiled))
    )


def _order_versions(r: Roles) -> VersionedTable:
    log = materialize(_order_log(r), "order-log")
    table = VersionedTable(workspace(r.spark, "versions"), log.drop("version", "op").schema, ["o_orderkey"])
    table.load(log.filter(F.col("version") < 4))
    table.apply(log.filter(F.col("version") == 4), 4)
    return table


@query("as_of_version", f"WITH {_LOG} SELECT o_orderkey, o_orderstatus, o_totalprice FROM state")
def as_of_version(r: Roles) -> DataFrame:
    """The table before version 4, from the validity of its rows."""
    return _order_versions(r).as_of(r.spark, 4)


@query("rollback_to_version", f"WITH {_LOG} SELECT o_orderkey, o_orderstatus, o_totalprice FROM state")
def rollback_to_version(r: Roles) -> DataFrame:
    """Version 5 takes the table back to before version 4."""
    table = _order_versions(r)
    table.rollback(r.spark, 4, 5)
    return table.current(r.spark)


# Two states of the orders: rows dropped, added and changed by key arithmetic.
_STATES = """old_state AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 1),
new_state AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice
  FROM orders WHERE o_orderkey % 10 <> 2)"""
_DIFF = f"""{_STATES},
both_sides AS (SELECT o.o_orderkey FROM old_state o JOIN new_state n ON o.o_orderkey = n.o_orderkey WHERE o.o_orderstatus IS DISTINCT FROM n.o_orderstatus),
net AS (
  SELECT *, 'INSERT' AS action, FALSE AS is_update FROM new_state WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old_state)
  UNION ALL SELECT *, 'DELETE', FALSE FROM old_state WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new_state)
  UNION ALL SELECT *, 'DELETE', TRUE FROM old_state WHERE o_orderkey IN (SELECT o_orderkey FROM both_sides)
  UNION ALL SELECT *, 'INSERT', TRUE FROM new_state WHERE o_orderkey IN (SELECT o_orderkey FROM both_sides))"""


def _states(r: Roles) -> tuple[DataFrame, DataFrame]:
    key = F.col("o_orderkey")
    orders = r.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changed = orders.filter(key % 10 != 2).withColumn("o_orderstatus", F.when(key % 6 != 0, F.col("o_orderstatus")))
    return orders.filter(key % 10 != 1), changed


@query("cdc_net_changes", f"WITH {_DIFF} SELECT *, sha256(CAST(o_orderkey AS VARCHAR)) AS row_id FROM net")
def cdc_net_changes(r: Roles) -> DataFrame:
    """Parts of the keys whose digests agree are not joined."""
    old, new = _states(r)
    return ch.net_changes_by_digest(old, new, ["o_orderkey"])


@query("cdc_apply", f"WITH {_STATES} SELECT * FROM new_state")
def cdc_apply(r: Roles) -> DataFrame:
    """Net changes applied to the old state give the new one."""
    old, new = _states(r)
    return ch.apply_changes(old, ch.net_changes(old, new, ["o_orderkey"]), ["o_orderkey"])


@query("cdc_consume", f"""WITH {_DIFF} SELECT 'logged' AS what, count(*) AS n FROM net UNION ALL SELECT 'left after consuming', 0""")
def cdc_consume(r: Roles) -> DataFrame:
    """Writing the changes to the log moves the stored offset, plain reading does not; both read again from the path."""
    old, new = _states(r)
    path = workspace(r.spark, "consumed")
    stream = ch.ConsumedChanges(path, ["o_orderkey"])
    stream.publish(old)
    stream.publish(new)
    read = materialize(stream.pending(r.spark), "only-read")
    again = ch.ConsumedChanges(path, ["o_orderkey"])
    again.consume(r.spark)
    reopened = ch.ConsumedChanges(path, ["o_orderkey"])
    logged = reopened.logged(r.spark).drop("version")
    # What was read before and not logged, or logged and not read, is left, next to what is still pending.
    differing = read.exceptAll(logged).unionByName(logged.exceptAll(read))
    left = reopened.pending(r.spark).unionByName(differing)

    def size(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.lit(name).alias("what"), F.count(F.lit(1)).alias("n"))

    return size("logged", logged).unionByName(size("left after consuming", left))


# ---- sinks ---------------------------------------------------------------------------------


@query("sink_append", f"""
SELECT o_orderkey, o_orderstatus, 'OPEN' AS alert_status, '{NOW}' AS load_timestamp FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, 'CLOSED', '{NOW}' FROM orders WHERE o_orderkey % 2 = 0""")
def sink_append(r: Roles) -> DataFrame:
    """Two loads into one table, the second one twice, which replaces itself; missing columns take their defaults."""
    orders = r.table("orders").select("o_orderkey", "o_orderstatus")
    schema = with_defaults(orders, orders.schema, {}).withColumns({"alert_status": F.lit(""), "load_timestamp": r.now}).schema
    defaults = {"alert_status": F.lit("OPEN"), "load_timestamp": r.now}
    path = workspace(r.spark, "append")
    append(orders, path, schema, defaults, load_id="first")
    for _ in range(2):
        append(orders.filter(F.col("o_orderkey") % 2 == 0).withColumn("alert_status", F.lit("CLOSED")), path, schema, defaults, load_id="second")
    return r.spark.read.parquet(path).drop("load_id")


@query("sink_ctas", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey")
def sink_ctas(r: Roles) -> DataFrame:
    counts = r.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return tb.publish_new(counts, workspace(r.spark, "ctas"))


@query("sink_csv_unload", """
SELECT o_orderkey, o_orderstatus, o_orderpriority, row_number() OVER (ORDER BY o_orderkey) AS line_no FROM orders""")
def sink_csv_unload(r: Roles) -> DataFrame:
    """The orders in the order of their keys in one file, read back with their line numbers."""
    path = workspace(r.spark, "unload")
    unload_csv(r.table("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").orderBy("o_orderkey"), path, single=True)
    lines = ln.raw_lines(r.spark, path)
    numbered = ln.place_lines(lines, ln.block_index(lines))
    parts = F.split("line", ",")
    return numbered.select(parts[0].cast("bigint").alias("o_orderkey"), parts[1].alias("o_orderstatus"), parts[2].alias("o_orderpriority"), "line_no")


# ---- the daily chain -----------------------------------------------------------------------


_MAIL = f"""{ALERTS}
SELECT sales_rep, customer_id, customer_name, risk_tolerance, sector, {dbl('current_ratio')} AS current_ratio, {dbl('target_ratio')} AS target_ratio,
  {dbl('deviation')} AS deviation, recommended_action FROM alert_rows"""


def _run_days(r: Roles, hours: int) -> DataFrame:
    """The chain with prices from files, run once an hour over the same files; the mail rows of the last run."""
    files = workspace(r.spark, "price-files")
    nothing = F.lit(0)
    prices = r.prices.select(
        "stock_code", "stock_name", "sector", "price_date", "closing_price", nothing.alias("volume"), nothing.alias("high"), nothing.alias("low"))
    prices.write.option("header", True).option("escape", '"').csv(files)
    tables = daily.DailyTables(workspace(r.spark, "daily"))
    as_of, now = dt.date.fromisoformat(AS_OF), dt.datetime.fromisoformat(NOW)
    holdings = r.holdings.withColumn("stock_code", F.col("stock_code").cast("string"))
    for hour in range(hours):
        report = daily.run_day(r.spark, tables, files, holdings, r.customers, r.targets, as_of, now + dt.timedelta(hours=hour))
    return report


@query("daily_run", _MAIL)
def daily_run(r: Roles) -> DataFrame:
    """Load, value, compare, alert and report."""
    return _run_days(r, 1)


@query("daily_pipeline", _MAIL)
def daily_pipeline(r: Roles) -> DataFrame:
    """The same once more an hour later: the files are known and not loaded again, the alerts are closed and issued anew."""
    return _run_days(r, 2)
