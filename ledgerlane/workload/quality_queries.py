"""Checks and metrics over tables with NULLs, duplicates and orphans made by key arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import quality as q
from ..operators.metric_store import MetricStore
from ..session import materialize, workspace
from .registry import query
from .relational_queries import CHILD, NULL_PARENT, PARENT, child, parent
from .roles import CONTACTS, NOW, Roles

_LOG = "'{table}' AS table_name, '{check}' AS check_type, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS check_result, CAST(n AS BIGINT) AS affected_rows, '{details}' AS details".format


@query("dq_null_check", f"""WITH {CONTACTS}
SELECT {_LOG(table='CONTACTS', check='NULL_CHECK', details='NULL values found in: email, phone, visibility')}
FROM (SELECT count(*) AS n FROM contacts WHERE email IS NULL OR phone IS NULL OR visibility IS NULL)
UNION ALL SELECT {_LOG(table='ORDERS', check='NULL_CHECK', details='NULL values found in required columns')}
FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL)""")
def dq_null_check(r: Roles) -> DataFrame:
    return q.null_check(r.contacts, "CONTACTS", ["email", "phone", "visibility"]).unionByName(
        q.null_check(r.table("orders"), "ORDERS", ["o_orderkey", "o_custkey"], "NULL values found in required columns"))


@query("dq_duplicate_check", f"""
SELECT {_LOG(table='LINEITEM', check='DUPLICATE_CHECK', details='Duplicate l_orderkey + l_linenumber found')}
FROM (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
UNION ALL SELECT {_LOG(table='ORDERS', check='DUPLICATE_CHECK', details='Duplicate o_orderkey found')}
FROM (SELECT count(*) AS n FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))""")
def dq_duplicate_check(r: Roles) -> DataFrame:
    return q.duplicate_check(r.table("lineitem"), "LINEITEM", ["l_orderkey", "l_linenumber"]).unionByName(
        q.duplicate_check(r.table("orders"), "ORDERS", ["o_orderkey"]))


@query("dq_fk_rows", f"""WITH {CHILD}, {PARENT}
SELECT {_LOG(table='CHILD', check='REFERENTIAL_INTEGRITY', details='CHILD with non-existent k')}
FROM (SELECT count(*) AS n FROM child LEFT JOIN parent ON k = pk WHERE pk IS NULL)""")
def dq_fk_rows(r: Roles) -> DataFrame:
    return q.fk_check(child(r), "CHILD", "k", parent(r), "k")


@query("dq_fk_distinct", f"""WITH {CHILD}, {PARENT}
SELECT {_LOG(table='CHILD', check='REFERENTIAL_INTEGRITY', details='CHILD with non-existent k')}
FROM (SELECT count(*) AS n FROM (SELECT DISTINCT k FROM child LEFT JOIN parent ON k = pk WHERE pk IS NULL))""")
def dq_fk_distinct(r: Roles) -> DataFrame:
    return q.fk_check(child(r), "CHILD", "k", parent(r), "k", distinct=True)


_LOGGED = f"""WITH {CONTACTS}, {CHILD}, {PARENT}, checks AS (
SELECT {_LOG(table='CONTACTS', check='NULL_CHECK', details='NULL values found in: email, phone')} FROM (SELECT count(*) AS n FROM contacts WHERE email IS NULL OR phone IS NULL)
UNION ALL SELECT {_LOG(table='CONTACTS', check='DUPLICATE_CHECK', details='Duplicate customer_id found')} FROM (SELECT count(*) AS n FROM (SELECT 1 FROM contacts GROUP BY customer_id HAVING count(*) > 1))
UNION ALL SELECT {_LOG(table='CHILD', check='REFERENTIAL_INTEGRITY', details='CHILD with non-existent k')} FROM (SELECT count(*) AS n FROM child LEFT JOIN parent ON k = pk WHERE pk IS NULL))"""


def _checks(r: Roles) -> DataFrame:
    return q.check_log([
        q.table_checks(r.contacts, "CONTACTS", ["email", "phone"], ["customer_id"]),
        q.fk_check(child(r), "CHILD", "k", parent(r), "k"),
    ], r.now)


@query("dq_log", f"{_LOGGED} SELECT *, '{NOW}' AS check_timestamp FROM checks")
def dq_log(r: Roles) -> DataFrame:
    """Checks appended to a log table and read back."""
    return materialize(_checks(r), "quality-log")


@query("dq_report", f"{_LOGGED} SELECT table_name, check_type, affected_rows, details, '{NOW}' AS check_timestamp FROM checks WHERE check_result = 'FAIL'")
def dq_report(r: Roles) -> DataFrame:
    return q.report(_checks(r), failed_only=True)


@query("dq_report_all", f"{_LOGGED} SELECT table_name, check_type, check_result, affected_rows, '{NOW}' AS check_timestamp FROM checks")
def dq_report_all(r: Roles) -> DataFrame:
    return q.report(_checks(r))


@query("dq_row_counts", "SELECT 'CUSTOMER' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'EVENTS', count(*) FROM events UNION ALL SELECT 'DOCUMENTS', count(*) FROM documents")
def dq_row_counts(r: Roles) -> DataFrame:
    return q.row_counts({n.upper(): r.table(n) for n in ("customer", "events", "documents")})


_METRIC = "'{now}' AS measurement_time, '{table}' AS table_name, '{metric}' AS metric_name, {column} AS column_name, CAST({value} AS BIGINT) AS value".format


def _metric(table: str, metric: str, column: str | None, value: str) -> str:
    return _METRIC(now=NOW, table=table, metric=metric, column="NULL" if column is None else f"'{column}'", value=value)


@query("dqm_null_count", f"WITH {CONTACTS} SELECT {_metric('CONTACTS', 'NULL_COUNT', 'email', 'count(*) - count(email)')} FROM contacts")
def dqm_null_count(r: Roles) -> DataFrame:
    return q.metrics(r.contacts, "CONTACTS", [("NULL_COUNT", "email")], r.now)


@query("dqm_unique_count", f"SELECT {_metric('LINEITEM', 'UNIQUE_COUNT', 'l_partkey', 'count(DISTINCT l_partkey)')} FROM lineitem")
def dqm_unique_count(r: Roles) -> DataFrame:
    return q.metrics(r.table("lineitem"), "LINEITEM", [("UNIQUE_COUNT", "l_partkey")], r.now)


@query("dqm_duplicate_count", f"SELECT {_metric('LINEITEM', 'DUPLICATE_COUNT', 'l_partkey', 'count(l_partkey) - count(DISTINCT l_partkey)')} FROM lineitem")
def dqm_duplicate_count(r: Roles) -> DataFrame:
    return q.metrics(r.table("lineitem"), "LINEITEM", [("DUPLICATE_COUNT", "l_partkey")], r.now)


@query("dqm_row_count", f"SELECT {_metric('LINEITEM', 'ROW_COUNT', None, 'count(*)')} FROM lineitem")
def dqm_row_count(r: Roles) -> DataFrame:
    return q.metrics(r.table("lineitem"), "LINEITEM", [("ROW_COUNT", None)], r.now)


_FRESH = f"date_diff('microsecond', max(ts), TIMESTAMP '{NOW}') // 1000000"


@query("dqm_freshness", f"SELECT {_metric('EVENTS', 'FRESHNESS', 'ts', _FRESH)} FROM events")
def dqm_freshness(r: Roles) -> DataFrame:
    return q.metrics(r.table("events"), "EVENTS", [("FRESHNESS", "ts")], r.now)


@query("dqm_custom_fk", f"""WITH {CHILD}, {PARENT}, {NULL_PARENT}
SELECT {_metric('CHILD', 'FK_EXISTS', 'k', 'count(*)')} FROM child WHERE k NOT IN (SELECT pk FROM parent)""")
def dqm_custom_fk(r: Roles) -> DataFrame:
    return q.fk_metric(child(r), "CHILD", "k", parent(r), "k", r.now)


_SUITE = [("NULL_COUNT", "email"), ("UNIQUE_COUNT", "email"), ("DUPLICATE_COUNT", "risk_tolerance"), ("ROW_COUNT", None)]
_VALUES = ["count(*) - count(email)", "count(DISTINCT email)", "count(risk_tolerance) - count(DISTINCT risk_tolerance)", "count(*)"]


@query("dqm_suite", f"WITH {CONTACTS}, {CHILD}, {PARENT} " + " UNION ALL ".join(
    f"SELECT {_metric('CONTACTS', m, c, v)} FROM contacts" for (m, c), v in zip(_SUITE, _VALUES))
    + f" UNION ALL SELECT {_metric('EVENTS', 'FRESHNESS', 'ts', _FRESH)} FROM events"
    + f" UNION ALL SELECT {_metric('CHILD', 'FK_EXISTS', 'k', 'count(*)')} FROM child WHERE k NOT IN (SELECT pk FROM parent)")
def dqm_suite(r: Roles) -> DataFrame:
    suite = q.Suite()
    for metric, column in _SUITE:
        suite.attach("CONTACTS", metric, column)
    suite.attach("EVENTS", "FRESHNESS", "ts").attach_fk("CHILD", "k", "PARENT", "k")
    tables = {"CONTACTS": r.contacts, "EVENTS": r.table("events"), "CHILD": child(r), "PARENT": parent(r)}
    return q.latest_results(suite.run(tables, r.now))


@query("dqm_incremental", f"""
SELECT 2 AS run, 'ROW_COUNT' AS metric_name, NULL AS column_name, count(*) AS value, count(CASE WHEN o_orderkey % 4 <> 0 THEN 1 END) AS previous FROM orders
UNION ALL SELECT 2, 'UNIQUE_COUNT', 'o_custkey', count(DISTINCT o_custkey), count(DISTINCT CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END) FROM orders
UNION ALL SELECT 2, 'DUPLICATE_COUNT', 'o_custkey', count(o_custkey) - count(DISTINCT o_custkey),
  count(CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END) - count(DISTINCT CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END) FROM orders
UNION ALL SELECT 2, 'NULL_COUNT', 'status', count(CASE WHEN o_orderkey % 9 = 0 THEN 1 END), count(CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 9 = 0 THEN 1 END) FROM orders""")
def dqm_incremental(r: Roles) -> DataFrame:
    """Metrics of a table to which rows are added between two runs: the second reads the added files only."""
    path, key = workspace(r.spark, "measured"), F.col("o_orderkey")
    orders = r.table("orders").select("o_orderkey", "o_custkey", F.when(key % 9 != 0, F.col("o_orderstatus")).alias("status"))
    store = MetricStore(workspace(r.spark, "metrics"), "ORDERS", [("ROW_COUNT", None), ("UNIQUE_COUNT", "o_custkey"), ("DUPLICATE_COUNT", "o_custkey"), ("NULL_COUNT", "status")])
    for run, rows in ((1, orders.filter(key % 4 != 0)), (2, orders.filter(key % 4 == 0))):
        rows.write.mode("append").parquet(path)
        store.run(r.spark, path, run, dt.datetime(2024, 1, run))
    return store.trend(r.spark).select(F.lit(2).alias("run"), "metric_name", "column_name", "value", "previous")
