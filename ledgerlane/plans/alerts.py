"""Rebalancing alerts, their two re-issue policies, and the reports per sales representative."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import as_column, mean_of
from ..functions.text import NEWLINE, joined
from ..operators.latest import top_per_key
from ..operators.reshape import text_list
from ..operators.tables import close_and_reissue, insert_if_absent
from ..session import materialize

# Words of the alert texts, the status marks, and the layout of the message.
THRESHOLD = 5
OPEN, CLOSED = "OPEN", "CLOSED"
SELL_HEAD, SELL_MIDDLE, SELL_TAIL = "【売却推奨】", "が目標比率より", "%過大です。一部売却をご検討ください。"
BUY_HEAD, BUY_MIDDLE, BUY_TAIL = "【買付推奨】", "が目標比率より", "%不足です。追加購入をご検討ください。"
MESSAGE_TITLE = "【ポートフォリオリバランスアラート】"
MESSAGE_HONORIFIC = " 様"
MESSAGE_GREETING = "本日のリバランスアラートをお知らせします。"
MESSAGE_CUSTOMERS, MESSAGE_CUSTOMERS_UNIT = "対応が必要な顧客: ", "名"
MESSAGE_ALERTS, MESSAGE_ALERTS_UNIT = "アラート件数: ", "件"
MESSAGE_DETAIL = "【詳細】"
MESSAGE_DETAIL_LEAD = "以下の顧客に対してリバランス提案が必要です。"
MESSAGE_BULLET, MESSAGE_SLASH = "・", " / "
MESSAGE_GAP, MESSAGE_GAP_END = " (乖離: ", "%)"
MESSAGE_INDENT = "  "
MESSAGE_FOOTER = "詳細はポートフォリオ管理システムをご確認ください。"
MESSAGE_AUTO = "※このメールは自動送信されています。"
MESSAGE_ROWS = 10

ALERT_KEY = ["alert_date", "customer_id", "sector"]
ALERT_COLUMNS = [
    "alert_date", "customer_id", "customer_name", "risk_tolerance", "sales_rep", "sector", "current_ratio",
    "target_ratio", "deviation", "recommended_action",
]


def action_text(sector, deviation) -> Column:
    """Sell or buy sentence from the stored deviation; NULL when it is within the limit."""
    sector, deviation = F.col(sector), F.col(deviation)
    size = F.round(F.abs(deviation), 1).cast("string")
    return F.when(deviation > THRESHOLD, joined(SELL_HEAD, sector, SELL_MIDDLE, size, SELL_TAIL)).when(
        deviation < -THRESHOLD, joined(BUY_HEAD, sector, BUY_MIDDLE, size, BUY_TAIL)
    )


def alerts(alloc: DataFrame, customers: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """One alert per flagged allocation row of the day (without status)."""
    flagged = alloc.filter((F.col("snapshot_date") == as_of) & F.col("rebalance_flag"))
    named = flagged.join(customers.select("customer_id", "customer_name", "sales_rep"), ["customer_id"])
    return named.select(
        as_column(as_of).cast("date").alias("alert_date"), "customer_id", "customer_name", "risk_tolerance", "sales_rep", "sector",
        F.col("allocation_ratio").alias("current_ratio"), "target_ratio", "deviation",
        action_text("sector", "deviation").alias("recommended_action"),
    )


def with_status(rows: DataFrame, status: str = OPEN) -> DataFrame:
    return rows.withColumn("alert_status", F.lit(status))


def issue_missing(existing: DataFrame, current: DataFrame) -> DataFrame:
    """Add only alerts that are not there yet for (date, customer, sector), whatever their status."""
    return insert_if_absent(existing, with_status(current), ALERT_KEY)


def reissue(existing: DataFrame, current: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """Close the day's open alerts and issue all current ones."""
    return close_and_reissue(existing, current, "alert_date", as_of, opened=OPEN, closed=CLOSED)


def on_day(rows: DataFrame, as_of: Column | dt.date, open_only: bool = False) -> DataFrame:
    day = rows.filter(F.col("alert_date") == as_of)
    return day.filter(F.col("alert_status") == OPEN) if open_only else day


def today(rows: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """The day's alerts, greatest deviation first."""
    return on_day(rows, as_of).select(*ALERT_COLUMNS, "alert_status").orderBy(F.abs("deviation").desc(), "customer_id", "sector")


def rep_alerts(rows: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """Per representative: customers, open alerts, mean deviation."""
    gap = F.abs("deviation")
    return on_day(rows, as_of, True).groupBy("sales_rep").agg(
        F.count_distinct("customer_id").alias("customers_need_action"),
        F.count(F.lit(1)).alias("total_alerts"),
        mean_of(F.sum(gap), F.count(gap)).alias("avg_deviation"),
    )


def rep_summary(rows: DataFrame) -> DataFrame:
    """Per representative and day: counts, list of customers, mean and greatest deviation.

    The open alerts are written once; counts and lists come from there.
    """
    gap = F.abs("deviation")
    keys = ["sales_rep", "alert_date"]
    open_rows = rows.filter(F.col("alert_status") == OPEN).select(*keys, "customer_id", "customer_name", "deviation")
    open_rows = materialize(open_rows, "open-alerts")
    counts = open_rows.groupBy(*keys).agg(
        F.count_distinct("customer_id").alias("customers_need_action"),
        F.count(F.lit(1)).alias("total_alerts"),
        mean_of(F.sum(gap), F.count(gap)).alias("avg_deviation"),
        F.max(gap).alias("max_deviation"),
    )
    names = text_list(open_rows, keys, "customer_name", "customer_list").withColumnsRenamed({k: f"__{k}" for k in keys})
    same = F.col("sales_rep").eqNullSafe(F.col("__sales_rep")) & F.col("alert_date").eqNullSafe(F.col("__alert_date"))
    return counts.join(names, same, "left").drop("__sales_rep", "__alert_date")


def rep_detail(rows: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """Open alerts of the day for the mail report, by representative and size."""
    return on_day(rows, as_of, True).select(
        "sales_rep", "customer_id", "customer_name", "risk_tolerance", "sector", "current_ratio", "target_ratio",
        "deviation", "recommended_action",
    ).orderBy("sales_rep", F.abs("deviation").desc(), "customer_id", "sector")


def rep_message(rows: DataFrame, as_of: Column | dt.date, n: int = MESSAGE_ROWS, reps: DataFrame | None = None) -> DataFrame:
    """One mail text per representative: counts of all open alerts and the ``n`` largest ones.

    Set based: rank per representative (only n rows per task reach the shuffle), then join the
    lines of a representative in rank order. The day's open alerts are written once. ``reps`` (sales_rep) names who gets a
    message; one without alerts gets its counts of 0. Without it, only those with alerts do.
    """
    day = on_day(rows, as_of, True).filter(F.col("sales_rep").isNotNull())
    day = materialize(day.select("sales_rep", "customer_id", "customer_name", "sector", "deviation", "recommended_action"), "open-alerts")
    counts = day.groupBy("sales_rep").agg(
        F.count_distinct("customer_id").alias("customers"), F.count(F.lit(1)).alias("alerts")
    )
    size = F.abs("deviation")
    best = top_per_key(day, ["sales_rep"], [size.desc(), F.col("customer_id").asc(), F.col("sector").asc()], n)
    line = F.concat(
        F.lit(MESSAGE_BULLET), F.col("customer_name"), F.lit(MESSAGE_SLASH), F.col("sector"),
        F.lit(MESSAGE_GAP), F.round("deviation", 1).cast("string"), F.lit(MESSAGE_GAP_END), F.lit(NEWLINE),
        F.lit(MESSAGE_INDENT), F.coalesce("recommended_action", F.lit("")), F.lit(NEWLINE * 2),
    )
    ordered = F.array_sort(F.collect_list(F.struct((-size).alias("k"), "customer_id", "sector", line.alias("line"))))
    lines = best.groupBy("sales_rep").agg(F.array_join(F.transform(ordered, lambda r: r["line"]), "").alias("lines"))
    body = F.concat(
        F.lit(NEWLINE + MESSAGE_TITLE + NEWLINE * 2), F.col("sales_rep"), F.lit(MESSAGE_HONORIFIC + NEWLINE * 2),
        F.lit(MESSAGE_GREETING + NEWLINE),
        F.lit(MESSAGE_CUSTOMERS), F.col("customers").cast("string"), F.lit(MESSAGE_CUSTOMERS_UNIT + NEWLINE),
        F.lit(MESSAGE_ALERTS), F.col("alerts").cast("string"), F.lit(MESSAGE_ALERTS_UNIT + NEWLINE * 2),
        F.lit(MESSAGE_DETAIL + NEWLINE + MESSAGE_DETAIL_LEAD + NEWLINE * 2),
        F.col("lines"), F.lit(MESSAGE_FOOTER + NEWLINE * 2 + MESSAGE_AUTO),
    )
    found = counts.join(lines, ["sales_rep"])
    if reps is not None:
        named = reps.select("sales_rep").filter(F.col("sales_rep").isNotNull()).distinct().join(found, ["sales_rep"], "left")
        found = named.withColumns({"customers": F.coalesce("customers", F.lit(0)), "alerts": F.coalesce("alerts", F.lit(0)), "lines": F.coalesce("lines", F.lit(""))})
    return found.select("sales_rep", "customers", "alerts", body.alias("body"))
