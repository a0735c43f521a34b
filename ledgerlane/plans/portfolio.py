"""Valuation, profit and loss, sector mix, target deviation and concentration.

Column names follow the stored tables: holdings(customer_id, stock_code, quantity,
avg_purchase_price, purchase_date), prices(stock_code, stock_name, sector, price_date,
closing_price), customers(customer_id, customer_name, risk_tolerance, sales_rep),
targets(risk_tolerance, sector, target_ratio). Customer ids are unique in customers and stock
codes in (latest) prices.

Order of work in every report: value the holdings (join on the stock), aggregate to the grain of
the report, and only then join the customer. A customer that owns a third of all positions is
reduced to a few rows by the partial aggregation before anything is moved by customer.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import as_column, mean_of, percent, share_exact
from ..functions.temporal import days_between
from ..functions.text import label
from ..operators.joins import spread_join
from ..operators.latest import latest_per_key
from ..operators.reshape import fixed_pivot, max_pivot

# Limits and words that appear in results.
THRESHOLD = 5
HHI_HIGH, HHI_MEDIUM = 3000, 2500
GAIN, LOSS, FLAT = "含み益", "含み損", "±0"
OVERWEIGHT, UNDERWEIGHT, ON_TARGET = "オーバーウェイト", "アンダーウェイト", "適正"
RISK_LABELS = {"バランス": "Balanced", "保守的": "Conservative", "積極的": "Aggressive"}
PIVOT_SECTORS = ["自動車", "電機", "銀行", "通信", "医薬品"]
OTHER_SECTORS = "その他"

ALLOCATION_KEY = ["snapshot_date", "customer_id", "sector"]
SNAPSHOT_KEY = ["snapshot_date", "customer_id", "stock_code"]


def latest_prices(prices: DataFrame) -> DataFrame:
    """One row per stock: the newest price. Equal dates are settled by the other columns."""
    rest = [c for c in prices.columns if c not in ("stock_code", "price_date")]
    return latest_per_key(prices, ["stock_code"], ["price_date", *rest])


def positions(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """Holdings with their price: book value, market value, profit. Unpriced holdings drop out.

    A stock that many customers hold is the hot key here, so the join is spread.
    """
    priced = prices.select("stock_code", "stock_name", "sector", "price_date", F.col("closing_price").alias("current_price"))
    book = F.col("quantity") * F.col("avg_purchase_price")
    market = F.col("quantity") * F.col("current_price")
    return (
        spread_join(holdings, priced, ["stock_code"], spread_by=["customer_id"])
        .withColumns({"book_value": book, "market_value": market})
        .withColumn("unrealized_pl", F.col("market_value") - F.col("book_value"))
    )


def _with_customer(df: DataFrame, customers: DataFrame, columns: list[str]) -> DataFrame:
    """Add customer columns.

    Totals have a few rows per customer and are partitioned by customer already, so a plain join
    moves only the customers. Detail rows come straight from a shuffle and nothing after the join
    needs their partitioning, so adaptive execution can split a customer with very many positions.
    """
    return df.join(customers.select("customer_id", *columns), ["customer_id"])


def valuation(pos: DataFrame, customers: DataFrame) -> DataFrame:
    """Every position with its book and market value."""
    return _with_customer(pos, customers, ["customer_name"]).select(
        "customer_id", "customer_name", "stock_code", "stock_name", "sector", "quantity", "avg_purchase_price",
        "current_price", "book_value", "market_value", F.col("price_date").alias("valuation_date"),
    )


def customer_value(pos: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer: number of stocks, book value, market value."""
    totals = pos.groupBy("customer_id").agg(
        F.count_distinct("stock_code").alias("num_holdings"),
        F.sum("book_value").alias("total_book_value"),
        F.sum("market_value").alias("total_market_value"),
    )
    return _with_customer(totals, customers, ["customer_name", "risk_tolerance"]).select(
        "customer_id", "customer_name", "risk_tolerance", "num_holdings", "total_book_value", "total_market_value",
        F.round("total_market_value", 0).alias("total_market_value_rounded"),
    )


def pl_status(pl) -> Column:
    return F.when(pl > 0, GAIN).when(pl < 0, LOSS).otherwise(FLAT)


def unrealized(pos: DataFrame, customers: DataFrame) -> DataFrame:
    """Every position with profit, percentage, label and holding days."""
    pl = F.col("unrealized_pl")
    return _with_customer(pos, customers, ["customer_name"]).select(
        "customer_id", "customer_name", "stock_code", "stock_name", "sector", "quantity", "avg_purchase_price",
        "current_price", "book_value", "market_value", "unrealized_pl",
        percent(pl, "book_value", 2).alias("unrealized_pl_pct"),
        pl_status(pl).alias("pl_status"),
        "purchase_date",
        days_between("purchase_date", "price_date").alias("holding_days"),
    )


def customer_pl(pos: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer: totals, return and number of winning and losing positions."""
    pl = F.col("unrealized_pl")
    totals = pos.groupBy("customer_id").agg(
        F.count_distinct("stock_code").alias("num_holdings"),
        F.sum("book_value").alias("total_book_value"),
        F.sum("market_value").alias("total_market_value"),
        F.sum(pl).alias("total_unrealized_pl"),
        F.count_if(pl > 0).alias("profit_holdings"),
        F.count_if(pl < 0).alias("loss_holdings"),
    )
    return _with_customer(totals, customers, ["customer_name", "risk_tolerance", "sales_rep"]).select(
        "customer_id", "customer_name", "risk_tolerance", "sales_rep", "num_holdings", "total_book_value",
        "total_market_value", "total_unrealized_pl",
        percent("total_unrealized_pl", "total_book_value", 2).alias("total_return_pct"),
        "profit_holdings", "loss_holdings",
    )


def sector_values(pos: DataFrame) -> DataFrame:
    return pos.groupBy("customer_id", "sector").agg(F.sum("market_value").alias("sector_market_value"))


def sector_mix(pos: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer and sector: value and share of the customer's total.

    The total is a window over the aggregated rows: a customer has at most one row per sector
    there, whatever the number of positions.
    """
    total = F.sum("sector_market_value").over(Window.partitionBy("customer_id"))
    mix = sector_values(pos).withColumn("total_market_value", total)
    return _with_customer(mix, customers, ["customer_name", "risk_tolerance"]).select(
        "customer_id", "customer_name", "risk_tolerance", "sector", "sector_market_value", "total_market_value",
        percent("sector_market_value", "total_market_value", 2).alias("allocation_ratio"),
    )


def sector_pivot(pos: DataFrame, customers: DataFrame, sectors: list[str] = PIVOT_SECTORS, other: str = OTHER_SECTORS) -> DataFrame:
    """Per customer: share of the named sectors and of all other ones, in percent."""
    names = {s: f"{s}_pct" for s in sectors}
    wide = fixed_pivot(pos, ["customer_id"], "sector", names, F.col("market_value"), f"{other}_pct")
    shares = [percent(F.col(f"`{n}`"), "total", 2).alias(n) for n in [*names.values(), f"{other}_pct"]]
    return _with_customer(wide, customers, ["customer_name", "risk_tolerance"]).select(
        "customer_id", "customer_name", "risk_tolerance", *shares, F.col("total").alias("total_market_value")
    )


def snapshot(pos: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """The day's valuation rows, keyed by (snapshot_date, customer_id, stock_code)."""
    return pos.select(
        as_column(as_of).cast("date").alias("snapshot_date"), "customer_id", "stock_code", "stock_name", "sector", "quantity",
        "avg_purchase_price", "current_price", "market_value", "unrealized_pl",
        percent("unrealized_pl", "book_value", 4).alias("unrealized_pl_pct"),
    )


def snapshot_check(snapshots: DataFrame) -> DataFrame:
    """Per snapshot date: rows, customers, value."""
    return snapshots.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("market_value").alias("total_market_value"),
    )


def snapshot_detail(snapshots: DataFrame, as_of: Column | dt.date) -> DataFrame:
    return snapshots.filter(F.col("snapshot_date") == as_of).orderBy("customer_id", F.col("market_value").desc(), "stock_code")


def allocation(snapshots: DataFrame, customers: DataFrame, targets: DataFrame, as_of: Column | dt.date, threshold: float = THRESHOLD) -> DataFrame:
    """Sector share against target for one snapshot date.

    Held sectors drive the comparison: a sector without target counts as target 0, a target
    without holding does not appear. The flag looks at the deviation before rounding.
    """
    values = (
        snapshots.filter(F.col("snapshot_date") == as_of)
        .groupBy("snapshot_date", "customer_id", "sector")
        .agg(F.sum("market_value").alias("market_value"))
    )
    total = F.sum("market_value").over(Window.partitionBy("snapshot_date", "customer_id"))
    shares = _with_customer(
        values.withColumn("share", share_exact("market_value", total)), customers, ["risk_tolerance"]
    )
    compared = spread_join(shares, targets, ["risk_tolerance", "sector"], "left", ["customer_id"])
    target = F.coalesce(F.col("target_ratio"), F.lit(0)).cast("decimal(5,2)")
    gap = F.col("share") - target
    return compared.select(
        "snapshot_date", "customer_id", "risk_tolerance", "sector", "market_value",
        F.round("share", 2).alias("allocation_ratio"),
        target.alias("target_ratio"),
        F.round(gap, 2).alias("deviation"),
        F.coalesce(F.abs(gap) > threshold, F.lit(False)).alias("rebalance_flag"),
    )


def allocation_detail(alloc: DataFrame, as_of: Column | dt.date) -> DataFrame:
    return alloc.filter(F.col("snapshot_date") == as_of).orderBy("customer_id", F.abs("deviation").desc(), "sector")


def misallocated(alloc: DataFrame, customers: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """Flagged rows with an over/under label, greatest deviation first."""
    flagged = alloc.filter((F.col("snapshot_date") == as_of) & F.col("rebalance_flag"))
    deviation = F.col("deviation")
    return _with_customer(flagged, customers, ["customer_name", "sales_rep"]).select(
        "customer_id", "customer_name", "risk_tolerance", "sales_rep", "sector",
        F.col("allocation_ratio").alias("current_ratio"), "target_ratio", "deviation",
        F.when(deviation > 0, OVERWEIGHT).when(deviation < 0, UNDERWEIGHT).otherwise(ON_TARGET).alias("allocation_status"),
        F.col("market_value").alias("sector_value"),
    ).orderBy(F.abs("deviation").desc(), "customer_id", "sector")


def customer_deviation(alloc: DataFrame, customers: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """Per customer with at least one flagged sector: counts, mean and greatest deviation, greatest mean first."""
    gap = F.abs("deviation")
    per_customer = (
        alloc.filter(F.col("snapshot_date") == as_of)
        .groupBy("customer_id", "risk_tolerance")
        .agg(
            F.count(F.lit(1)).alias("total_sectors"),
            F.count_if(F.col("rebalance_flag")).alias("sectors_need_rebalance"),
            mean_of(F.sum(gap), F.count(gap)).alias("avg_abs_deviation"),
            F.round(F.max(gap), 2).alias("max_abs_deviation"),
            F.sum("market_value").alias("total_portfolio_value"),
        )
        .filter(F.col("sectors_need_rebalance") > 0)
    )
    return _with_customer(per_customer, customers, ["customer_name", "sales_rep"]).select(
        "customer_id", "customer_name", "risk_tolerance", "sales_rep", "total_sectors", "sectors_need_rebalance",
        "avg_abs_deviation", "max_abs_deviation", "total_portfolio_value",
    ).orderBy(F.col("avg_abs_deviation").desc(), "customer_id")


def risk_deviation(alloc: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """Per risk class: customers, mean deviation, flagged and all rows."""
    gap = F.abs("deviation")
    return alloc.filter(F.col("snapshot_date") == as_of).groupBy("risk_tolerance").agg(
        F.count_distinct("customer_id").alias("customer_count"),
        mean_of(F.sum(gap), F.count(gap)).alias("avg_abs_deviation"),
        F.count_if(F.col("rebalance_flag")).alias("rebalance_needed_count"),
        F.count(F.lit(1)).alias("total_allocations"),
    )


def deviation_matrix(alloc: DataFrame, as_of: Column | dt.date, sectors: list[str] = PIVOT_SECTORS) -> DataFrame:
    """Customer by sector, the deviation or NULL."""
    day = alloc.filter(F.col("snapshot_date") == as_of)
    return max_pivot(day, ["customer_id"], "sector", {s: f"{s}_deviation" for s in sectors}, "deviation")


def performance_detail(pos: DataFrame, customers: DataFrame) -> DataFrame:
    """Positions with the row return used by the performance summaries."""
    return _with_customer(pos, customers, ["customer_name", "risk_tolerance"]).select(
        "customer_id", "customer_name", "risk_tolerance", "stock_code", "stock_name", "sector", "quantity",
        "avg_purchase_price", "current_price",
        F.col("book_value").alias("investment_value"),
        F.col("market_value").alias("current_value"),
        percent(F.col("current_price") - F.col("avg_purchase_price"), "avg_purchase_price", 2).alias("return_pct"),
    )


def _overall(df: DataFrame, name: str) -> DataFrame:
    gain = F.col("total_current") - F.col("total_investment")
    return df.withColumn(name, percent(gain, "total_investment", 2))


def segment_performance(pos: DataFrame, customers: DataFrame) -> DataFrame:
    """Per risk class: unweighted mean of row returns next to the return of the sums.

    Sums per customer come first; the risk class is joined to those.
    """
    returns = percent(F.col("current_price") - F.col("avg_purchase_price"), "avg_purchase_price", 2)
    per_customer = pos.withColumn("return_pct", returns).groupBy("customer_id").agg(
        F.sum("return_pct").alias("sum_return"),
        F.count("return_pct").alias("n_return"),
        F.sum("book_value").alias("investment"),
        F.sum("market_value").alias("current"),
        F.count("stock_code").alias("stocks"),
    )
    segments = _with_customer(per_customer, customers, ["risk_tolerance"]).groupBy("risk_tolerance").agg(
        mean_of(F.sum("sum_return"), F.sum("n_return"), 6).alias("avg_return"),
        F.sum("investment").alias("total_investment"),
        F.sum("current").alias("total_current"),
        F.sum("stocks").alias("stock_count"),
    )
    return _overall(segments, "overall_return_pct")


def label_segments(df: DataFrame, labels: dict[str, str] = RISK_LABELS) -> DataFrame:
    return df.withColumn("risk_label", label("risk_tolerance", labels))


def rebalance_list(alloc: DataFrame, customers: DataFrame, as_of: Column | dt.date, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose stored deviation is at least the threshold (equality included), greatest first."""
    rows = alloc.filter((F.col("snapshot_date") == as_of) & (F.abs("deviation") >= threshold)).drop("risk_tolerance")
    return _with_customer(rows, customers, ["customer_name", "risk_tolerance"]).select(
        "customer_id", "customer_name", "risk_tolerance", "sector",
        F.col("allocation_ratio").alias("actual_pct"), F.col("target_ratio").alias("target_pct"),
        "deviation", "rebalance_flag",
    ).orderBy(F.abs("deviation").desc(), "customer_id", "sector")


def rebalance_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_distinct("customer_id").alias("customers"), F.count(F.lit(1)).alias("deviations"))


def sector_performance(pos: DataFrame) -> DataFrame:
    """Per sector: mean row return, totals, stocks, holders and return of the sums.

    The distinct counts are planned on (sector, stock) and (sector, customer), so a large sector
    is spread over all tasks before its last, small merge.
    """
    returns = percent(F.col("current_price") - F.col("avg_purchase_price"), "avg_purchase_price", 2)
    totals = pos.withColumn("return_pct", returns).groupBy("sector").agg(
        mean_of(F.sum("return_pct"), F.count("return_pct"), 6).alias("avg_return"),
        F.sum("book_value").alias("total_investment"),
        F.sum("market_value").alias("total_current"),
        F.count_distinct("stock_code").alias("stock_count"),
        F.count_distinct("customer_id").alias("holder_count"),
    )
    return _overall(totals, "overall_return")


def hhi(pos: DataFrame) -> DataFrame:
    """Concentration per customer: sum of squared sector shares (percent), 0 to 10000.

    Short positions can push a share beyond 100 percent; shares of up to nine digits are exact.
    """
    total = F.sum("sector_market_value").over(Window.partitionBy("customer_id"))
    shares = sector_values(pos.filter(F.col("sector").isNotNull())).withColumn("share", share_exact("sector_market_value", total))
    exact = F.col("share").cast("decimal(15,6)")
    squared = exact * exact
    return shares.groupBy("customer_id").agg(F.round(F.sum(squared), 4).alias("hhi"))


def hhi_band(concentration: DataFrame) -> DataFrame:
    band = F.when(F.col("hhi") > HHI_HIGH, "high").when(F.col("hhi") > HHI_MEDIUM, "medium").otherwise("low")
    return concentration.withColumn("band", band)


def customer_summary(pos: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer: positions, invested and current value, return in percent."""
    totals = pos.groupBy("customer_id").agg(
        F.count("stock_code").alias("stock_count"),
        F.sum("book_value").alias("total_investment"),
        F.sum("market_value").alias("total_current_value"),
    )
    gain = F.col("total_current_value") - F.col("total_investment")
    return _with_customer(totals, customers, ["customer_name", "risk_tolerance"]).select(
        "customer_id", "customer_name", "risk_tolerance", "stock_count", "total_investment", "total_current_value",
        percent(gain, "total_investment", 2).alias("overall_return_pct"),
    )


def segment_summary(summary: DataFrame) -> DataFrame:
    """Per risk class over the customer summary: mean of the rounded returns, totals."""
    pct = F.col("overall_return_pct")
    return summary.groupBy("risk_tolerance").agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean_of(F.sum(pct), F.count(pct)).alias("avg_return_pct"),
        F.sum("total_investment").alias("total_investment"),
        F.sum("total_current_value").alias("total_current_value"),
    )
