"""Portfolio analytics over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans import alerts as al, portfolio as pf
from .registry import query
from .roles import ALERTS, ALLOC, AS_OF, CUSTOMERS, POS, SECTORS, Roles, dbl, mean, pct, share, text

PIVOT = SECTORS[:5]


@query("pf_valuation", f"""{POS}
SELECT p.customer_id, c.customer_name, stock_code, stock_name, sector, {dbl('quantity')} AS quantity,
  {dbl('avg_purchase_price')} AS avg_purchase_price, {dbl('current_price')} AS current_price,
  {dbl('book_value')} AS book_value, {dbl('market_value')} AS market_value, {text('price_date')} AS valuation_date
FROM pos p JOIN customers c ON p.customer_id = c.customer_id""")
def valuation(r: Roles) -> DataFrame:
    return pf.valuation(r.positions, r.customers)


@query("pf_customer_value", f"""{POS}
SELECT c.customer_id, c.customer_name, c.risk_tolerance, count(DISTINCT stock_code) AS num_holdings,
  {dbl('sum(book_value)')} AS total_book_value, {dbl('sum(market_value)')} AS total_market_value,
  {dbl('round(sum(market_value), 0)')} AS total_market_value_rounded
FROM pos p JOIN customers c ON p.customer_id = c.customer_id
GROUP BY c.customer_id, c.customer_name, c.risk_tolerance""")
def customer_value(r: Roles) -> DataFrame:
    return pf.customer_value(r.positions, r.customers)


@query("pf_unrealized", f"""{POS}
SELECT p.customer_id, c.customer_name, stock_code, stock_name, sector, {dbl('quantity')} AS quantity,
  {dbl('avg_purchase_price')} AS avg_purchase_price, {dbl('current_price')} AS current_price,
  {dbl('book_value')} AS book_value, {dbl('market_value')} AS market_value, {dbl('unrealized_pl')} AS unrealized_pl,
  {pct('unrealized_pl', 'book_value')} AS unrealized_pl_pct,
  CASE sign(unrealized_pl) WHEN 1 THEN '{pf.GAIN}' WHEN -1 THEN '{pf.LOSS}' ELSE '{pf.FLAT}' END AS pl_status,
  {text('purchase_date')} AS purchase_date, CAST(date_diff('day', purchase_date, price_date) AS INTEGER) AS holding_days
FROM pos p JOIN customers c ON p.customer_id = c.customer_id""")
def unrealized(r: Roles) -> DataFrame:
    return pf.unrealized(r.positions, r.customers)


@query("pf_customer_pl", f"""{POS}
SELECT c.customer_id, c.customer_name, c.risk_tolerance, c.sales_rep, count(DISTINCT stock_code) AS num_holdings,
  {dbl('sum(book_value)')} AS total_book_value, {dbl('sum(market_value)')} AS total_market_value,
  {dbl('sum(unrealized_pl)')} AS total_unrealized_pl, {pct('sum(unrealized_pl)', 'sum(book_value)')} AS total_return_pct,
  count(CASE WHEN unrealized_pl > 0 THEN 1 END) AS profit_holdings, count(CASE WHEN unrealized_pl < 0 THEN 1 END) AS loss_holdings
FROM pos p JOIN customers c ON p.customer_id = c.customer_id
GROUP BY c.customer_id, c.customer_name, c.risk_tolerance, c.sales_rep""")
def customer_pl(r: Roles) -> DataFrame:
    return pf.customer_pl(r.positions, r.customers)


@query("pf_sector_mix", f"""{POS},
sums AS (SELECT customer_id, sector, sum(market_value) AS v FROM pos GROUP BY customer_id, sector),
totals AS (SELECT customer_id, sum(v) AS total FROM sums GROUP BY customer_id)
SELECT s.customer_id, c.customer_name, c.risk_tolerance, s.sector, {dbl('s.v')} AS sector_market_value,
  {dbl('t.total')} AS total_market_value, {pct('s.v', 't.total')} AS allocation_ratio
FROM sums s JOIN totals t ON s.customer_id = t.customer_id JOIN customers c ON s.customer_id = c.customer_id""")
def sector_mix(r: Roles) -> DataFrame:
    return pf.sector_mix(r.positions, r.customers)


def _cell(sector: str) -> str:
    return f"sum(CASE WHEN sector = '{sector}' THEN market_value ELSE 0 END)"


_REST = f"sum(CASE WHEN sector NOT IN ({', '.join(repr(s) for s in PIVOT)}) THEN market_value ELSE 0 END)"


@query("pf_sector_pivot", f"""{POS}
SELECT c.customer_id, c.customer_name, c.risk_tolerance,
  {', '.join(f"{pct(_cell(s), 'sum(market_value)')} AS {s}_pct" for s in PIVOT)},
  {pct(_REST, 'sum(market_value)')} AS OTHER_pct, {dbl('sum(market_value)')} AS total_market_value
FROM pos p JOIN customers c ON p.customer_id = c.customer_id GROUP BY c.customer_id, c.customer_name, c.risk_tolerance""")
def sector_pivot(r: Roles) -> DataFrame:
    return pf.sector_pivot(r.positions, r.customers, PIVOT, "OTHER")


@query("pf_snapshot_check", f"""{POS}
SELECT '{AS_OF}' AS snapshot_date, count(*) AS record_count, count(DISTINCT customer_id) AS customer_count,
  {dbl('sum(market_value)')} AS total_market_value FROM pos""")
def snapshot_check(r: Roles) -> DataFrame:
    return pf.snapshot_check(r.snapshots)


@query("pf_snapshot_detail", f"""{POS}
SELECT '{AS_OF}' AS snapshot_date, customer_id, stock_code, stock_name, sector, {dbl('quantity')} AS quantity,
  {dbl('avg_purchase_price')} AS avg_purchase_price, {dbl('current_price')} AS current_price, {dbl('market_value')} AS market_value,
  {dbl('unrealized_pl')} AS unrealized_pl, {pct('unrealized_pl', 'book_value', 4)} AS unrealized_pl_pct
FROM pos""")
def snapshot_detail(r: Roles) -> DataFrame:
    return pf.snapshot_detail(r.snapshots, r.as_of)


_ALLOC_COLUMNS = f"""'{AS_OF}' AS snapshot_date, customer_id, risk_tolerance, sector, {dbl('market_value')} AS market_value,
  {dbl('allocation_ratio')} AS allocation_ratio, {dbl('target_ratio')} AS target_ratio, {dbl('deviation')} AS deviation, rebalance_flag"""


@query("pf_allocation", f"{ALLOC} SELECT {_ALLOC_COLUMNS} FROM alloc")
def allocation(r: Roles) -> DataFrame:
    return r.allocation


@query("pf_allocation_detail", f"{ALLOC} SELECT {_ALLOC_COLUMNS} FROM alloc")
def allocation_detail(r: Roles) -> DataFrame:
    return pf.allocation_detail(r.allocation, r.as_of)


@query("pf_misallocated", f"""{ALLOC}
SELECT a.customer_id, c.customer_name, a.risk_tolerance, c.sales_rep, a.sector, {dbl('allocation_ratio')} AS current_ratio,
  {dbl('target_ratio')} AS target_ratio, {dbl('deviation')} AS deviation,
  CASE sign(deviation) WHEN 1 THEN '{pf.OVERWEIGHT}' WHEN -1 THEN '{pf.UNDERWEIGHT}' ELSE '{pf.ON_TARGET}' END AS allocation_status,
  {dbl('market_value')} AS sector_value
FROM alloc a JOIN customers c ON a.customer_id = c.customer_id WHERE rebalance_flag""")
def misallocated(r: Roles) -> DataFrame:
    return pf.misallocated(r.allocation, r.customers, r.as_of)


@query("pf_customer_deviation", f"""{ALLOC}
SELECT a.customer_id, c.customer_name, a.risk_tolerance, c.sales_rep, count(*) AS total_sectors,
  CAST(sum(CASE WHEN rebalance_flag THEN 1 ELSE 0 END) AS BIGINT) AS sectors_need_rebalance,
  {mean('sum(abs(deviation))', 'count(deviation)')} AS avg_abs_deviation, {dbl('max(abs(deviation))')} AS max_abs_deviation,
  {dbl('sum(market_value)')} AS total_portfolio_value
FROM alloc a JOIN customers c ON a.customer_id = c.customer_id
GROUP BY a.customer_id, c.customer_name, a.risk_tolerance, c.sales_rep HAVING sum(CASE WHEN rebalance_flag THEN 1 ELSE 0 END) > 0""")
def customer_deviation(r: Roles) -> DataFrame:
    return pf.customer_deviation(r.allocation, r.customers, r.as_of)


@query("pf_risk_deviation", f"""{ALLOC}
SELECT risk_tolerance, count(DISTINCT customer_id) AS customer_count,
  {mean('sum(abs(deviation))', 'count(deviation)')} AS avg_abs_deviation,
  count(CASE WHEN rebalance_flag THEN 1 END) AS rebalance_needed_count, count(*) AS total_allocations
FROM alloc GROUP BY risk_tolerance""")
def risk_deviation(r: Roles) -> DataFrame:
    return pf.risk_deviation(r.allocation, r.as_of)


@query("pf_deviation_matrix", f"""{ALLOC}
SELECT customer_id, {', '.join(f"{dbl(f'max(CASE WHEN sector = {s!r} THEN deviation END)')} AS {s}_deviation" for s in PIVOT)}
FROM alloc GROUP BY customer_id""")
def deviation_matrix(r: Roles) -> DataFrame:
    return pf.deviation_matrix(r.allocation, r.as_of, PIVOT)


_ALERT_COLUMNS = f"""'{AS_OF}' AS alert_date, customer_id, customer_name, risk_tolerance, sales_rep, sector,
  {dbl('current_ratio')} AS current_ratio, {dbl('target_ratio')} AS target_ratio, {dbl('deviation')} AS deviation, recommended_action"""


@query("pf_alert_text", f"{ALERTS} SELECT {_ALERT_COLUMNS} FROM alert_rows")
def alert_text(r: Roles) -> DataFrame:
    return al.alerts(r.allocation, r.customers, r.as_of)


@query("pf_alerts_today", f"{ALERTS} SELECT {_ALERT_COLUMNS}, alert_status FROM alert_rows")
def alerts_today(r: Roles) -> DataFrame:
    return al.today(r.alerts, r.as_of)


@query("pf_rep_alerts", f"""{ALERTS}
SELECT sales_rep, count(DISTINCT customer_id) AS customers_need_action, count(*) AS total_alerts,
  {mean('sum(abs(deviation))', 'count(deviation)')} AS avg_deviation
FROM alert_rows WHERE alert_status = 'OPEN' GROUP BY sales_rep""")
def rep_alerts(r: Roles) -> DataFrame:
    return al.rep_alerts(r.alerts, r.as_of)


@query("pf_rep_summary", f"""{ALERTS}
SELECT sales_rep, '{AS_OF}' AS alert_date, count(DISTINCT customer_id) AS customers_need_action, count(*) AS total_alerts,
  (SELECT string_agg(n, ', ' ORDER BY n) FROM (SELECT DISTINCT b.customer_name AS n FROM alert_rows b
    WHERE b.sales_rep = a.sales_rep AND b.alert_status = 'OPEN')) AS customer_list,
  {mean('sum(abs(deviation))', 'count(deviation)')} AS avg_deviation, {dbl('max(abs(deviation))')} AS max_deviation
FROM alert_rows a WHERE alert_status = 'OPEN' GROUP BY sales_rep""")
def rep_summary(r: Roles) -> DataFrame:
    return al.rep_summary(r.alerts)


_RETURN = f"round({share('current_price - avg_purchase_price', 'avg_purchase_price')}, 2)"


@query("pf_segment_perf", f"""{POS},
detail AS (SELECT c.risk_tolerance, p.*, {_RETURN} AS return_pct FROM pos p JOIN customers c ON p.customer_id = c.customer_id)
SELECT risk_tolerance, {mean('sum(return_pct)', 'count(return_pct)', 6)} AS avg_return,
  {dbl('sum(book_value)')} AS total_investment, {dbl('sum(market_value)')} AS total_current, count(stock_code) AS stock_count,
  {pct('sum(market_value) - sum(book_value)', 'sum(book_value)')} AS overall_return_pct
FROM detail GROUP BY risk_tolerance""")
def segment_perf(r: Roles) -> DataFrame:
    return pf.segment_performance(r.positions, r.customers)


LABELS = {"AUTOMOBILE": "Automobile", "BUILDING": "Building", "FURNITURE": "Furniture"}


@query("pf_label_segments", f"""WITH {CUSTOMERS}
SELECT customer_id, risk_tolerance, CASE risk_tolerance WHEN 'AUTOMOBILE' THEN 'Automobile' WHEN 'BUILDING' THEN 'Building'
  WHEN 'FURNITURE' THEN 'Furniture' ELSE risk_tolerance END AS risk_label FROM customers""")
def label_segments(r: Roles) -> DataFrame:
    return pf.label_segments(r.customers.select("customer_id", "risk_tolerance"), LABELS)


@query("pf_rebalance_ge5", f"""{ALLOC}
SELECT a.customer_id, c.customer_name, c.risk_tolerance, a.sector, {dbl('allocation_ratio')} AS actual_pct,
  {dbl('target_ratio')} AS target_pct, {dbl('deviation')} AS deviation, rebalance_flag
FROM alloc a JOIN customers c ON a.customer_id = c.customer_id WHERE abs(deviation) >= 5""")
def rebalance_ge5(r: Roles) -> DataFrame:
    return pf.rebalance_list(r.allocation, r.customers, r.as_of)


@query("pf_rebalance_counts", f"""{ALLOC}
SELECT count(DISTINCT customer_id) AS customers, count(*) AS deviations FROM alloc WHERE abs(deviation) >= 5""")
def rebalance_counts(r: Roles) -> DataFrame:
    return pf.rebalance_counts(pf.rebalance_list(r.allocation, r.customers, r.as_of))


@query("pf_sector_perf", f"""{POS},
detail AS (SELECT p.*, {_RETURN} AS return_pct FROM pos p)
SELECT sector, {mean('sum(return_pct)', 'count(return_pct)', 6)} AS avg_return, {dbl('sum(book_value)')} AS total_investment,
  {dbl('sum(market_value)')} AS total_current, count(DISTINCT stock_code) AS stock_count, count(DISTINCT customer_id) AS holder_count,
  {pct('sum(market_value) - sum(book_value)', 'sum(book_value)')} AS overall_return
FROM detail GROUP BY sector""")
def sector_perf(r: Roles) -> DataFrame:
    return pf.sector_performance(r.positions)


HHI = f"""{POS},
sums AS (SELECT customer_id, sector, sum(market_value) AS v FROM pos WHERE sector IS NOT NULL GROUP BY customer_id, sector),
totals AS (SELECT customer_id, sum(v) AS total FROM sums GROUP BY customer_id),
squares AS (SELECT s.customer_id, {share('s.v', 't.total')} AS share FROM sums s JOIN totals t ON s.customer_id = t.customer_id),
concentration AS (
  SELECT customer_id, round(sum(CAST(share AS DECIMAL(9,6)) * CAST(share AS DECIMAL(9,6))), 4) AS hhi
  FROM squares GROUP BY customer_id)"""


@query("agg_hhi", f"{HHI} SELECT customer_id, {dbl('hhi')} AS hhi FROM concentration")
def hhi(r: Roles) -> DataFrame:
    return pf.hhi(r.positions)


@query("pf_hhi_band", f"""{HHI}
SELECT customer_id, {dbl('hhi')} AS hhi, CASE WHEN hhi > 3000 THEN 'high' WHEN hhi > 2500 THEN 'medium' ELSE 'low' END AS band
FROM concentration""")
def hhi_band(r: Roles) -> DataFrame:
    return pf.hhi_band(pf.hhi(r.positions))
