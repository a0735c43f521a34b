"""Golden numbers of the brokerage sample, and edge cases it lacks."""

import datetime as dt
from decimal import Decimal

import brokerage as b
import pytest
from pyspark.sql import functions as F

from ledgerlane.plans import alerts as al, portfolio as pf

DAY = b.AS_OF


@pytest.fixture(scope="module")
def pos(spark):
    return pf.positions(b.holdings(spark), pf.latest_prices(b.prices(spark)))


@pytest.fixture(scope="module")
def alloc(spark, pos):
    return pf.allocation(pf.snapshot(pos, DAY), b.customers(spark), b.targets(spark), DAY)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


TOTALS = {
    "C001": (635000, 667000, 32000, "5.04", "3563.2"),
    "C002": (472000, 494000, 22000, "4.66", "5124.7"),
    "C003": (3290000, 3425000, 135000, "4.10", "3773.3"),
    "C004": (858000, 898700, 40700, "4.74", "3646.6"),
    "C005": (1871000, 1982600, 111600, "5.96", "3362.6"),
    "C006": (892000, 922100, 30100, "3.37", "3489.3"),
    "C007": (948000, 973800, 25800, "2.72", "5393.0"),
    "C008": (604500, 630500, 26000, "4.30", "10000.0"),
    "C009": (2006000, 2091900, 85900, "4.28", "3594.8"),
    "C010": (1629000, 1681500, 52500, "3.22", "5691.9"),
}


def test_customer_totals(spark, pos):
    got = by(pf.customer_pl(pos, b.customers(spark)), "customer_id")
    assert set(got) == set(TOTALS)
    for c, (book, market, pl, pct, _) in TOTALS.items():
        r = got[c]
        assert (r["total_book_value"], r["total_market_value"], r["total_unrealized_pl"]) == (book, market, pl)
        assert r["total_return_pct"] == Decimal(pct)
        assert (r["num_holdings"], r["profit_holdings"], r["loss_holdings"]) == (3, 3, 0)
    value = by(pf.customer_value(pos, b.customers(spark)), "customer_id")
    assert value["C004"]["total_market_value_rounded"] == 898700


def test_concentration(pos):
    got = by(pf.hhi_band(pf.hhi(pos)), "customer_id")
    for c, (*_, hhi) in TOTALS.items():
        assert round(got[c]["hhi"], 1) == Decimal(hhi)
    assert {r["band"] for r in got.values()} == {"high"}


def test_even_sectors_give_2000(spark):
    rows = [("X", f"s{i}", f"sector {i}", Decimal(100)) for i in range(5)]
    even = spark.createDataFrame(rows, "customer_id string, stock_code string, sector string, market_value decimal(20,2)")
    assert pf.hhi(even).first()["hhi"] == 2000


def test_segments(spark, pos):
    got = by(pf.label_segments(pf.segment_performance(pos, b.customers(spark))), "risk_tolerance")
    want = {"バランス": (12, 4070000, 4221000, "3.71", "Balanced"), "保守的": (9, 1968500, 2046600, "3.97", "Conservative"),
            "積極的": (9, 7167000, 7499500, "4.64", "Aggressive")}
    for risk, (n, book, market, pct, label) in want.items():
        r = got[risk]
        assert (r["stock_count"], r["total_investment"], r["total_current"], r["overall_return_pct"]) == (n, book, market, Decimal(pct))
        assert r["risk_label"] == label
    # Mean of row returns, checked against a plain calculation.
    rows = pf.performance_detail(pos, b.customers(spark)).collect()
    for risk, r in got.items():
        returns = [x["return_pct"] for x in rows if x["risk_tolerance"] == risk]
        assert float(r["avg_return"]) == pytest.approx(float(sum(returns) / len(returns)), abs=1e-6)


def test_sector_performance(pos):
    got = by(pf.sector_performance(pos), "sector")
    assert len(got) == 16
    want = {"電機": (3, 3, "7.25"), "卸売": (4, 3, "2.86"), "自動車": (3, 2, "3.08"), "銀行": (2, 1, "3.25"), "情報通信": (2, 2, "4.57"), "海運": (3, 1, "4.30")}
    for sector, (stocks, holders, pct) in want.items():
        r = got[sector]
        assert (r["stock_count"], r["holder_count"], r["overall_return"]) == (stocks, holders, Decimal(pct))


def test_allocation(alloc):
    got = by(alloc, "customer_id", "sector")
    assert len(got) == 25
    assert sum(r["rebalance_flag"] for r in got.values()) == 24
    assert sum(r["target_ratio"] == 0 for r in got.values()) == 9
    assert sum(r["deviation"] < 0 for r in got.values()) == 0
    assert sum(abs(r["deviation"]) >= 5 for r in got.values()) == 24
    samples = {("C001", "電機"): ("45.58", 15, "30.58", True), ("C003", "電機"): ("20.06", 15, "5.06", True), ("C004", "食品"): ("44.73", 0, "44.73", True),
               ("C008", "海運"): ("100", 0, "100", True), ("C009", "情報通信"): ("24.67", 20, "4.67", False)}
    for key, (share, target, deviation, flag) in samples.items():
        r = got[key]
        assert (r["allocation_ratio"], r["target_ratio"], r["deviation"], r["rebalance_flag"]) == (Decimal(share), target, Decimal(deviation), flag)


def test_shares_sum_to_100(spark, pos):
    sums = pf.sector_mix(pos, b.customers(spark)).groupBy("customer_id").agg(F.sum("allocation_ratio").alias("s")).collect()
    assert len(sums) == 10 and all(abs(r["s"] - 100) <= Decimal("0.03") for r in sums)


def test_pivots(spark, pos, alloc):
    wide = by(pf.sector_pivot(pos, b.customers(spark)), "customer_id")
    assert wide["C001"]["電機_pct"] == Decimal("45.58") and wide["C008"]["その他_pct"] == 100
    matrix = by(pf.deviation_matrix(alloc, DAY), "customer_id")
    assert matrix["C001"]["電機_deviation"] == Decimal("30.58") and matrix["C008"]["電機_deviation"] is None


def test_representatives(spark, alloc):
    rows = al.with_status(al.alerts(alloc, b.customers(spark), DAY))
    got = by(al.rep_summary(rows), "sales_rep")
    want = {"佐藤三郎": (3, 7, "40.71", "68.60"), "田中一郎": (4, 11, "23.21", "46.29"), "鈴木次郎": (3, 6, "37.50", "100.00")}
    for rep, (n, alerts, mean, top) in want.items():
        r = got[rep]
        assert (r["customers_need_action"], r["total_alerts"], r["avg_deviation"], r["max_deviation"]) == (n, alerts, Decimal(mean), Decimal(top))
    assert got["鈴木次郎"]["customer_list"] == "佐藤花子, 小林恵子, 渡辺由美"
    assert by(al.rep_alerts(rows, DAY), "sales_rep")["田中一郎"]["total_alerts"] == 11
    body = by(al.rep_message(rows, DAY), "sales_rep")["田中一郎"]["body"]
    assert body.count("・") == 10 and "アラート件数: 11件" in body and "対応が必要な顧客: 4名" in body
    assert body.startswith("\n【ポートフォリオリバランスアラート】\n\n田中一郎 様\n")


def test_two_alert_policies(spark, alloc):
    current = al.alerts(alloc, b.customers(spark), DAY)
    none = al.with_status(current).limit(0)
    once = al.issue_missing(none, current)
    assert once.count() == 24 and al.issue_missing(once, current).count() == 24
    twice = al.reissue(al.reissue(none, current, DAY), current, DAY)
    assert {r["alert_status"]: r["count"] for r in twice.groupBy("alert_status").count().collect()} == {"CLOSED": 24, "OPEN": 24}
    # After a close, the first policy does not issue again.
    assert al.issue_missing(twice.filter("alert_status = 'CLOSED'"), current).filter("alert_status = 'OPEN'").count() == 0


def small(spark, rows):
    """Snapshot rows (customer, sector, value) for one day."""
    return spark.createDataFrame([(b.AS_OF, c, s, Decimal(v)) for c, s, v in rows], "snapshot_date date, customer_id string, sector string, market_value decimal(20,2)")


def test_threshold_edges(spark):
    """Exactly 5 is not flagged; 5.004 is, is stored as 5.00 and gets no advice; -8 gets the buy text."""
    snap = small(spark, [("A", "x", 2500), ("A", "y", 7500), ("B", "x", "25004"), ("B", "y", "74996"), ("C", "x", 1200), ("C", "y", 8800)])
    people = spark.createDataFrame([(c, c, "r", "rep") for c in "ABC"], "customer_id string, customer_name string, risk_tolerance string, sales_rep string")
    goals = spark.createDataFrame([("r", "x", Decimal(20))], "risk_tolerance string, sector string, target_ratio decimal(5,2)")
    alloc = pf.allocation(snap, people, goals, DAY)
    got = by(alloc.filter("sector = 'x'"), "customer_id")
    assert [got[c]["rebalance_flag"] for c in "ABC"] == [False, True, True]
    assert [got[c]["deviation"] for c in "ABC"] == [Decimal("5.00"), Decimal("5.00"), Decimal("-8.00")]
    texts = by(al.alerts(alloc, people, DAY).filter("sector = 'x'"), "customer_id")
    assert set(texts) == {"B", "C"} and texts["B"]["recommended_action"] is None
    assert texts["C"]["recommended_action"] == "【買付推奨】xが目標比率より8.0%不足です。追加購入をご検討ください。"
    listed = pf.rebalance_list(alloc, people, DAY).filter("sector = 'x'")
    assert {r["customer_id"] for r in listed.collect()} == {"A", "B", "C"}
    status = by(pf.misallocated(alloc, people, DAY).filter("sector = 'x'"), "customer_id")
    assert status["C"]["allocation_status"] == pf.UNDERWEIGHT and status["B"]["allocation_status"] == pf.OVERWEIGHT


def test_zero_book_value_and_missing_price(spark):
    held = spark.createDataFrame(
        [("A", "s1", Decimal(1), Decimal(0), b.AS_OF), ("A", "s2", Decimal(1), Decimal(10), b.AS_OF), ("A", "gone", Decimal(1), Decimal(10), b.AS_OF)],
        "customer_id string, stock_code string, quantity decimal(10,0), avg_purchase_price decimal(12,2), purchase_date date")
    quotes = spark.createDataFrame(
        [("s1", "n", None, b.AS_OF, Decimal(5)), ("s2", "n", "x", b.AS_OF, Decimal(10))],
        "stock_code string, stock_name string, sector string, price_date date, closing_price decimal(12,2)")
    people = spark.createDataFrame([("A", "A", "r", "rep")], "customer_id string, customer_name string, risk_tolerance string, sales_rep string")
    pos = pf.positions(held, quotes)
    got = by(pf.unrealized(pos, people), "stock_code")
    assert set(got) == {"s1", "s2"}
    assert got["s1"]["unrealized_pl_pct"] is None and got["s1"]["pl_status"] == pf.GAIN
    assert got["s2"]["unrealized_pl_pct"] == 0 and got["s2"]["pl_status"] == pf.FLAT
    wide = pf.sector_pivot(pos, people, ["x"], "rest").first()
    assert wide["x_pct"] == Decimal("66.67") and wide["rest_pct"] == 0 and wide["total_market_value"] == 15


def test_latest_price_over_dates_and_ties(spark):
    quotes = spark.createDataFrame(
        [("s", "n", "x", dt.date(2024, 1, 1), Decimal(9)), ("s", "n", "x", dt.date(2024, 1, 2), Decimal(7)), ("s", "n", "x", dt.date(2024, 1, 2), Decimal(8))],
        "stock_code string, stock_name string, sector string, price_date date, closing_price decimal(12,2)")
    for _ in range(2):
        assert [r["closing_price"] for r in pf.latest_prices(quotes).collect()] == [8]


def test_summaries_agree(spark, pos):
    summary = pf.customer_summary(pos, b.customers(spark))
    got = by(pf.segment_summary(summary), "risk_tolerance")
    assert (got["保守的"]["customer_count"], got["保守的"]["total_current_value"]) == (3, 2046600)
    assert got["保守的"]["avg_return_pct"] == Decimal("4.11")  # mean of 4.66, 3.37, 4.30
    checks = pf.snapshot_check(pf.snapshot(pos, DAY)).first()
    assert (checks["record_count"], checks["customer_count"]) == (30, 10)
    risk = by(pf.risk_deviation(pf.allocation(pf.snapshot(pos, DAY), b.customers(spark), b.targets(spark), DAY), DAY), "risk_tolerance")
    assert sum(r["rebalance_needed_count"] for r in risk.values()) == 24 and sum(r["total_allocations"] for r in risk.values()) == 25


def test_concentration_with_a_share_of_ten_thousand_percent(spark):
    pos = spark.createDataFrame([(1, "a", Decimal("1000.00")), (1, "b", Decimal("-990.00"))], "customer_id long, sector string, market_value decimal(18,2)")
    got = pf.hhi(pos).collect()[0]["hhi"]
    assert got == Decimal("10000.0000") ** 2 + Decimal("9900.0000") ** 2
