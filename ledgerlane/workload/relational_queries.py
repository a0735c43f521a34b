"""Projections, filters, joins, aggregations, sorts and set operations over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import guarded_ratio, mean_of, percent
from ..functions.temporal import day_of, hour_bucket, month_bucket
from ..operators import joins
from ..operators.latest import latest_per_key
from ..operators.distinct import distinct_counts
from ..operators.reshape import fixed_pivot, max_pivot, share_pivot, share_rows, text_list
from ..plans import portfolio as pf, trips as tp
from .registry import query
from .roles import ALLOC, POS, SECTORS, TRIPS, Roles, dbl, mean, pct, stamp, text

# ---- projections ---------------------------------------------------------------------------


def _money(r: Roles) -> DataFrame:
    cents = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    return r.table("lineitem").select("l_orderkey", "l_linenumber", *[F.col(c).cast("decimal(12,2)").alias(c) for c in cents])


_D = "CAST({} AS DECIMAL(12,2))".format


@query("proj_arith", f"""
SELECT l_orderkey, l_linenumber, {dbl(f"{_D('l_extendedprice')} * (1 - {_D('l_discount')})")} AS net,
  {dbl(f"{_D('l_extendedprice')} - {_D('l_quantity')} + {_D('l_tax')}")} AS mixed,
  {dbl(_D('l_extendedprice'))} / {dbl(_D('l_quantity'))} AS unit FROM lineitem""")
def proj_arith(r: Roles) -> DataFrame:
    price = F.col("l_extendedprice")
    return _money(r).select(
        "l_orderkey", "l_linenumber",
        (price * (1 - F.col("l_discount"))).alias("net"),
        (price - F.col("l_quantity") + F.col("l_tax")).alias("mixed"),
        guarded_ratio(price, "l_quantity").alias("unit"),
    )


@query("proj_alias_reuse", f"""
SELECT o_custkey, {dbl('sum(CAST(o_totalprice AS DECIMAL(12,2)))')} AS total, {dbl('round(sum(CAST(o_totalprice AS DECIMAL(12,2))), 0)')} AS total_rounded
FROM orders GROUP BY o_custkey""")
def proj_alias_reuse(r: Roles) -> DataFrame:
    r.table("orders").createOrReplaceTempView("ledgerlane_orders")
    return r.spark.sql(
        "SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total, round(total, 0) AS total_rounded "
        "FROM ledgerlane_orders GROUP BY o_custkey"
    )


@query("proj_case", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice < 50000 THEN 'small' ELSE 'middle' END AS size,
  CASE WHEN o_orderstatus = 'F' THEN 1 END AS finished, CASE WHEN o_totalprice > 100000 THEN TRUE ELSE FALSE END AS flagged FROM orders""")
def proj_case(r: Roles) -> DataFrame:
    price = F.col("o_totalprice")
    return r.table("orders").select(
        "o_orderkey",
        F.when(price > 300000, "large").when(price < 50000, "small").otherwise("middle").alias("size"),
        F.when(F.col("o_orderstatus") == "F", 1).alias("finished"),
        F.when(price > 100000, True).otherwise(False).alias("flagged"),
    )


@query("proj_const", "SELECT o_orderkey, 'ORDERS' AS table_name, 7 AS number FROM orders")
def proj_const(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", F.lit("ORDERS").alias("table_name"), F.lit(7).alias("number"))


@query("proj_cast", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS day, {dbl('CAST(o_totalprice AS DECIMAL(12,2))')} AS price,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number FROM orders""")
def proj_cast(r: Roles) -> DataFrame:
    return r.table("orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"), F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
    )


# ---- filters -------------------------------------------------------------------------------


@query("filt_alias_where", "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders WHERE o_totalprice * 2 > 500000")
def filt_alias_where(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled")).filter(F.col("doubled") > 500000)


@query("filt_null", """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 61 <> 0 THEN p_type END AS sector, CASE WHEN p_size > 5 THEN p_size END AS size FROM part)
SELECT p_partkey, sector, size FROM p WHERE sector IS NULL OR size IS NULL""")
def filt_null(r: Roles) -> DataFrame:
    parts = r.table("part").select(
        "p_partkey", F.when(F.col("p_partkey") % 61 != 0, F.col("p_type")).alias("sector"), F.when(F.col("p_size") > 5, F.col("p_size")).alias("size"))
    return parts.filter(F.col("sector").isNull() | F.col("size").isNull())


@query("filt_in_list", """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 61 <> 0 THEN p_type END AS sector FROM part)
SELECT p_partkey, sector, TRUE AS listed FROM p WHERE sector IN ('ECONOMY', 'LARGE')
UNION ALL SELECT p_partkey, sector, FALSE FROM p WHERE sector NOT IN ('ECONOMY', 'LARGE')""")
def filt_in_list(r: Roles) -> DataFrame:
    parts = r.prices.select(F.col("stock_code").alias("p_partkey"), "sector")
    listed = F.col("sector").isin("ECONOMY", "LARGE")
    return parts.filter(listed | ~listed).withColumn("listed", listed)


@query("filt_compare", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice >= 100000 AND o_totalprice < 200000 AND o_orderstatus = 'O' AND abs(o_totalprice - 150000) > 1000""")
def filt_compare(r: Roles) -> DataFrame:
    price = F.col("o_totalprice")
    wanted = (price >= 100000) & (price < 200000) & (F.col("o_orderstatus") == "O") & (F.abs(price - 150000) > 1000)
    return r.table("orders").filter(wanted).select("o_orderkey", "o_totalprice")


@query("filt_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%'")
def filt_like(r: Roles) -> DataFrame:
    return r.table("part").filter(F.col("p_name").like("small%")).select("p_partkey", "p_name")


@query("filt_date_bucket", f"""
SELECT o_orderkey, {stamp("date_trunc('month', o_orderdate)")} AS month, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
FROM orders WHERE date_trunc('month', o_orderdate) = TIMESTAMP '1996-03-01 00:00:00' OR CAST(o_orderdate AS DATE) = DATE '1997-07-07'""")
def filt_date_bucket(r: Roles) -> DataFrame:
    """Buckets as ranges of the stored column, so that the scan can skip row groups."""
    date = F.col("o_orderdate")
    in_month = (date >= F.lit("1996-03-01").cast("timestamp_ntz")) & (date < F.lit("1996-04-01").cast("timestamp_ntz"))
    on_day = (date >= F.lit("1997-07-07").cast("timestamp_ntz")) & (date < F.lit("1997-07-08").cast("timestamp_ntz"))
    return r.table("orders").filter(in_month | on_day).select("o_orderkey", month_bucket("o_orderdate").alias("month"), day_of("o_orderdate").alias("day"))


# ---- joins ---------------------------------------------------------------------------------


@query("join_inner", """
SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def join_inner(r: Roles) -> DataFrame:
    customers = r.customers.select(F.col("customer_id").alias("o_custkey"), F.col("customer_name").alias("c_name"), F.col("sales_rep").alias("n_name"))
    return r.table("orders").select("o_orderkey", "o_custkey").join(customers, ["o_custkey"]).drop("o_custkey")


@query("join_left_multi", f"""{ALLOC}
SELECT customer_id, risk_tolerance, sector, {dbl('target_ratio')} AS target_ratio FROM shares""")
def join_left_multi(r: Roles) -> DataFrame:
    held = pf.sector_values(r.positions).join(r.customers.select("customer_id", "risk_tolerance"), ["customer_id"])
    matched = joins.spread_join(held, r.targets, ["risk_tolerance", "sector"], "left", ["customer_id"])
    return matched.select("customer_id", "risk_tolerance", "sector", F.coalesce("target_ratio", F.lit(0)).cast("decimal(5,2)").alias("target_ratio"))


@query("join_group_total", f"""
SELECT l_orderkey, l_linenumber, {dbl(_D('l_extendedprice'))} AS l_extendedprice, {dbl('total')} AS total
FROM lineitem JOIN (SELECT l_orderkey AS k, sum({_D('l_extendedprice')}) AS total FROM lineitem GROUP BY l_orderkey) ON l_orderkey = k""")
def join_group_total(r: Roles) -> DataFrame:
    lines = _money(r).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return joins.with_group_total(lines, "l_extendedprice", ["l_orderkey"], "total")


@query("join_expr_key", """
WITH marks AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT event_id, n FROM events LEFT JOIN marks ON date_trunc('hour', ts) = marks.hour WHERE event_type = 'click' AND n IS NOT NULL""")
def join_expr_key(r: Roles) -> DataFrame:
    """One side is reduced to one row per hour first, so the join never pairs all rows of an hour."""
    events = r.table("events").select("event_id", "ts", "event_type")
    clicks = events.filter(F.col("event_type") == "click").select("event_id", "ts")
    marks = events.filter(F.col("event_type") == "signup").groupBy(hour_bucket("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return joins.join_on_expression(clicks, hour_bucket("ts"), marks, F.col("hour"), "left").filter(F.col("n").isNotNull()).select("event_id", "n")


# Children with NULL keys and keys without parent, derived by key arithmetic.
CHILD = "child AS (SELECT o_orderkey, CASE WHEN o_orderkey % 101 <> 0 THEN CASE WHEN o_orderkey % 50 = 0 THEN -o_custkey - 1 ELSE o_custkey END END AS k FROM orders)"
PARENT = "parent AS (SELECT c_custkey AS pk FROM customer WHERE c_custkey % 10 <> 3)"
NULL_PARENT = "null_parent AS (SELECT pk FROM parent UNION ALL SELECT CASE WHEN c_custkey > 0 THEN c_custkey END FROM customer WHERE c_custkey <= 1)"


def child(r: Roles) -> DataFrame:
    key = F.col("o_orderkey")
    wrong = F.when(key % 50 == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
    return r.table("orders").select("o_orderkey", F.when(key % 101 != 0, wrong).alias("k"))


def parent(r: Roles) -> DataFrame:
    return r.table("customer").filter(F.col("c_custkey") % 10 != 3).select(F.col("c_custkey").alias("k"))


@query("join_anti_left_null", f"WITH {CHILD}, {PARENT} SELECT o_orderkey, k FROM child LEFT JOIN parent ON k = pk WHERE pk IS NULL")
def join_anti_left_null(r: Roles) -> DataFrame:
    return joins.rows_without_parent(child(r), parent(r), ["k"])


@query("join_anti_not_exists", """
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem a WHERE NOT EXISTS (
  SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R' AND b.l_orderkey = a.l_orderkey AND b.l_partkey = a.l_partkey AND b.l_linenumber = a.l_linenumber)""")
def join_anti_not_exists(r: Roles) -> DataFrame:
    lines = r.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    returned = lines.filter(F.col("l_returnflag") == "R").select(*keys)
    return lines.join(returned, keys, "left_anti").select(*keys)


@query("join_anti_not_in", f"""WITH {CHILD}, {PARENT}, {NULL_PARENT}
SELECT 'clean' AS parents, count(*) AS orphans FROM child WHERE k NOT IN (SELECT pk FROM parent)
UNION ALL SELECT 'with null', count(*) FROM child WHERE k NOT IN (SELECT pk FROM null_parent)""")
def join_anti_not_in(r: Roles) -> DataFrame:
    customers = r.table("customer").filter(F.col("c_custkey") <= 1)
    null_parent = parent(r).unionByName(customers.select(F.when(F.col("c_custkey") > 0, F.col("c_custkey")).alias("k")))

    def orphans(name: str, parents: DataFrame) -> DataFrame:
        return joins.rows_not_in(child(r), "k", parents, "k").agg(F.lit(name).alias("parents"), F.count(F.lit(1)).alias("orphans"))

    return orphans("clean", parent(r)).unionByName(orphans("with null", null_parent))


# ---- aggregations --------------------------------------------------------------------------


@query("agg_count", """
WITH p AS (SELECT p_brand, CASE WHEN p_partkey % 61 <> 0 THEN p_type END AS sector FROM part)
SELECT p_brand, count(*) AS all_rows, count(sector) AS with_sector FROM p GROUP BY p_brand""")
def agg_count(r: Roles) -> DataFrame:
    parts = r.table("part").select("p_brand", F.when(F.col("p_partkey") % 61 != 0, F.col("p_type")).alias("sector"))
    return parts.groupBy("p_brand").agg(F.count(F.lit(1)).alias("all_rows"), F.count("sector").alias("with_sector"))


@query("agg_count_distinct", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag")
def agg_count_distinct(r: Roles) -> DataFrame:
    return distinct_counts(r.table("lineitem"), ["l_returnflag"], {"suppliers": "l_suppkey", "parts": "l_partkey"})


@query("agg_sum_avg_max", f"""
SELECT l_returnflag, l_linestatus, {dbl(f"sum({_D('l_quantity')} * {_D('l_extendedprice')})")} AS volume,
  {mean(f"sum({_D('l_extendedprice')})", 'count(*)')} AS avg_price, {mean(f"sum(abs({_D('l_discount')} - CAST(0.05 AS DECIMAL(12,2))))", 'count(*)', 4)} AS avg_gap,
  {dbl(f"max(abs({_D('l_extendedprice')} - 50000))")} AS max_gap FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_sum_avg_max(r: Roles) -> DataFrame:
    money = _money(r).drop("l_orderkey", "l_linenumber")
    price, rows = F.col("l_extendedprice"), F.count(F.lit(1))
    lines = r.table("lineitem").select("l_returnflag", "l_linestatus", *[F.col(c).cast("decimal(12,2)").alias(c) for c in money.columns])
    gap = F.abs(F.col("l_discount") - F.lit("0.05").cast("decimal(12,2)"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_quantity") * price).alias("volume"),
        mean_of(F.sum(price), rows).alias("avg_price"),
        mean_of(F.sum(gap), rows, 4).alias("avg_gap"),
        F.max(F.abs(price - 50000)).alias("max_gap"),
    )


@query("agg_conditional", """
SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS finished, CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS large
FROM orders GROUP BY o_custkey""")
def agg_conditional(r: Roles) -> DataFrame:
    return r.table("orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
        F.sum(F.when(F.col("o_totalprice") > 200000, 1).otherwise(0)).alias("large"),
    )


@query("agg_ratio_of_sums", f"""{POS}
SELECT customer_id, {pct('sum(unrealized_pl)', 'sum(book_value)')} AS return_pct FROM pos GROUP BY customer_id""")
def agg_ratio_of_sums(r: Roles) -> DataFrame:
    return r.positions.groupBy("customer_id").agg(percent(F.sum("unrealized_pl"), F.sum("book_value")).alias("return_pct"))


@query("agg_mean_unweighted", f"""{POS},
rows_pct AS (SELECT sector, book_value, unrealized_pl, CAST(round({pct('unrealized_pl', 'book_value')}::DECIMAL(28,6), 2) AS DECIMAL(28,2)) AS r FROM pos)
SELECT sector, {mean('sum(r)', 'count(r)', 6)} AS mean_return, {pct('sum(unrealized_pl)', 'sum(book_value)')} AS weighted_return FROM rows_pct GROUP BY sector""")
def agg_mean_unweighted(r: Roles) -> DataFrame:
    rows = r.positions.withColumn("r", percent("unrealized_pl", "book_value"))
    return rows.groupBy("sector").agg(
        mean_of(F.sum("r"), F.count("r"), 6).alias("mean_return"), percent(F.sum("unrealized_pl"), F.sum("book_value")).alias("weighted_return"))


@query("agg_having", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def agg_having(r: Roles) -> DataFrame:
    return joins.key_counts(r.table("lineitem"), ["l_orderkey", "l_linenumber"]).filter(F.col("n") > 1)


@query("agg_two_level", f"""
WITH o AS (SELECT l_orderkey, sum({_D('l_extendedprice')}) AS v, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT n, count(*) AS orders, {dbl('max(v)')} AS max_value, {mean('sum(v)', 'count(*)')} AS avg_value FROM o GROUP BY n""")
def agg_two_level(r: Roles) -> DataFrame:
    per_order = _money(r).groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("v"), F.count(F.lit(1)).alias("n"))
    rows = F.count(F.lit(1))
    return per_order.groupBy("n").agg(rows.alias("orders"), F.max("v").alias("max_value"), mean_of(F.sum("v"), rows).alias("avg_value"))


@query("agg_ordinal", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type")
def agg_ordinal(r: Roles) -> DataFrame:
    r.table("part").createOrReplaceTempView("ledgerlane_part")
    return r.spark.sql("SELECT p_type, count(*) AS n FROM ledgerlane_part GROUP BY 1 ORDER BY 2 DESC, 1")


@query("agg_listagg", """
SELECT n_regionkey, c_mktsegment, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nations
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey, c_mktsegment""")
def agg_listagg(r: Roles) -> DataFrame:
    nation = r.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    return text_list(r.table("customer").join(nation, "c_nationkey"), ["n_regionkey", "c_mktsegment"], "n_name", "nations")


_PIVOT = SECTORS[:3]


@query("agg_pivot_fixed", f"""
SELECT l_suppkey, {', '.join(f"{dbl(f'sum(CASE WHEN sector = {s!r} THEN v ELSE 0 END)')} AS {s}" for s in _PIVOT)},
  {dbl(f"sum(CASE WHEN sector NOT IN ({', '.join(map(repr, _PIVOT))}) THEN v ELSE 0 END)")} AS other, {dbl('sum(v)')} AS total
FROM (SELECT l_suppkey, CASE WHEN p_partkey % 61 <> 0 THEN p_type END AS sector, {_D('l_extendedprice')} AS v FROM lineitem JOIN part ON l_partkey = p_partkey)
GROUP BY l_suppkey""")
def agg_pivot_fixed(r: Roles) -> DataFrame:
    return fixed_pivot(_sector_lines(r), ["l_suppkey"], "sector", {s: s for s in _PIVOT}, F.col("v"), "other")


def _sector_lines(r: Roles) -> DataFrame:
    sectors = r.prices.select(F.col("stock_code").alias("l_partkey"), "sector")
    lines = r.table("lineitem").select("l_suppkey", "l_partkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("v"))
    return joins.spread_join(lines, sectors, ["l_partkey"], spread_by=["l_suppkey", "v"])


@query("agg_pivot_max", f"""
SELECT l_suppkey, {', '.join(f"{dbl(f'max(CASE WHEN sector = {s!r} THEN v END)')} AS {s}" for s in _PIVOT)}
FROM (SELECT l_suppkey, CASE WHEN p_partkey % 61 <> 0 THEN p_type END AS sector, {_D('l_extendedprice')} AS v FROM lineitem JOIN part ON l_partkey = p_partkey)
GROUP BY l_suppkey""")
def agg_pivot_max(r: Roles) -> DataFrame:
    return max_pivot(_sector_lines(r), ["l_suppkey"], "sector", {s: s for s in _PIVOT}, "v")




@query("agg_pivot_dynamic", f"""
SELECT o_orderstatus, {', '.join(f"{pct(f'sum(CASE WHEN o_orderpriority = {p!r} THEN v ELSE 0 END)', 'sum(v)')} AS {chr(34)}{p}{chr(34)}"
  for p in ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])}
FROM (SELECT o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders) GROUP BY o_orderstatus""")
def agg_pivot_dynamic(r: Roles) -> DataFrame:
    orders = r.table("orders").select("o_orderstatus", "o_orderpriority", F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
    return share_pivot(orders, ["o_orderstatus"], "o_orderpriority", "v")


@query("agg_share_rows", f"""
WITH s AS (SELECT o_orderpriority, o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS v FROM orders GROUP BY o_orderpriority, o_custkey),
t AS (SELECT o_orderpriority, sum(v) AS total FROM s GROUP BY o_orderpriority)
SELECT s.o_orderpriority, s.o_custkey, {pct('s.v', 't.total', 4)} AS share FROM s JOIN t ON s.o_orderpriority = t.o_orderpriority""")
def agg_share_rows(r: Roles) -> DataFrame:
    """The dynamic pivot in long form: any number of values, none of them named or brought to the driver."""
    orders = r.table("orders").select("o_orderpriority", "o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
    return share_rows(orders, ["o_orderpriority"], "o_custkey", "v", 4)


@query("agg_time_hourly", f"""WITH {TRIPS}
SELECT {stamp("date_trunc('hour', starttime)")} AS hour, count(*) AS n, CAST(sum(tripduration) AS BIGINT) AS seconds FROM trips GROUP BY 1""")
def agg_time_hourly(r: Roles) -> DataFrame:
    return r.trips.groupBy(hour_bucket("starttime").alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.sum("tripduration").alias("seconds"))


@query("agg_time_named", """
SELECT strftime(o_orderdate, '%b') AS month, strftime(o_orderdate, '%a') AS day, count(*) AS n FROM orders GROUP BY 1, 2""")
def agg_time_named(r: Roles) -> DataFrame:
    return r.table("orders").groupBy(F.monthname("o_orderdate").alias("month"), F.dayname("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("latest_per_key", f"""
SELECT l_partkey, {text('CAST(l_shipdate AS DATE)')} AS price_date, l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def latest(r: Roles) -> DataFrame:
    lines = r.table("lineitem").select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    last = latest_per_key(lines, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"])
    return last.select("l_partkey", day_of("l_shipdate").alias("price_date"), "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


# ---- sort, limit, set operations -----------------------------------------------------------


@query("sort_multi", f"""{ALLOC}
SELECT customer_id, sector, {dbl('deviation')} AS deviation FROM alloc ORDER BY customer_id, abs(deviation) DESC, sector""")
def sort_multi(r: Roles) -> DataFrame:
    return r.allocation.select("customer_id", "sector", "deviation").orderBy("customer_id", F.abs("deviation").desc(), "sector")


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("limit_only", "SELECT 10 AS rows_seen, count(*) AS rows_all FROM orders")
def limit_only(r: Roles) -> DataFrame:
    """A peek has no fixed rows, so it is counted next to the whole table."""
    orders = r.table("orders").select("o_orderkey")
    seen = orders.limit(10).agg(F.count(F.lit(1)).cast("int")).scalar()
    return orders.agg(F.count(F.lit(1)).alias("rows_all")).withColumn("rows_seen", seen)


@query("set_union_all", """
SELECT 'ORDERS' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'LINEITEM', count(*) FROM lineitem
UNION ALL SELECT 'PART', count(*) FROM part UNION ALL SELECT 'CUSTOMER', count(*) FROM customer""")
def set_union_all(r: Roles) -> DataFrame:
    parts = [r.table(n).agg(F.lit(n.upper()).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n in ("orders", "lineitem", "part", "customer")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("set_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def set_distinct(r: Roles) -> DataFrame:
    return r.table("lineitem").select("l_partkey", "l_suppkey").distinct()


# ---- trips and weather ---------------------------------------------------------------------


@query("top_stations", f"WITH {TRIPS} SELECT start_station_name AS station, count(*) AS rides FROM trips GROUP BY 1 ORDER BY rides DESC, station LIMIT 20")
def top_stations(r: Roles) -> DataFrame:
    return tp.top_stations(r.trips)
