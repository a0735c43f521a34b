"""The test tables in the roles of the brokerage, trip and run-log tables, in Spark and in SQL.

Every role is derived from a whole table. The SQL text of a role is meant for a WITH clause.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans import alerts as al, portfolio as pf

AS_OF = "2002-01-31"
NOW = "2024-02-01 00:00:00"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SECTORS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# Target mix by rule: some sectors have no target, one target names no sector.
TARGETS = [
    (segment, sector, 5 * ((2 * i + j) % 6) + 0.5 * i)
    for i, segment in enumerate(SEGMENTS)
    for j, sector in enumerate(SECTORS)
    if (i + j) % 3
] + [(segment, "NOTHING", 20.0) for segment in SEGMENTS]
SECTOR_EXPR = "CASE WHEN p_partkey % 61 <> 0 THEN p_type END"

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS risk_tolerance, n_name AS sales_rep
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
HOLDINGS = """holdings AS (
  SELECT o_custkey AS customer_id, l_partkey AS stock_code,
    CAST(sum(CAST(l_quantity AS DECIMAL(10,0))) AS DECIMAL(10,0)) AS quantity,
    CAST(CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE floor(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE)
      / CAST(sum(CAST(l_quantity AS DECIMAL(10,0))) AS DOUBLE) * 100 + 0.5) / 100 END AS DECIMAL(12,2)) AS avg_purchase_price,
    CAST(min(o_orderdate) AS DATE) AS purchase_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)"""
PRICES = f"""prices AS (
  SELECT p_partkey AS stock_code, p_name AS stock_name, {SECTOR_EXPR} AS sector, DATE '{AS_OF}' AS price_date,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 100 * (p_partkey % 11) AS DECIMAL(12,2)) AS closing_price
  FROM part)"""
POSITIONS = """pos AS (
  SELECT h.*, p.stock_name, p.sector, p.price_date, p.closing_price AS current_price,
    h.quantity * h.avg_purchase_price AS book_value, h.quantity * p.closing_price AS market_value,
    h.quantity * p.closing_price - h.quantity * h.avg_purchase_price AS unrealized_pl
  FROM holdings h JOIN prices p ON h.stock_code = p.stock_code)"""
TARGET_ROWS = ", ".join(f"('{a}', '{b}', CAST({c} AS DECIMAL(5,2)))" for a, b, c in TARGETS)
TARGETS_SQL = f"targets AS (SELECT * FROM (VALUES {TARGET_ROWS}) AS t(risk_tolerance, sector, target_ratio))"


def share(part: str, whole: str) -> str:
    """SQL of the exact percentage: six fraction digits, NULL for a zero denominator."""
    return f"CAST(CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0) AS DECIMAL(28,6))"


def pct(part: str, whole: str, places: int = 2) -> str:
    return f"CAST(round({share(part, whole)}, {places}) AS DOUBLE)"


def mean(total: str, count: str, places: int = 2) -> str:
    return f"CAST(round(CAST(CAST({total} AS DOUBLE) / nullif(CAST({count} AS DOUBLE), 0) AS DECIMAL(28,6)), {places}) AS DOUBLE)"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def text(value: str) -> str:
    return f"CAST({value} AS VARCHAR)"


def stamp(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


POS = f"WITH {CUSTOMERS}, {HOLDINGS}, {PRICES}, {POSITIONS}"
ALLOCATION = f"""sums AS (
  SELECT p.customer_id, p.sector, sum(p.market_value) AS market_value FROM pos p GROUP BY p.customer_id, p.sector),
totals AS (SELECT customer_id, sum(market_value) AS total FROM sums GROUP BY customer_id),
shares AS (
  SELECT s.customer_id, c.risk_tolerance, s.sector, s.market_value, {share('s.market_value', 't.total')} AS share,
    CAST(coalesce(g.target_ratio, 0) AS DECIMAL(5,2)) AS target_ratio
  FROM sums s JOIN totals t ON s.customer_id = t.customer_id JOIN customers c ON s.customer_id = c.customer_id
  LEFT JOIN targets g ON c.risk_tolerance = g.risk_tolerance AND s.sector = g.sector),
alloc AS (
  SELECT DATE '{AS_OF}' AS snapshot_date, customer_id, risk_tolerance, sector, market_value,
    round(share, 2) AS allocation_ratio, target_ratio, round(share - target_ratio, 2) AS deviation,
    coalesce(abs(share - target_ratio) > 5, FALSE) AS rebalance_flag
  FROM shares)"""
ALLOC = f"{POS}, {TARGETS_SQL}, {ALLOCATION}"


def advice(head: str, middle: str, tail: str) -> str:
    """SQL of one recommendation sentence."""
    return f"'{head}' || a.sector || '{middle}' || CAST(round(abs(a.deviation), 1) AS VARCHAR) || '{tail}'"


ACTION = f"""CASE WHEN a.deviation > {al.THRESHOLD} THEN {advice(al.SELL_HEAD, al.SELL_MIDDLE, al.SELL_TAIL)}
  WHEN a.deviation < -{al.THRESHOLD} THEN {advice(al.BUY_HEAD, al.BUY_MIDDLE, al.BUY_TAIL)} END"""
ALERT_ROWS = f"""alert_rows AS (
  SELECT DATE '{AS_OF}' AS alert_date, a.customer_id, c.customer_name, a.risk_tolerance, c.sales_rep, a.sector,
    a.allocation_ratio AS current_ratio, a.target_ratio, a.deviation,
    {ACTION} AS recommended_action,
    CASE WHEN a.customer_id % 5 = 0 THEN 'CLOSED' ELSE 'OPEN' END AS alert_status
  FROM alloc a JOIN customers c ON a.customer_id = c.customer_id WHERE a.rebalance_flag)"""
ALERTS = f"{ALLOC}, {ALERT_ROWS}"


TRIPS = """trips AS (
  SELECT event_id, user_id, ts AS starttime, CAST(round(value) AS INTEGER) AS tripduration, event_type AS usertype,
    concat('station ', CAST(user_id % 60 AS VARCHAR)) AS start_station_name,
    40.60 + (user_id % 97) * 0.002 AS start_station_latitude, -74.05 + (user_id % 89) * 0.002 AS start_station_longitude,
    40.60 + (event_id % 83) * 0.002 AS end_station_latitude, -74.05 + (event_id % 79) * 0.002 AS end_station_longitude
  FROM events)"""
CITIES = {"0": 5128638, "1": 4887398, "2": 5368361}
CONDITIONS = ["Clear", "Clouds", "Rain", "Snow", "Mist"]
OBSERVATIONS = """obs AS (
  SELECT event_id, ts, CASE event_id % 3 WHEN 0 THEN 5128638 WHEN 1 THEN 4887398 ELSE 5368361 END AS station_id,
    CASE WHEN event_id % 7 <> 0 THEN CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds'
      WHEN 2 THEN 'Rain' WHEN 3 THEN 'Snow' ELSE 'Mist' END END AS weather,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, user_id
  FROM events)"""
RUNS = """runs AS (
  SELECT concat('STEP_', CAST(user_id % 5 AS VARCHAR)) AS name,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'SKIPPED' WHEN 'click' THEN 'EXECUTING' ELSE 'SUCCEEDED' END AS state,
    date_trunc('second', ts) + CAST(event_id % 1000 AS INTEGER) * INTERVAL 1 MICROSECOND AS scheduled_time,
    CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) + CAST(floor(value) AS INTEGER) * INTERVAL 1 SECOND
      + CAST(event_id % 1000 AS INTEGER) * INTERVAL 1 MICROSECOND END AS completed_time,
    CASE WHEN event_type = 'error' THEN CAST(event_id % 9 AS VARCHAR) END AS error_code,
    CASE WHEN event_type = 'error' THEN concat('failed ', props) END AS error_message
  FROM events)"""
CONTACTS = """contacts AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
    CASE WHEN c_custkey % 11 <> 0 THEN concat(lower(replace(c_name, '#', '.')), '@mail', CAST(c_custkey % 7 AS VARCHAR), '.example') END AS email,
    CASE WHEN c_custkey % 13 <> 0 THEN concat('090-', lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0'), '-', lpad(CAST(c_custkey * 7 % 10000 AS VARCHAR), 4, '0')) END AS phone,
    c_mktsegment AS risk_tolerance, CASE WHEN c_custkey % 3 = 0 THEN 'PUBLIC' WHEN c_custkey % 3 = 1 THEN 'PRIVATE' END AS visibility
  FROM customer)"""


class Roles:
    """Role tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def as_of(self):
        return F.lit(AS_OF).cast("date")

    @cached_property
    def now(self):
        return F.lit(NOW).cast("timestamp")

    @cached_property
    def customers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("sales_rep"))
        return self.table("customer").join(nation, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("risk_tolerance"), "sales_rep",
        )

    @cached_property
    def holdings(self) -> DataFrame:
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
        # Whole cents and whole pieces: exact like decimals, but plain long sums.
        money = F.sum(F.floor(F.col("l_extendedprice") * 100 + 0.5)).cast("double") / 100
        quantity = F.sum(F.col("l_quantity").cast("bigint"))
        price = F.floor(money / quantity.cast("double") * 100 + 0.5) / 100
        return (
            self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
            .join(orders, "l_orderkey")
            .groupBy(F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("stock_code"))
            .agg(
                quantity.cast("decimal(10,0)").alias("quantity"),
                price.alias("price"),
                F.min("o_orderdate").cast("date").alias("purchase_date"),
            )
            .select(
                "customer_id", "stock_code", "quantity",
                F.when(F.col("stock_code") % 97 == 0, F.lit(0.0)).otherwise(F.col("price")).cast("decimal(12,2)").alias("avg_purchase_price"),
                "purchase_date",
            )
        )

    @cached_property
    def prices(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(12,2)") + 100 * (F.col("p_partkey") % 11)
        return self.table("part").select(
            F.col("p_partkey").alias("stock_code"), F.col("p_name").alias("stock_name"),
            F.when(F.col("p_partkey") % 61 != 0, F.col("p_type")).alias("sector"),
            self.as_of.alias("price_date"), price.cast("decimal(12,2)").alias("closing_price"),
        )

    @cached_property
    def targets(self) -> DataFrame:
        rows = ", ".join(f"('{a}', '{b}', CAST({c} AS DECIMAL(5,2)))" for a, b, c in TARGETS)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(risk_tolerance, sector, target_ratio)")

    @cached_property
    def positions(self) -> DataFrame:
        return pf.positions(self.holdings, self.prices)

    @cached_property
    def snapshots(self) -> DataFrame:
        return pf.snapshot(self.positions, self.as_of)

    @cached_property
    def allocation(self) -> DataFrame:
        return pf.allocation(self.snapshots, self.customers, self.targets, self.as_of)

    @cached_property
    def alerts(self) -> DataFrame:
        """Alerts of the day; those of every fifth customer are closed already."""
        closed = F.when(F.col("customer_id") % 5 == 0, "CLOSED").otherwise("OPEN")
        return al.alerts(self.allocation, self.customers, self.as_of).withColumn("alert_status", closed)

    @cached_property
    def trips(self) -> DataFrame:
        """Events as trips: the value is the duration, places follow from the ids."""
        rider, event = F.col("user_id"), F.col("event_id")

        def degrees(base: float, number, modulus: int):
            # Decimal arithmetic first, so that both engines start from the same double.
            return (F.lit(base).cast("decimal(6,2)") + (number % modulus) * F.lit(0.002).cast("decimal(4,3)")).cast("double")

        return self.table("events").select(
            "event_id", "user_id", F.col("ts").alias("starttime"), F.round("value").cast("int").alias("tripduration"),
            F.col("event_type").alias("usertype"),
            F.concat(F.lit("station "), (rider % 60).cast("string")).alias("start_station_name"),
            degrees(40.60, rider, 97).alias("start_station_latitude"), degrees(-74.05, rider, 89).alias("start_station_longitude"),
            degrees(40.60, event, 83).alias("end_station_latitude"), degrees(-74.05, event, 79).alias("end_station_longitude"),
        )

    @cached_property
    def observations(self) -> DataFrame:
        """All events as weather observations, one nested JSON text each."""
        k = F.get_json_object("props", "$.k").cast("int")
        event = F.col("event_id")
        condition = F.lit(CONDITIONS[4])
        for i in range(3, -1, -1):
            condition = F.when(k % 5 == i, CONDITIONS[i]).otherwise(condition)
        station = F.when(event % 3 == 0, CITIES["0"]).when(event % 3 == 1, CITIES["1"]).otherwise(CITIES["2"])
        weather = F.when(event % 7 != 0, F.array(F.struct(
            condition.alias("main"), F.concat(F.lit("sky "), F.lower(condition)).alias("description"), F.lit("01d").alias("icon"))))
        body = F.struct(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
            F.struct(station.alias("id"), F.concat(F.lit("city "), (event % 3).cast("string")).alias("name"), F.lit("US").alias("country"),
                     F.struct((k * 0.5).alias("lat"), (k * -0.25).alias("lon")).alias("coord")).alias("city"),
            F.struct(k.alias("all")).alias("clouds"),
            F.struct((k + 250.5).alias("temp"), (k + 240.25).alias("temp_min"), (k + 260.75).alias("temp_max")).alias("main"),
            weather.alias("weather"),
            F.struct(F.col("user_id").cast("double").alias("deg"), (k * 0.125).alias("speed")).alias("wind"),
        )
        return self.table("events").select("event_id", F.to_json(body).alias("body"))

    @cached_property
    def runs(self) -> DataFrame:
        """Events as runs of the daily chain."""
        kind = F.col("event_type")
        micros = F.make_interval(secs=(F.col("event_id") % 1000 / 1000000).cast("decimal(18,6)"))
        second = F.date_trunc("second", "ts")
        length = F.make_interval(secs=F.floor("value").cast("decimal(18,6)"))
        return self.table("events").select(
            F.concat(F.lit("STEP_"), (F.col("user_id") % 5).cast("string")).alias("name"),
            F.when(kind == "error", "FAILED").when(kind == "signup", "SKIPPED").when(kind == "click", "EXECUTING").otherwise("SUCCEEDED").alias("state"),
            (second + micros).alias("scheduled_time"),
            F.when(kind != "click", second + length + micros).alias("completed_time"),
            F.when(kind == "error", (F.col("event_id") % 9).cast("string")).alias("error_code"),
            F.when(kind == "error", F.concat(F.lit("failed "), "props")).alias("error_message"),
        )

    @cached_property
    def contacts(self) -> DataFrame:
        key = F.col("c_custkey")
        digits = lambda n: F.lpad((n % 10000).cast("string"), 4, "0")
        return self.table("customer").select(
            key.alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.when(key % 11 != 0, F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail"), (key % 7).cast("string"), F.lit(".example"))).alias("email"),
            F.when(key % 13 != 0, F.concat(F.lit("090-"), digits(key), F.lit("-"), digits(key * 7))).alias("phone"),
            F.col("c_mktsegment").alias("risk_tolerance"),
            F.when(key % 3 == 0, "PUBLIC").when(key % 3 == 1, "PRIVATE").alias("visibility"),
        )
