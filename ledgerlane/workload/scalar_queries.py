"""One query per scalar function, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import masking
from ..functions.numeric import haversine_km, kelvin_to_celsius, round_to
from ..functions.semistructured import at, parse
from ..functions.temporal import day_name, day_of, days_between, elapsed, hour_bucket, month_bucket, month_name, shift
from ..functions.text import NEWLINE, joined, label, last_chars
from .registry import query
from .roles import CONTACTS, NOW, OBSERVATIONS, RUNS, TRIPS, Roles, dbl, stamp, text


@query("fn_round", f"""
SELECT l_orderkey, l_linenumber, {dbl('round(CAST(l_extendedprice / l_quantity AS DECIMAL(28,6)), 2)')} AS two,
  {dbl('round(CAST(l_extendedprice / l_quantity AS DECIMAL(28,6)), 1)')} AS one, {dbl('round(CAST(-l_extendedprice AS DECIMAL(28,6)), 0)')} AS whole FROM lineitem""")
def fn_round(r: Roles) -> DataFrame:
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return r.table("lineitem").select(
        "l_orderkey", "l_linenumber", round_to(unit, 2).alias("two"), round_to(unit, 1).alias("one"), round_to(-F.col("l_extendedprice"), 0).alias("whole"))


@query("fn_abs", "SELECT c_custkey, abs(c_acctbal) AS v FROM customer")
def fn_abs(r: Roles) -> DataFrame:
    return r.table("customer").select("c_custkey", F.abs("c_acctbal").alias("v"))


@query("fn_nullif", "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS v FROM lineitem")
def fn_nullif(r: Roles) -> DataFrame:
    return r.table("lineitem").select("l_orderkey", "l_linenumber", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("v"))


@query("fn_coalesce", f"WITH {CONTACTS} SELECT customer_id, coalesce(email, phone, 'none') AS v FROM contacts")
def fn_coalesce(r: Roles) -> DataFrame:
    return r.contacts.select("customer_id", F.coalesce("email", "phone", F.lit("none")).alias("v"))


@query("fn_concat", f"WITH {CONTACTS} SELECT customer_id, customer_name || ' <' || email || '>' AS v FROM contacts")
def fn_concat(r: Roles) -> DataFrame:
    return r.contacts.select("customer_id", joined(F.col("customer_name"), " <", F.col("email"), ">").alias("v"))


@query("fn_char", "SELECT p_partkey, p_name || chr(10) || p_brand AS v FROM part")
def fn_char(r: Roles) -> DataFrame:
    return r.table("part").select("p_partkey", joined(F.col("p_name"), NEWLINE, F.col("p_brand")).alias("v"))


@query("fn_right", f"WITH {CONTACTS} SELECT customer_id, right(phone, 4) AS v FROM contacts")
def fn_right(r: Roles) -> DataFrame:
    return r.contacts.select("customer_id", last_chars("phone", 4).alias("v"))


@query("fn_regexp_replace", r"""
SELECT doc_id, md5(regexp_replace(text, '[^\n\r]+@', '*****@', 'g')) AS v FROM documents""")
def fn_regexp_replace(r: Roles) -> DataFrame:
    """The mask pattern over whole documents; each line is replaced up to its last @."""
    return r.table("documents").select("doc_id", F.md5(F.regexp_replace("text", r"(?m)^[^\n\r]+@", masking.EMAIL_MASK)).alias("v"))


@query("fn_sha2", "SELECT doc_id, sha256(text) AS v FROM documents")
def fn_sha2(r: Roles) -> DataFrame:
    return r.table("documents").select("doc_id", F.sha2("text", 256).alias("v"))


@query("fn_date_trunc", f"""
SELECT event_id, {stamp("date_trunc('hour', ts)")} AS hour, {stamp("date_trunc('month', ts)")} AS month FROM events""")
def fn_date_trunc(r: Roles) -> DataFrame:
    return r.table("events").select("event_id", hour_bucket("ts").alias("hour"), month_bucket("ts").alias("month"))


@query("fn_monthname", "SELECT o_orderkey, strftime(o_orderdate, '%b') AS v FROM orders")
def fn_monthname(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", month_name("o_orderdate").alias("v"))


@query("fn_dayname", "SELECT o_orderkey, strftime(o_orderdate, '%a') AS v FROM orders")
def fn_dayname(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", day_name("o_orderdate").alias("v"))


@query("fn_datediff_day", "SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-01-01') AS INTEGER) AS v FROM orders")
def fn_datediff_day(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", days_between("o_orderdate", F.lit("1998-01-01").cast("date")).alias("v"))


@query("fn_datediff_second", f"WITH {RUNS} SELECT name, {stamp('scheduled_time')} AS scheduled, CAST(date_diff('second', scheduled_time, completed_time) AS BIGINT) AS v FROM runs")
def fn_datediff_second(r: Roles) -> DataFrame:
    return r.runs.select("name", F.col("scheduled_time").alias("scheduled"), elapsed("SECOND", "scheduled_time", "completed_time").alias("v"))


@query("fn_dateadd", f"""
SELECT event_id, {stamp('ts - INTERVAL 1 HOUR')} AS hour_before, {stamp('ts - INTERVAL 5 MINUTE')} AS minutes_before, {stamp('ts - INTERVAL 7 DAY')} AS week_before FROM events""")
def fn_dateadd(r: Roles) -> DataFrame:
    return r.table("events").select(
        "event_id", shift("HOUR", -1, "ts").alias("hour_before"), shift("MINUTE", -5, "ts").alias("minutes_before"), shift("DAY", -7, "ts").alias("week_before"))


@query("fn_date", f"SELECT event_id, {text('CAST(ts AS DATE)')} AS day, '2002-01-31' AS as_of, '{NOW}' AS now FROM events")
def fn_date(r: Roles) -> DataFrame:
    return r.table("events").select("event_id", day_of("ts").alias("day"), r.as_of.alias("as_of"), r.now.alias("now"))


_RAW_DATE = "CASE WHEN o_orderkey % 13 = 0 THEN '1996-13-99' ELSE strftime(o_orderdate, '%Y-%m-%d') END"


@query("fn_to_date", f"SELECT o_orderkey, CAST(TRY_CAST({_RAW_DATE} AS DATE) AS VARCHAR) AS v FROM orders")
def fn_to_date(r: Roles) -> DataFrame:
    written = F.when(F.col("o_orderkey") % 13 == 0, "1996-13-99").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return r.table("orders").select("o_orderkey", F.try_to_date(written, "yyyy-MM-dd").alias("v"))


_RAW_NUMBER = "CASE WHEN o_orderkey % 17 = 0 THEN 'abc' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END"


@query("fn_to_number", f"SELECT o_orderkey, {dbl(f'TRY_CAST({_RAW_NUMBER} AS DECIMAL(12,2))')} AS v FROM orders")
def fn_to_number(r: Roles) -> DataFrame:
    written = F.when(F.col("o_orderkey") % 17 == 0, "abc").otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    return r.table("orders").select("o_orderkey", written.try_cast("decimal(12,2)").alias("v"))


KM = """2 * 6371 * asin(sqrt(least(pow(sin(radians(end_station_latitude - start_station_latitude) / 2), 2)
  + cos(radians(start_station_latitude)) * cos(radians(end_station_latitude)) * pow(sin(radians(end_station_longitude - start_station_longitude) / 2), 2), 1.0)))"""


@query("fn_haversine", f"WITH {TRIPS} SELECT event_id, round(CAST({KM} AS DOUBLE), 4) AS km FROM trips")
def fn_haversine(r: Roles) -> DataFrame:
    km = haversine_km("start_station_latitude", "start_station_longitude", "end_station_latitude", "end_station_longitude")
    return r.trips.select("event_id", F.round(km, 4).alias("km"))


@query("fn_json_path", f"WITH {OBSERVATIONS} SELECT event_id, station_id, weather, k AS clouds FROM obs")
def fn_json_path(r: Roles) -> DataFrame:
    seen = r.observations.select("event_id", parse("body").alias("v"))
    return seen.select("event_id", at("v", "$.city.id", "int").alias("station_id"), at("v", "$.weather[0].main", "string").alias("weather"), at("v", "$.clouds.all", "int").alias("clouds"))


@query("fn_kelvin_to_celsius", "SELECT event_id, (value + 200) - CAST(273.15 AS DOUBLE) AS celsius FROM events")
def fn_kelvin(r: Roles) -> DataFrame:
    return r.table("events").select("event_id", kelvin_to_celsius(F.col("value") + 200).alias("celsius"))


@query("fn_current_role", f"""WITH {CONTACTS}
SELECT customer_id, email AS seen_by_admin, '********' AS seen_by_user FROM contacts""")
def fn_current_role(r: Roles) -> DataFrame:
    return r.contacts.select(
        "customer_id", masking.full("email", "SYSADMIN").alias("seen_by_admin"), masking.full("email", "ANALYST").alias("seen_by_user"))


@query("fn_label", "SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'LARGE' THEN 'Large' ELSE p_type END AS v FROM part")
def fn_label(r: Roles) -> DataFrame:
    return r.table("part").select("p_partkey", label("p_type", {"ECONOMY": "Economy", "LARGE": "Large"}).alias("v"))
