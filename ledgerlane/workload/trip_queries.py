"""Trips, weather and run-log reports over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import round_to
from ..functions.semistructured import parse
from ..plans import alerts as al, runlog, trips as tp
from ..session import materialize
from .registry import query
from .roles import ALERTS, OBSERVATIONS, RUNS, TRIPS, Roles, dbl, mean, stamp
from .scalar_queries import KM


@query("trip_hourly", f"""WITH {TRIPS}
SELECT {stamp("date_trunc('hour', starttime)")} AS hour, count(*) AS num_trips,
  {dbl('round(CAST(avg(tripduration) / 60 AS DECIMAL(28,6)), 4)')} AS avg_duration_minutes,
  {dbl(f'round(CAST(avg({KM}) AS DECIMAL(28,6)), 4)')} AS avg_distance_km FROM trips GROUP BY 1""")
def trip_hourly(r: Roles) -> DataFrame:
    return tp.trip_hourly(r.trips).select(
        "hour", "num_trips", round_to("avg_duration_minutes", 4).alias("avg_duration_minutes"), round_to("avg_distance_km", 4).alias("avg_distance_km"))


@query("trip_by_month", f"WITH {TRIPS} SELECT strftime(starttime, '%b') AS month, count(*) AS num_trips FROM trips GROUP BY 1")
def trip_by_month(r: Roles) -> DataFrame:
    return tp.trips_by_month(r.trips)


@query("trip_by_weekday", f"WITH {TRIPS} SELECT strftime(starttime, '%a') AS day_of_week, count(*) AS num_trips FROM trips GROUP BY 1")
def trip_by_weekday(r: Roles) -> DataFrame:
    return tp.trips_by_weekday(r.trips)


_VIEW = f"""WITH {OBSERVATIONS}, view_rows AS (
  SELECT date_trunc('second', ts) AS observation_time, station_id, concat('city ', CAST(event_id % 3 AS VARCHAR)) AS city_name, 'US' AS country,
    k * CAST(0.5 AS DOUBLE) AS city_lat, k * CAST(-0.25 AS DOUBLE) AS city_lon, k AS clouds,
    k + CAST(250.5 AS DOUBLE) - CAST(273.15 AS DOUBLE) AS temp_avg, k + CAST(240.25 AS DOUBLE) - CAST(273.15 AS DOUBLE) AS temp_min,
    k + CAST(260.75 AS DOUBLE) - CAST(273.15 AS DOUBLE) AS temp_max, weather, 'sky ' || lower(weather) AS weather_desc,
    CASE WHEN weather IS NOT NULL THEN '01d' END AS weather_icon, CAST(user_id AS DOUBLE) AS wind_dir, k * CAST(0.125 AS DOUBLE) AS wind_speed
  FROM obs)"""


def _variants(r: Roles) -> DataFrame:
    return r.observations.select(parse("body").alias("v"))


def _typed(r: Roles) -> DataFrame:
    """Only the fields that a query uses are parsed."""
    return r.observations.select(F.from_json("body", tp.OBSERVATION_SCHEMA, {"timestampFormat": "yyyy-MM-dd HH:mm:ss"}).alias("o")).select("o.*")


@query("weather_view", f"{_VIEW} SELECT * REPLACE ({stamp('observation_time')} AS observation_time) FROM view_rows WHERE station_id = 5128638")
def weather_view(r: Roles) -> DataFrame:
    return tp.weather_view(_variants(r))


@query("weather_view_typed", f"{_VIEW} SELECT * REPLACE ({stamp('observation_time')} AS observation_time) FROM view_rows WHERE station_id = 5128638")
def weather_view_typed(r: Roles) -> DataFrame:
    return tp.weather_view_typed(_typed(r))


@query("weather_month", f"""{_VIEW} SELECT {stamp('observation_time')} AS observation_time, station_id, weather FROM view_rows
WHERE date_trunc('month', observation_time) = TIMESTAMP '2024-01-01 00:00:00'""")
def weather_month(r: Roles) -> DataFrame:
    return tp.weather_month(tp.weather_view_typed(_typed(r), None), "2024-01-01").select("observation_time", "station_id", "weather")


@query("trips_by_condition", f"""{_VIEW}, {TRIPS}
SELECT weather AS conditions, count(*) AS num_trips FROM trips
LEFT JOIN (SELECT * FROM view_rows WHERE station_id = 5128638) v ON date_trunc('hour', v.observation_time) = date_trunc('hour', starttime)
WHERE weather IS NOT NULL GROUP BY 1""")
def trips_by_condition(r: Roles) -> DataFrame:
    return tp.trips_by_condition(r.trips, tp.weather_view_typed(_typed(r)))


# ---- run log -------------------------------------------------------------------------------

_SHOWN = f"CASE state {' '.join(f'WHEN {chr(39)}{k}{chr(39)} THEN {chr(39)}{v}{chr(39)}' for k, v in runlog.STATE_LABELS.items())} ELSE state END AS status_display"
_RUN_COLUMNS = f"""name AS task_name, state, {stamp('scheduled_time')} AS scheduled_time, {stamp('completed_time')} AS completed_time,
  CAST(date_diff('second', scheduled_time, completed_time) AS BIGINT) AS execution_seconds, {_SHOWN}, error_code, error_message"""


@query("run_history", f"""WITH {RUNS}
SELECT {_RUN_COLUMNS} FROM (SELECT * FROM runs WHERE scheduled_time >= TIMESTAMP '2024-01-20 12:00:00' AND scheduled_time <= TIMESTAMP '2024-01-27 12:00:00'
  ORDER BY scheduled_time DESC, name, state LIMIT 100)""")
def run_history(r: Roles) -> DataFrame:
    return runlog.run_history(r.runs, F.lit("2024-01-27 12:00:00").cast("timestamp"))


@query("run_today", f"""WITH {RUNS}
SELECT task_name, status_display, scheduled_time, completed_time, execution_seconds, error_message FROM (
  SELECT {_RUN_COLUMNS} FROM runs WHERE CAST(runs.scheduled_time AS DATE) = DATE '2024-01-15')""")
def run_today(r: Roles) -> DataFrame:
    return runlog.runs_on(r.runs, F.lit("2024-01-15").cast("date"))


@query("run_last", f"WITH {RUNS} SELECT {_RUN_COLUMNS} FROM (SELECT * FROM runs WHERE name = 'STEP_3' ORDER BY scheduled_time DESC, state LIMIT 5)")
def run_last(r: Roles) -> DataFrame:
    return runlog.last_runs(r.runs, "STEP_3")


@query("run_summary", f"""WITH {RUNS}, timed AS (SELECT *, date_diff('second', scheduled_time, completed_time) AS seconds FROM runs)
SELECT CAST(CAST(scheduled_time AS DATE) AS VARCHAR) AS execution_date, count(*) AS total_executions,
  count(CASE WHEN state = 'SUCCEEDED' THEN 1 END) AS successful, count(CASE WHEN state = 'FAILED' THEN 1 END) AS failed,
  count(CASE WHEN state = 'SKIPPED' THEN 1 END) AS skipped, {mean('sum(seconds)', 'count(seconds)')} AS avg_execution_seconds
FROM timed GROUP BY CAST(scheduled_time AS DATE)""")
def run_summary(r: Roles) -> DataFrame:
    return runlog.run_summary(r.runs)


@query("run_log_step", f"""{ALERTS}
SELECT 'REBALANCE_ALERTS' AS table_name, 'ALERT_GENERATION' AS check_type, 'SUCCESS' AS check_result, count(*) AS affected_rows,
  'Generated ' || CAST(count(*) AS VARCHAR) || ' alerts for date: 2002-01-31' AS details FROM alert_rows WHERE alert_status = 'OPEN'
UNION ALL
SELECT 'EMAIL_ALERTS', 'EMAIL_PREPARATION', 'SUCCESS', count(DISTINCT sales_rep),
  'Prepared email alerts for ' || CAST(count(DISTINCT sales_rep) AS VARCHAR) || ' sales representatives' FROM alert_rows WHERE alert_status = 'OPEN'""")
def run_log_step(r: Roles) -> DataFrame:
    # Both entries come from one written table.
    issued = materialize(al.on_day(r.alerts, r.as_of, True).select("sales_rep"), "issued")
    generated = runlog.run_step(
        issued, "REBALANCE_ALERTS", "ALERT_GENERATION",
        F.concat(F.lit("Generated "), F.col("n").cast("string"), F.lit(" alerts for date: "), r.as_of.cast("string")))
    mailed = runlog.run_step(
        issued, "EMAIL_ALERTS", "EMAIL_PREPARATION",
        F.concat(F.lit("Prepared email alerts for "), F.col("affected").cast("string"), F.lit(" sales representatives")), F.count_distinct("sales_rep"))
    return generated.unionByName(mailed)


@query("rep_detail", f"""{ALERTS}
SELECT sales_rep, customer_id, customer_name, risk_tolerance, sector, {dbl('current_ratio')} AS current_ratio, {dbl('target_ratio')} AS target_ratio,
  {dbl('deviation')} AS deviation, recommended_action FROM alert_rows WHERE alert_status = 'OPEN'""")
def rep_detail(r: Roles) -> DataFrame:
    return al.rep_detail(r.alerts, r.as_of)


def _lines(*parts: str) -> str:
    """SQL text made of the given SQL parts, joined without separator."""
    return " || ".join(parts)


_NL = "chr(10)"
_DETAIL = _lines(
    f"'{al.MESSAGE_BULLET}'", "customer_name", f"'{al.MESSAGE_SLASH}'", "sector", f"'{al.MESSAGE_GAP}'", "CAST(round(deviation, 1) AS VARCHAR)",
    f"'{al.MESSAGE_GAP_END}'", _NL, f"'{al.MESSAGE_INDENT}'", "coalesce(recommended_action, '')", _NL, _NL)
_BODY = _lines(
    _NL, f"'{al.MESSAGE_TITLE}'", _NL, _NL, "c.sales_rep", f"'{al.MESSAGE_HONORIFIC}'", _NL, _NL, f"'{al.MESSAGE_GREETING}'", _NL,
    f"'{al.MESSAGE_CUSTOMERS}'", "CAST(customers AS VARCHAR)", f"'{al.MESSAGE_CUSTOMERS_UNIT}'", _NL,
    f"'{al.MESSAGE_ALERTS}'", "CAST(alerts AS VARCHAR)", f"'{al.MESSAGE_ALERTS_UNIT}'", _NL, _NL,
    f"'{al.MESSAGE_DETAIL}'", _NL, f"'{al.MESSAGE_DETAIL_LEAD}'", _NL, _NL, "lines", f"'{al.MESSAGE_FOOTER}'", _NL, _NL, f"'{al.MESSAGE_AUTO}'")


@query("rep_message", f"""{ALERTS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY sales_rep ORDER BY abs(deviation) DESC, customer_id, sector) AS rn FROM alert_rows
  WHERE alert_status = 'OPEN'),
lines AS (SELECT sales_rep, string_agg({_DETAIL}, '' ORDER BY rn) AS lines FROM ranked WHERE rn <= {al.MESSAGE_ROWS} GROUP BY sales_rep),
counts AS (SELECT sales_rep, count(DISTINCT customer_id) AS customers, count(*) AS alerts FROM ranked GROUP BY sales_rep),
c AS (
  SELECT n.n_name AS sales_rep, coalesce(customers, 0) AS customers, coalesce(alerts, 0) AS alerts, coalesce(lines, '') AS lines
  FROM (SELECT DISTINCT n_name FROM nation UNION SELECT 'NOWHERE') n LEFT JOIN counts k ON k.sales_rep = n.n_name LEFT JOIN lines l ON l.sales_rep = n.n_name)
SELECT c.sales_rep, customers, alerts, {_BODY} AS body FROM c""")
def rep_message(r: Roles) -> DataFrame:
    """A message for every representative by name; one has no alerts."""
    reps = r.table("nation").select(F.col("n_name").alias("sales_rep")).unionByName(r.spark.createDataFrame([("NOWHERE",)], "sales_rep string"))
    return al.rep_message(r.alerts, r.as_of, reps=reps)
