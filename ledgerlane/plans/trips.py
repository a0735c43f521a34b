"""Bike trips and weather observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import haversine_km, kelvin_to_celsius
from ..functions.semistructured import at
from ..functions.temporal import day_name, hour_bucket, month_bucket, month_name

# The city of the weather view and the length of the station list.
WEATHER_CITY_ID = 5128638
TOP_STATIONS = 20


def trip_hourly(trips: DataFrame) -> DataFrame:
    """Per hour: trips, mean minutes and mean distance."""
    distance = haversine_km("start_station_latitude", "start_station_longitude", "end_station_latitude", "end_station_longitude")
    return trips.groupBy(hour_bucket("starttime").alias("hour")).agg(
        F.count(F.lit(1)).alias("num_trips"),
        (F.avg("tripduration") / 60).alias("avg_duration_minutes"),
        F.avg(distance).alias("avg_distance_km"),
    )


def trips_by_month(trips: DataFrame) -> DataFrame:
    """Trips per month name; the same month of different years counts together."""
    return trips.groupBy(month_name("starttime").alias("month")).agg(F.count(F.lit(1)).alias("num_trips")).orderBy(F.col("num_trips").desc(), "month")


def trips_by_weekday(trips: DataFrame) -> DataFrame:
    return trips.groupBy(day_name("starttime").alias("day_of_week")).agg(F.count(F.lit(1)).alias("num_trips")).orderBy(F.col("num_trips").desc(), "day_of_week")


def top_stations(trips: DataFrame, k: int = TOP_STATIONS) -> DataFrame:
    """Start stations with most rides; equal counts are settled by name."""
    rides = trips.groupBy(F.col("start_station_name").alias("station")).agg(F.count(F.lit(1)).alias("rides"))
    return rides.orderBy(F.col("rides").desc(), "station").limit(k)


def weather_view(observations: DataFrame, city_id: int | None = WEATHER_CITY_ID, column: str = "v") -> DataFrame:
    """Typed columns of the observation JSON, for one city (or all when ``city_id`` is None)."""
    view = observations.select(
        at(column, "$.time", "timestamp").alias("observation_time"),
        at(column, "$.city.id", "int").alias("station_id"),
        at(column, "$.city.name", "string").alias("city_name"),
        at(column, "$.city.country", "string").alias("country"),
        at(column, "$.city.coord.lat", "double").alias("city_lat"),
        at(column, "$.city.coord.lon", "double").alias("city_lon"),
        at(column, "$.clouds.all", "int").alias("clouds"),
        kelvin_to_celsius(at(column, "$.main.temp", "double")).alias("temp_avg"),
        kelvin_to_celsius(at(column, "$.main.temp_min", "double")).alias("temp_min"),
        kelvin_to_celsius(at(column, "$.main.temp_max", "double")).alias("temp_max"),
        at(column, "$.weather[0].main", "string").alias("weather"),
        at(column, "$.weather[0].description", "string").alias("weather_desc"),
        at(column, "$.weather[0].icon", "string").alias("weather_icon"),
        at(column, "$.wind.deg", "double").alias("wind_dir"),
        at(column, "$.wind.speed", "double").alias("wind_speed"),
    )
    return view if city_id is None else view.filter(F.col("station_id") == city_id)


# Typed form of the observations. Reading with it (or ``from_json``) parses only the fields a query
# uses, which a variant cannot promise; prefer it for large inputs.
OBSERVATION_SCHEMA = (
    "time timestamp, city struct<id: int, name: string, country: string, coord: struct<lat: double, lon: double>>, "
    "clouds struct<all: int>, main struct<temp: double, temp_min: double, temp_max: double>, "
    "weather array<struct<main: string, description: string, icon: string>>, wind struct<deg: double, speed: double>"
)


def weather_view_typed(observations: DataFrame, city_id: int | None = WEATHER_CITY_ID) -> DataFrame:
    """The same view over rows of ``OBSERVATION_SCHEMA``; an empty weather list gives NULLs."""
    first = F.get("weather", F.lit(0))
    view = observations.select(
        F.col("time").alias("observation_time"),
        F.col("city.id").alias("station_id"), F.col("city.name").alias("city_name"), F.col("city.country").alias("country"),
        F.col("city.coord.lat").alias("city_lat"), F.col("city.coord.lon").alias("city_lon"), F.col("clouds.all").alias("clouds"),
        kelvin_to_celsius("main.temp").alias("temp_avg"), kelvin_to_celsius("main.temp_min").alias("temp_min"),
        kelvin_to_celsius("main.temp_max").alias("temp_max"),
        first["main"].alias("weather"), first["description"].alias("weather_desc"), first["icon"].alias("weather_icon"),
        F.col("wind.deg").alias("wind_dir"), F.col("wind.speed").alias("wind_speed"),
    )
    return view if city_id is None else view.filter(F.col("station_id") == city_id)


def weather_month(view: DataFrame, month_start) -> DataFrame:
    """Observations of one calendar month, given by its first day."""
    return view.filter(month_bucket("observation_time") == F.lit(month_start).cast("timestamp"))


def trips_by_condition(trips: DataFrame, view: DataFrame) -> DataFrame:
    """Trips per weather condition of the same hour.

    Two observations with a condition in one hour count the trips of that hour twice, as a join
    does. Both sides are reduced to one row per hour (and condition) first, so the join never
    multiplies rows: the trips of an hour times the observations of a condition in it.
    """
    trip_hours = trips.groupBy(hour_bucket("starttime").alias("hour")).agg(F.count(F.lit(1)).alias("trips"))
    condition_hours = (
        view.filter(F.col("weather").isNotNull())
        .groupBy(hour_bucket("observation_time").alias("hour"), F.col("weather").alias("conditions"))
        .agg(F.count(F.lit(1)).alias("observations"))
    )
    return (
        condition_hours.join(trip_hours, ["hour"])
        .groupBy("conditions")
        .agg(F.sum(F.col("trips") * F.col("observations")).alias("num_trips"))
        .orderBy(F.col("num_trips").desc(), "conditions")
    )
