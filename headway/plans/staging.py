"""Enriched datasets. The same bodies serve batches and streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import clock, keys, scoring, weather
from headway.operators.expectations import Expectation
from headway.operators.joins import spread_join, with_daily_weather

# Table names, layout and rules that results are compared on.
WEATHER_TABLE = "stg_weather_daily"
TRANSIT_TABLE = "stg_mbta_performance"
DRIVING_TABLE = "stg_driving_performance"
TRANSIT_PARTITION = ("schedule_date",)
TRANSIT_CLUSTER = ("stop_h3_index", "route_id", "schedule_date")
DRIVING_PARTITION = ("fetched_date",)
DRIVING_CLUSTER = ("origin_h3_index", "fetched_date")

_STRATUM_RULES = (
    Expectation("valid_hour_bucket", "hour_bucket IN ('AM_PEAK', 'PM_PEAK', 'MIDDAY', 'OFF_PEAK')"),
    Expectation("valid_day_type", "day_type IN ('weekday', 'weekend')"),
)
WEATHER_RULES = (
    Expectation("valid_date", "observation_date IS NOT NULL", "drop"),
    Expectation("valid_condition", "weather_condition IN ('clear', 'rain', 'snow')"),
)
TRANSIT_RULES = (
    Expectation("valid_delay", "delay_seconds IS NOT NULL", "drop"),
    Expectation("valid_schedule", "scheduled_arrival IS NOT NULL", "drop"),
    *_STRATUM_RULES,
)
DRIVING_RULES = (
    Expectation("valid_duration", "duration_in_traffic_seconds IS NOT NULL", "drop"),
    *_STRATUM_RULES,
)

TRIP_KEYS = ("trip_id", "stop_id")


def weather_daily(raw: DataFrame) -> DataFrame:
    """Raw weather with a fine category and a severity score."""
    rain, snow = F.col("precipitation_inches"), F.col("snow_inches")
    warm, wind = F.col("temp_max_f"), F.col("wind_speed_mph")
    return raw.withColumns(
        {
            "weather_category_detailed": weather.detailed_category(rain, snow, warm),
            "weather_severity_score": weather.severity_score(rain, snow, warm, wind),
        }
    )


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """The last fetched version of each prediction, and all rows without an id.

    ``max_by`` keeps one row per prediction and task before the shuffle. Rows without an id
    are no versions of each other and do not move.
    """
    row = F.struct(*[F.col(name) for name in predictions.columns])
    known = predictions.filter("prediction_id IS NOT NULL")
    latest = known.groupBy(F.col("prediction_id").alias("_id")).agg(
        F.max_by(row, F.struct("fetched_at", row)).alias("row")
    )
    return latest.select("row.*").unionByName(predictions.filter("prediction_id IS NULL"))


def _strata(moment: Column, day: Column) -> Mapping[str, Column]:
    hour = F.hour(moment)
    return {
        "hour": hour,
        "hour_bucket": clock.hour_bucket(hour),
        "day_type": clock.day_type(day),
    }


def transit_performance(
    predictions: DataFrame,
    schedules: DataFrame,
    daily: DataFrame,
    hot: DataFrame | None = None,
    time_zone: str | None = None,
    match_service_date: bool = False,
) -> DataFrame:
    """Predicted against scheduled arrivals, with strata and weather.

    Trip and stop are matched whatever the service date unless
    ``match_service_date`` is set. ``hot`` is a result of ``hot_keys`` over
    ``TRIP_KEYS``.
    """
    predicted = predictions.select(
        *TRIP_KEYS,
        "prediction_id",
        F.col("arrival_time").alias("predicted_arrival"),
        "stop_h3_index",
        "route_id",
        "route_long_name",
        "fetched_at",
    ).filter("predicted_arrival IS NOT NULL")
    planned = schedules.select(
        *TRIP_KEYS, "schedule_id", F.col("arrival_time").alias("scheduled_arrival"), "schedule_date"
    ).filter("scheduled_arrival IS NOT NULL")
    joined = spread_join(predicted, planned, TRIP_KEYS, hot)
    if match_service_date:
        service_day = F.to_date(clock.in_zone(F.col("predicted_arrival"), time_zone))
        joined = joined.filter(F.col("schedule_date") == service_day)
    planned_at = clock.in_zone(F.col("scheduled_arrival"), time_zone)
    delay = clock.seconds_between(F.col("predicted_arrival"), F.col("scheduled_arrival"))
    measured = joined.withColumns(
        {
            "performance_id": keys.surrogate_key(F.col("prediction_id"), F.col("schedule_id")),
            "delay_seconds": delay,
            "is_on_time": clock.is_on_time(delay),
            **_strata(planned_at, F.col("schedule_date")),
        }
    )
    return with_daily_weather(measured, F.to_date(planned_at), daily).select(
        *("performance_id", "predicted_arrival", "scheduled_arrival", "delay_seconds"),
        *("is_on_time", "stop_id", "stop_h3_index", "route_id", "route_long_name"),
        *("schedule_date", "hour", "hour_bucket", "day_type", "trip_id", "fetched_at"),
        *("weather_condition", "precipitation_inches", "temp_max_f", "temp_min_f"),
        *("snow_inches", "wind_speed_mph", "weather_category_detailed"),
        "weather_severity_score",
    )


def driving_performance(
    driving: DataFrame, daily: DataFrame, time_zone: str | None = None
) -> DataFrame:
    """Driving times with traffic delay, strata and weather."""
    in_traffic, baseline = F.col("duration_in_traffic_seconds"), F.col("duration_seconds")
    measured = driving.withColumns(
        {
            "driving_id": keys.surrogate_key(
                F.col("route_name"), F.col("departure_time"), F.col("fetched_at")
            ),
            "traffic_delay_seconds": (in_traffic.cast("long") - baseline).try_cast("int"),
            "traffic_impact_pct": scoring.traffic_impact_pct(in_traffic, baseline),
            **_strata(clock.in_zone(F.col("departure_time"), time_zone), F.col("fetched_date")),
        }
    )
    return with_daily_weather(measured, F.col("fetched_date"), daily).select(
        *("driving_id", "route_name", "origin_latitude", "origin_longitude"),
        *("origin_h3_index", "destination_latitude", "destination_longitude"),
        *("destination_h3_index", "distance_meters", "duration_seconds"),
        *("duration_in_traffic_seconds", "departure_time", "fetched_date", "fetched_at"),
        *("hour", "hour_bucket", "day_type", "traffic_delay_seconds", "traffic_impact_pct"),
        *("weather_condition", "precipitation_inches", "temp_max_f"),
        *("weather_category_detailed", "weather_severity_score"),
    )
