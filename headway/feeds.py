"""The four raw feeds: where they land, their fields and how they are stored."""

from __future__ import annotations

from dataclasses import dataclass, field

from headway.operators.expectations import Expectation


@dataclass(frozen=True)
class Feed:
    folder: str
    table: str
    schema: str
    timestamps: tuple[str, ...]
    dates: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    expectations: tuple[Expectation, ...] = field(default=())


STOP_FIELDS = """
    stop_id string, stop_name string, stop_latitude double, stop_longitude double,
    stop_h3_index string, route_id string, route_long_name string, route_type int,
    trip_id string
"""


def _schema(fields: str) -> str:
    return " ".join(fields.split())


# Folder, table and field names that existing files and queries use.
PREDICTIONS = Feed(
    folder="mbta_predictions",
    table="bronze_mbta_predictions",
    schema=_schema(
        f"""prediction_id string, arrival_time string, departure_time string,
        direction_id int, schedule_relationship string, status string, {STOP_FIELDS},
        fetched_at string, fetched_date string"""
    ),
    timestamps=("arrival_time", "departure_time", "fetched_at"),
    dates=("fetched_date",),
    partition_by=("fetched_date",),
    cluster_by=("stop_h3_index", "route_id"),
    expectations=(
        Expectation("valid_prediction_id", "prediction_id IS NOT NULL"),
        Expectation("valid_route_id", "route_id IS NOT NULL"),
    ),
)

SCHEDULES = Feed(
    folder="mbta_schedules",
    table="bronze_mbta_schedules",
    schema=_schema(
        f"""schedule_id string, arrival_time string, departure_time string,
        direction_id int, drop_off_type int, pickup_type int, stop_sequence int,
        timepoint boolean, {STOP_FIELDS}, schedule_date string, fetched_at string"""
    ),
    timestamps=("arrival_time", "departure_time", "fetched_at"),
    dates=("schedule_date",),
    partition_by=("schedule_date",),
    cluster_by=("schedule_date", "route_id"),
    expectations=(
        Expectation("valid_schedule_id", "schedule_id IS NOT NULL"),
        Expectation("valid_route_id", "route_id IS NOT NULL"),
    ),
)

WEATHER = Feed(
    folder="noaa_weather",
    table="bronze_noaa_weather",
    schema=_schema(
        """observation_date string, station_id string, station_name string,
        precipitation_inches double, temp_max_f double, temp_min_f double,
        snow_inches double, snow_depth_inches double, wind_speed_mph double,
        weather_condition string, fetched_at string"""
    ),
    timestamps=("fetched_at",),
    dates=("observation_date",),
    expectations=(
        Expectation("valid_observation_date", "observation_date IS NOT NULL"),
        Expectation("valid_weather_condition", "weather_condition IN ('clear', 'rain', 'snow')"),
    ),
)

DRIVING = Feed(
    folder="driving_routes",
    table="bronze_driving_routes",
    schema=_schema(
        """route_name string, origin_address string, origin_latitude double,
        origin_longitude double, origin_h3_index string, destination_address string,
        destination_latitude double, destination_longitude double,
        destination_h3_index string, distance_meters int, duration_seconds int,
        duration_in_traffic_seconds int, departure_time string, fetched_date string,
        fetched_at string"""
    ),
    timestamps=("departure_time", "fetched_at"),
    dates=("fetched_date",),
    partition_by=("fetched_date",),
    expectations=(
        Expectation("valid_route_name", "route_name IS NOT NULL"),
        Expectation("valid_duration", "duration_seconds IS NOT NULL AND duration_seconds > 0"),
    ),
)

FEEDS = {
    "mbta_predictions": PREDICTIONS,
    "mbta_schedules": SCHEDULES,
    "noaa": WEATHER,
    "driving": DRIVING,
}
