"""Station observations from long to wide form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.weather import condition

# Observation codes and the columns they fill.
MEASURES = {
    "PRCP": "precipitation_inches",
    "TMAX": "temp_max_f",
    "TMIN": "temp_min_f",
    "SNOW": "snow_inches",
    "SNWD": "snow_depth_inches",
    "AWND": "wind_speed_mph",
}


def pivot_observations(
    df: DataFrame, keys: list[str], datatype: str = "datatype", value: str = "value",
    position: str = "pos",
) -> DataFrame:
    """One row per key; the last observation of a code wins, an absent one is NULL.

    A conditional ``max_by`` per code keeps one value per key and task before
    the shuffle.
    """
    return df.groupBy(*keys).agg(
        *[
            F.max_by(value, F.when(F.col(datatype) == code, F.col(position))).alias(name)
            for code, name in MEASURES.items()
        ]
    )


def last_observation(results: Column, code: str) -> Column:
    """Value of the last entry with ``code`` in an array of observations."""
    matching = F.filter(results, lambda entry: entry["datatype"] == code)
    return F.try_element_at(matching, F.lit(-1))["value"].cast("double")


def with_condition(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "weather_condition", condition(F.col("precipitation_inches"), F.col("snow_inches"))
    )
