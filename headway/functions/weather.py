"""Weather labels and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.labels import first_match

# Labels and weights that results are compared on.
CONDITIONS = ("clear", "rain", "snow")
MISSING_CONDITION = "clear"
WET_ABOVE_INCHES = 0.1
POINTS_PER_RAIN_INCH = 10
POINTS_PER_SNOW_INCH = 20
SEVERITY_LIMIT = 100


def condition(precipitation: Column, snow: Column) -> Column:
    """Coarse condition of a day; an absent measure counts as zero."""
    return first_match(
        [
            (F.coalesce(snow, F.lit(0.0)) > 0, "snow"),
            (F.coalesce(precipitation, F.lit(0.0)) > WET_ABOVE_INCHES, "rain"),
        ],
        "clear",
    )


def detailed_category(precipitation: Column, snow: Column, temp_max: Column) -> Column:
    """Fine category of a day, the first rule that holds."""
    return first_match(
        [
            (snow > 2, "heavy_snow"),
            (snow > 0, "light_snow"),
            (precipitation > 0.5, "heavy_rain"),
            (precipitation > WET_ABOVE_INCHES, "light_rain"),
            (temp_max < 20, "extreme_cold"),
        ],
        "clear",
    )


def severity_score(precipitation: Column, snow: Column, temp_max: Column, wind: Column) -> Column:
    """0-100 severity; each absent measure adds nothing."""
    heat = first_match([(temp_max < 20, 30.0), (temp_max > 95, 20.0)], 0.0)
    gusts = first_match([(wind > 30, 20.0), (wind > 15, 10.0)], 0.0)
    wet = F.coalesce(precipitation * POINTS_PER_RAIN_INCH, F.lit(0.0))
    white = F.coalesce(snow * POINTS_PER_SNOW_INCH, F.lit(0.0))
    return F.least(F.lit(float(SEVERITY_LIMIT)), wet + white + heat + gusts)


def condition_order(name: Column) -> Column:
    """Position of a condition from mild to severe; unknown ones come last."""
    places = ((name == label, place) for place, label in enumerate(CONDITIONS, start=1))
    return first_match(places, len(CONDITIONS) + 1)
