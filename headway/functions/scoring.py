"""Reliability arithmetic.

``signed`` tells a measure that can be negative (a delay) from one that cannot
(a duration): only the former is divided by its magnitude.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.labels import at_least, below

# Weights, floors and labels that results are compared on.
ON_TIME_WEIGHT = 0.6
STABILITY_WEIGHT = 0.4
SMALLEST_DIVISOR = 0.1
RELIABILITY_FLOORS = ((90, "highly_reliable"), (75, "moderately_reliable"), (60, "unreliable"))
VOLATILITY_CEILINGS = ((15, "low_volatility"), (30, "medium_volatility"))
IMPACT_FLOORS = ((20, "major_impact"), (10, "moderate_impact"), (5, "minor_impact"))


def minutes(seconds: Column) -> Column:
    return seconds / F.lit(60.0)


def size_of(value: Column, signed: bool) -> Column:
    return F.abs(value) if signed else value


def share(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole


def percent_of(part: Column, base: Column) -> Column:
    """100 * part / base, and 0 where the base is too small to divide by."""
    return F.when(base > SMALLEST_DIVISOR, part.cast("double") / base * 100).otherwise(0.0)


def stability_score(p50: Column, p95: Column, signed: bool) -> Column:
    """100 for no spread between median and p95, falling to 0."""
    spread = p95.cast("double") - p50.cast("double")
    divisor = F.greatest(size_of(p50, signed).cast("double"), F.lit(SMALLEST_DIVISOR))
    return F.greatest(F.lit(0.0), (F.lit(1.0) - spread / divisor) * 100.0)


def reliability_score(on_time: Column, stability: Column) -> Column:
    blend = on_time * ON_TIME_WEIGHT + stability * STABILITY_WEIGHT
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), blend))


def volatility_cv(stddev: Column, mean: Column, signed: bool) -> Column:
    return percent_of(stddev, size_of(mean, signed))


def percentile_spread_pct(p50: Column, p90: Column, signed: bool) -> Column:
    return percent_of(p90.cast("double") - p50.cast("double"), size_of(p50, signed))


def reliability_category(score: Column) -> Column:
    return at_least(score, RELIABILITY_FLOORS, "very_unreliable")


def volatility_category(cv: Column) -> Column:
    return below(cv, VOLATILITY_CEILINGS, "high_volatility")


def confidence_level(trips: Column, enough: int, firm: int) -> Column:
    return below(
        trips, ((enough, "insufficient_data"), (firm, "low_confidence")), "standard_confidence"
    )


def impact_category(delta: Column) -> Column:
    """Size class of a score change; an unknown change is minimal."""
    return at_least(F.abs(delta), IMPACT_FLOORS, "minimal_impact")


def resilience_score(condition: Column, delta: Column) -> Column:
    """100 less the score change, NULL in clear weather.

    ``least`` skips NULL, so a row with nothing to compare with scores 0.
    """
    lost = F.least(F.lit(100.0), F.abs(delta))
    return F.when(condition.isNull() | (condition != "clear"), F.lit(100.0) - lost)


def traffic_impact_pct(in_traffic: Column, baseline: Column) -> Column:
    extra = in_traffic.cast("double") - baseline.cast("double")
    return F.when(baseline > 0, extra / baseline * 100).otherwise(0.0)
