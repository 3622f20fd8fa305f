"""Each rule at and around its limits, and on NULL."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from headway.functions import cells, clock, keys, scoring, weather


def test_hour_buckets(one):
    hours = [0, 5, 6, 8, 9, 15, 16, 18, 19, 23, None]
    found = one("h int", [(h,) for h in hours], clock.hour_bucket(F.col("h")))
    assert found == [
        "OFF_PEAK", "OFF_PEAK", "AM_PEAK", "AM_PEAK", "MIDDAY", "MIDDAY", "PM_PEAK", "PM_PEAK",
        "OFF_PEAK", "OFF_PEAK", "OFF_PEAK",
    ]


def test_day_types(one):
    days = [dt.date(2024, 1, d) for d in (5, 6, 7, 8)] + [None]
    found = one("d date", [(d,) for d in days], clock.day_type(F.col("d")))
    assert found == ["weekday", "weekend", "weekend", "weekday", "weekday"]


def test_on_time_limit(one):
    found = one("d int", [(-900,), (300,), (301,), (None,)], clock.is_on_time(F.col("d")))
    assert found == [True, True, False, False]


def test_delay_sign_and_overflow(one):
    base = dt.datetime(2024, 1, 1)
    rows = [
        (base + dt.timedelta(seconds=90), base),
        (base - dt.timedelta(seconds=90), base),
        (None, base),
        (base + dt.timedelta(days=60000), base),
    ]
    found = one(
        "a timestamp, b timestamp", rows, clock.seconds_between(F.col("a"), F.col("b"))
    )
    assert found == [90, -90, None, None]


def test_time_parsing(one):
    texts = ["2024-01-01T08:30:00-05:00", "2024-01-01T08:30:00.250000", "later", None]
    found = one("s string", [(x,) for x in texts], clock.parse_timestamp(F.col("s")))
    assert found[0] == dt.datetime(2024, 1, 1, 13, 30)
    assert found[1] == dt.datetime(2024, 1, 1, 8, 30, 0, 250000)
    assert found[2:] == [None, None]
    days = one("s string", [("2024-02-29",), ("2023-02-29",)], clock.parse_date(F.col("s")))
    assert days == [dt.date(2024, 2, 29), None]


def test_time_zone_changes_the_hour(one):
    row = [(dt.datetime(2024, 1, 1, 13, 30),)]
    hour = F.hour(clock.in_zone(F.col("t"), "America/New_York"))
    assert one("t timestamp", row, hour) == [8]
    assert one("t timestamp", row, F.hour(clock.in_zone(F.col("t"), None))) == [13]


@pytest.mark.parametrize(
    ("rain", "snow", "warm", "label"),
    [
        (0.0, 2.1, 50.0, "heavy_snow"),
        (0.6, 2.0, 50.0, "light_snow"),
        (0.6, 0.1, 50.0, "light_snow"),
        (0.51, 0.0, 10.0, "heavy_rain"),
        (0.5, 0.0, 50.0, "light_rain"),
        (0.11, None, 50.0, "light_rain"),
        (0.1, 0.0, 19.0, "extreme_cold"),
        (0.1, 0.0, 20.0, "clear"),
        (None, None, None, "clear"),
    ],
)
def test_detailed_weather(one, rain, snow, warm, label):
    column = weather.detailed_category(F.col("r"), F.col("s"), F.col("w"))
    assert one("r double, s double, w double", [(rain, snow, warm)], column) == [label]


@pytest.mark.parametrize(
    ("rain", "snow", "label"),
    [(0.1, 0.0, "clear"), (0.11, 0.0, "rain"), (5.0, 0.01, "snow"), (None, None, "clear")],
)
def test_weather_condition(one, rain, snow, label):
    column = weather.condition(F.col("r"), F.col("s"))
    assert one("r double, s double", [(rain, snow)], column) == [label]


@pytest.mark.parametrize(
    ("values", "score"),
    [
        ((None, None, None, None), 0.0),
        ((1.0, None, 19.0, 31.0), 60.0),
        ((0.0, 1.0, 20.0, 30.0), 30.0),
        ((0.0, 0.0, 95.0, 15.0), 0.0),
        ((0.0, 0.0, 96.0, 16.0), 30.0),
        ((3.0, 6.0, 10.0, 40.0), 100.0),
    ],
)
def test_severity(one, values, score):
    column = weather.severity_score(F.col("r"), F.col("s"), F.col("w"), F.col("v"))
    assert one("r double, s double, w double, v double", [values], column) == [score]


def test_score_labels(one):
    scores = [(90.0,), (89.99,), (75.0,), (60.0,), (59.99,)]
    assert one("s double", scores, scoring.reliability_category(F.col("s"))) == [
        "highly_reliable", "moderately_reliable", "moderately_reliable", "unreliable",
        "very_unreliable",
    ]
    spread = [(14.99,), (15.0,), (30.0,), (None,)]
    assert one("s double", spread, scoring.volatility_category(F.col("s"))) == [
        "low_volatility", "medium_volatility", "high_volatility", "high_volatility",
    ]
    trips = [(29,), (30,), (99,), (100,)]
    assert one("n int", trips, scoring.confidence_level(F.col("n"), 30, 100)) == [
        "insufficient_data", "low_confidence", "low_confidence", "standard_confidence",
    ]
    deltas = [(-20.0,), (10.0,), (5.0,), (-4.9,), (None,)]
    assert one("d double", deltas, scoring.impact_category(F.col("d"))) == [
        "major_impact", "moderate_impact", "minor_impact", "minimal_impact", "minimal_impact",
    ]


def test_stability(one):
    rows = [(100, 150), (0, 0), (0, 5), (-100, -50), (100, 250)]
    signed = scoring.stability_score(F.col("a"), F.col("b"), True)
    assert one("a int, b int", rows, signed) == [50.0, 100.0, 0.0, 50.0, 0.0]
    unsigned = scoring.stability_score(F.col("a"), F.col("b"), False)
    assert one("a int, b int", [(-100, -50)], unsigned) == [0.0]


def test_guarded_shares(one):
    cv = scoring.volatility_cv(F.col("s"), F.col("m"), True)
    rows = [(5.0, 0.1), (5.0, -10.0), (5.0, 0.0), (None, 10.0)]
    assert one("s double, m double", rows, cv) == [0.0, 50.0, 0.0, None]
    unsigned = scoring.volatility_cv(F.col("s"), F.col("m"), False)
    assert one("s double, m double", [(5.0, -10.0)], unsigned) == [0.0]
    impact = scoring.traffic_impact_pct(F.col("a"), F.col("b"))
    assert one("a int, b int", [(150, 100), (150, 0), (150, None), (None, 100)], impact) == [
        50.0, 0.0, 0.0, None,
    ]


def test_resilience(one):
    column = scoring.resilience_score(F.col("w"), F.col("d"))
    rows = [("clear", 5.0), ("rain", -5.0), ("snow", 250.0), ("rain", None), (None, 1.0)]
    assert one("w string, d double", rows, column) == [None, 95.0, 0.0, 0.0, 99.0]


def test_surrogate_key(one):
    found = one("a string, b int", [("x", None)], keys.surrogate_key(F.col("a"), F.col("b")))
    assert found == [hashlib.md5(b"x||_null_").hexdigest()]


def test_cells(one):
    column = cells.hex_cell(F.col("lat"), F.col("lon"))
    points = [(42.3601, -71.0589), (42.3602, -71.0590), (42.5, -71.0589), (0.0, 0.0), (None, 1.0)]
    near, also, far, origin, missing = one("lat double, lon double", points, column)
    assert near == also != far
    assert origin == "hx8:0:0"
    assert missing is None


def test_cell_centres_are_nearest(spark):
    """Every point lies within one edge of the centre of its cell."""
    lat, lon = F.col("id") / 997.0 + 41, F.col("id") * 7 % 1000 / 991.0 - 71
    rows = (
        spark.range(1000)
        .select(lat.alias("lat"), lon.alias("lon"), cells.hex_cell(lat, lon).alias("cell"))
        .collect()
    )
    import math

    for row in rows:
        _, q, r = row.cell.split(":")
        north = math.radians(row.lat) * cells.EARTH_RADIUS_M
        east = math.radians(row.lon) * math.cos(math.radians(row.lat)) * cells.EARTH_RADIUS_M
        edge = cells.EDGE_M_AT_8
        centre_n = int(r) * 1.5 * edge
        centre_e = (int(q) + int(r) / 2) * math.sqrt(3) * edge
        assert math.hypot(north - centre_n, east - centre_e) <= edge * 1.000001


def test_rows_without_an_id_are_no_versions_of_each_other(spark):
    from headway.plans import staging

    rows = [("p", 1), ("p", 2), (None, 1), (None, 1), (None, 2)]
    frame = spark.createDataFrame(rows, "prediction_id string, fetched_at int")
    found = sorted(staging.latest_predictions(frame).collect(), key=repr)
    assert [tuple(r) for r in found] == sorted([("p", 2), (None, 1), (None, 1), (None, 2)], key=repr)
