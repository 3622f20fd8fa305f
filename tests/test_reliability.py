"""Facts against brute force in plain Python."""

from __future__ import annotations

import math
import random
import statistics
from collections import defaultdict

import pytest

from headway.operators import reliability as rel

SCHEMA = """stop_h3_index string, route_id string, route_long_name string, hour_bucket string,
    day_type string, weather_condition string, delay_seconds int, is_on_time boolean"""


def _group(stop, delays):
    return [
        (stop, "R", "Route", "MIDDAY", "weekday", "clear", d, d is not None and d <= 300)
        for d in delays
    ]


@pytest.fixture(scope="module")
def trips():
    rng = random.Random(7)
    rows = []
    for size in (1, 19, 20, 29, 30, 49, 50, 99, 100, 140):
        rows += _group(f"n{size}", [rng.randint(-200, 900) for _ in range(size)])
    rows += _group("zero", [0] * 40)
    rows += _group("balanced", [-60, 60] * 20)
    rows += _group(None, [rng.choice((5, 10, 400)) for _ in range(600)])
    rows += _group("gaps", [None] * 5 + [100] * 30)
    return rows


def _expected(rows, least):
    groups = defaultdict(list)
    for stop, *_, delay, on_time in rows:
        if delay is not None:
            groups[stop].append((delay, on_time))
    facts = {}
    for stop, values in groups.items():
        n = len(values)
        if n < least:
            continue
        delays = sorted(d for d, _ in values)
        p50, p90, p95 = (delays[-(-n * p // 100) - 1] for p in (50, 90, 95))
        mean = statistics.fmean(delays)
        deviation = statistics.stdev(delays) if n > 1 else None
        score = 100 * sum(ok for _, ok in values) / n
        stability = max(0.0, 100 * (1 - (p95 - p50) / max(abs(p50), 0.1)))
        steady = abs(mean) <= 0.1
        cv = 0.0 if steady else None if deviation is None else deviation / abs(mean) * 100
        facts[stop] = {
            "trip_count": n,
            "p50_delay_sec": p50,
            "p90_delay_sec": p90,
            "p95_delay_sec": p95,
            "mean_delay_sec": mean,
            "stddev_delay_sec": deviation,
            "on_time_score": score,
            "stability_score": stability,
            "reliability_score": min(100.0, max(0.0, 0.6 * score + 0.4 * stability)),
            "transit_volatility_cv": cv,
            "percentile_spread_pct": (p90 - p50) / abs(p50) * 100 if abs(p50) > 0.1 else 0.0,
            "recommended_buffer_min": p90 / 60,
        }
    return facts


@pytest.mark.parametrize("percentiles", ["exact", "ranked", "sketch"])
@pytest.mark.parametrize("least", [None, 1])
def test_transit_fact(spark, trips, percentiles, least):
    df = spark.createDataFrame(trips, SCHEMA).repartition(5)
    fact = rel.reliability_fact(df, rel.TRANSIT, percentiles, least)
    found = {r.stop_h3_index: r.asDict() for r in fact.collect()}
    expected = _expected(trips, least or 30)
    assert found.keys() == expected.keys()
    for stop, values in expected.items():
        for name, value in values.items():
            got = found[stop][name]
            if value is None:
                assert got is None, (stop, name)
            else:
                assert math.isclose(got, value, rel_tol=1e-9, abs_tol=1e-9), (stop, name)
    assert found["n99"]["confidence_level"] == "low_confidence"
    assert found["n100"]["confidence_level"] == "standard_confidence"
    if least:
        assert found["n29"]["confidence_level"] == "insufficient_data"


def test_both_ways_give_the_same_columns(spark, trips):
    df = spark.createDataFrame(trips, SCHEMA)
    exact, sketch = (
        rel.reliability_fact(df, rel.TRANSIT, way) for way in ("exact", "sketch")
    )
    assert exact.dtypes == sketch.dtypes
    assert dict(exact.dtypes)["p50_delay_sec"] == "int"
    assert dict(exact.dtypes)["on_time_count"] == "bigint"


def test_driving_fact(spark):
    def trip(seconds, baseline):
        return ("C0", "D0", "Road", "MIDDAY", "weekday", "rain", seconds, baseline, 1, 2.0)

    rows = [trip(900, 600)] * 10 + [trip(901, 600)] * 5 + [trip(900, None)] * 5
    rows += [("few",) + trip(900, 600)[1:]] * 19
    df = spark.createDataFrame(
        rows,
        """origin_h3_index string, destination_h3_index string, route_name string,
        hour_bucket string, day_type string, weather_condition string,
        duration_in_traffic_seconds int, duration_seconds int, traffic_delay_seconds int,
        traffic_impact_pct double""",
    )
    (row,) = rel.reliability_fact(df, rel.DRIVING).collect()
    assert row.trip_count == 20
    assert row.on_time_count == 10  # an unknown baseline is not on time
    assert row.avg_baseline_duration_sec == 600.0
    assert row.median_duration_min == 15.0
    assert row.confidence_level == "low_confidence"
    assert row.transportation_mode == "Driving"


def test_unknown_way(spark, trips):
    with pytest.raises(ValueError, match="exact"):
        rel.trip_statistics(spark.createDataFrame(trips, SCHEMA), rel.TRANSIT, "some")


def test_expectations_hold_on_a_fact(spark, trips):
    from headway.operators.expectations import violations

    fact = rel.reliability_fact(spark.createDataFrame(trips, SCHEMA), rel.TRANSIT)
    report = violations(fact, rel.TRANSIT.table, rel.TRANSIT.expectations())
    assert {r.failed_rows for r in report.collect()} == {0}


def test_ranked_equals_exact_on_wide_and_uneven_groups(spark):
    """Values over all of 32 bits, negative ones, null keys, groups of one and a large one."""
    import random

    rng = random.Random(4)
    rows = []
    for i in range(3000):
        key = None if i % 7 == 0 else f"r{min(i % 40, 9)}"
        value = rng.choice([rng.randint(-(2**31), 2**31 - 1), rng.randint(-5000, 5000), -4096, 4095, 0])
        rows.append((key, "h", value, value < 300))
    rows.append(("alone", "h", -7, True))
    df = spark.createDataFrame(rows, "route_id string, hour_bucket string, delay_seconds int, is_on_time boolean")
    df = df.selectExpr(
        "*", "'s' AS stop_h3_index", "route_id AS route_long_name", "'d' AS day_type", "'clear' AS weather_condition"
    )
    exact, ranked = (rel.trip_statistics(df, rel.TRANSIT, way) for way in ("exact", "ranked"))
    assert dict(exact.dtypes) == dict(ranked.dtypes)
    assert exact.count() == ranked.count() == 12
    theirs = {r.route_id: r.asDict() for r in exact.collect()}
    for row in ranked.collect():
        for name, mine in row.asDict().items():
            other = theirs[row.route_id][name]
            close = pytest.approx(other, rel=1e-9) if isinstance(other, float) else other
            assert mine == close, (name, row)
