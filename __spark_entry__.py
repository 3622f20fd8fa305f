"""Queries over the given tables, each with SQL that must give the same rows."""

from __future__ import annotations

import functools
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import trial_tables as t  # noqa: E402
from headway import feeds  # noqa: E402
from headway.functions import cells, clock, keys, weather  # noqa: E402
from headway.functions.labels import first_match  # noqa: E402
from headway.operators import changes, comparison, expectations, joins, observations, reliability  # noqa: E402
from headway.plans import daily, landing as payload_landing, reports, staging  # noqa: E402
from headway.session import durable, scratch_path, stored, tune  # noqa: E402
from headway.sinks import tables as sink  # noqa: E402
from headway.sources import files, payloads, routes  # noqa: E402
from headway.streaming import feeds as streams  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL to compare it with."""

    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            return t.plain(run(tune(spark), folder))

        _QUERIES[run.__name__] = prepared
        if sql is not None:
            _SQL[run.__name__] = sql
        return prepared

    return register


def entry(spark: SparkSession) -> DataFrame:
    return _QUERIES["ship_delay_reliability"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- column rules -----------------------------------------------------------------


@query(f"SELECT event_id, {t.strata_sql('ts', 'ts')} FROM events")
def hour_and_day_strata(spark: SparkSession, folder: str) -> DataFrame:
    hour = F.hour("ts")
    return t.table(spark, folder, "events").select(
        "event_id",
        hour.alias("hour"),
        clock.hour_bucket(hour).alias("hour_bucket"),
        clock.day_type(F.col("ts")).alias("day_type"),
    )


@query(
    """SELECT l_orderkey, l_linenumber,
    CAST(epoch(l_shipdate) - epoch(o_orderdate) AS INTEGER) AS delay_seconds,
    epoch(l_shipdate) - epoch(o_orderdate) <= 300 AS is_on_time
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def delay_and_punctuality(spark: SparkSession, folder: str) -> DataFrame:
    delay = clock.seconds_between(F.col("l_shipdate"), F.col("o_orderdate"))
    return _shipped(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        delay.alias("delay_seconds"),
        clock.is_on_time(delay).alias("is_on_time"),
    )


def _shipped(spark: SparkSession, folder: str) -> DataFrame:
    lines = t.table(spark, folder, "lineitem")
    return lines.join(
        t.table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).filter("l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL")


@query(
    """SELECT event_id, try_cast(written AS TIMESTAMP) IS NOT NULL AS readable,
    strftime(try_cast(written AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS at,
    CAST(CAST(try_cast(written AS TIMESTAMP) AS DATE) AS VARCHAR) AS day
    FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'soon'
        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS written FROM events)"""
)
def parsed_times(spark: SparkSession, folder: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    written = F.when(F.col("event_id") % 10 == 0, "soon").otherwise(text)
    at = clock.parse_timestamp(written)
    return t.table(spark, folder, "events").select(
        "event_id",
        at.isNotNull().alias("readable"),
        at.alias("at"),
        clock.parse_date(F.substring(written, 1, 10)).alias("day"),
    )


@query(
    """SELECT o_orderkey, md5(concat_ws('||', coalesce(CAST(o_custkey AS VARCHAR), '_null_'),
    coalesce(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END, '_null_'))) AS key
    FROM orders"""
)
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    second = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    return t.table(spark, folder, "orders").select(
        "o_orderkey", keys.surrogate_key(F.col("o_custkey"), second).alias("key")
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN coalesce(snow, 0) > 0 THEN 'snow' WHEN coalesce(rain, 0) > 0.1::DOUBLE THEN 'rain'
        ELSE 'clear' END AS weather_condition,
    CASE WHEN snow > 2 THEN 'heavy_snow' WHEN snow > 0 THEN 'light_snow'
        WHEN rain > 0.5 THEN 'heavy_rain' WHEN rain > 0.1::DOUBLE THEN 'light_rain'
        WHEN warm < 20 THEN 'extreme_cold' ELSE 'clear' END AS weather_category_detailed,
    least(100.0::DOUBLE, coalesce(rain * 10, 0) + coalesce(snow * 20, 0)
        + CASE WHEN warm < 20 THEN 30 WHEN warm > 95 THEN 20 ELSE 0 END
        + CASE WHEN wind > 30 THEN 20 WHEN wind > 15 THEN 10 ELSE 0 END)::DOUBLE
        AS weather_severity_score
    FROM (SELECT *, CASE WHEN l_linenumber <> 7 THEN (l_partkey % 8) / 8::DOUBLE END AS rain,
        CASE WHEN l_linenumber <> 6 THEN greatest(0, l_suppkey % 9 - 5) / 1::DOUBLE END AS snow,
        l_quantity * 2 AS warm, l_quantity AS wind FROM lineitem)"""
)
def weather_labels(spark: SparkSession, folder: str) -> DataFrame:
    rain = F.when(F.col("l_linenumber") != 7, F.col("l_partkey") % 8 / F.lit(8.0))
    snow = F.when(
        F.col("l_linenumber") != 6,
        F.greatest(F.lit(0), F.col("l_suppkey") % 9 - 5).cast("double"),
    )
    warm, wind = F.col("l_quantity") * 2, F.col("l_quantity")
    return t.table(spark, folder, "lineitem").select(
        *("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        weather.condition(rain, snow).alias("weather_condition"),
        weather.detailed_category(rain, snow, warm).alias("weather_category_detailed"),
        weather.severity_score(rain, snow, warm, wind).alias("weather_severity_score"),
    )


_EDGE = cells.EDGE_M_AT_8
_HEX = f"""SELECT c_custkey, CASE WHEN c_custkey % 40 <> 0 THEN concat_ws(':', 'hx8',
        CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN -nr - ns ELSE nq END AS BIGINT) AS VARCHAR),
        CAST(CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -nq - ns ELSE nr END
            AS BIGINT) AS VARCHAR)) END AS cell
    FROM (SELECT *, abs(nq - q) AS dq, abs(nr - r) AS dr, abs(ns - s) AS ds
      FROM (SELECT *, floor(q + 0.5) AS nq, floor(r + 0.5) AS nr, floor(s + 0.5) AS ns
        FROM (SELECT *, -q - r AS s
          FROM (SELECT c_custkey,
            (east * (sqrt(3.0::DOUBLE) / 3) - north / 3) / {_EDGE}::DOUBLE AS q,
            north * (2.0::DOUBLE / 3) / {_EDGE}::DOUBLE AS r
            FROM (SELECT c_custkey, radians(lat) * 6371008.8::DOUBLE AS north,
              radians(lon) * cos(radians(lat)) * 6371008.8::DOUBLE AS east
              FROM (SELECT c_custkey, (c_custkey * 7919 % 1800000) / 10000.0::DOUBLE - 90 AS lat,
                (c_custkey * 104729 % 3600000) / 10000.0::DOUBLE - 180 AS lon
                FROM customer))))))"""


@query(_HEX)
def hexagon_cells(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    lat = F.when(key % 40 != 0, key * 7919 % 1800000 / F.lit(10000.0) - 90)
    lon = key * 104729 % 3600000 / F.lit(10000.0) - 180
    return t.table(spark, folder, "customer").select(
        "c_custkey", cells.hex_cell(lat, lon).alias("cell")
    )


@query("SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events")
def json_fields(spark: SparkSession, folder: str) -> DataFrame:
    props = F.from_json("props", "k int, missing struct<inner: int>")
    return t.table(spark, folder, "events").select("event_id", props["k"].alias("k"))


# --- staging datasets ---------------------------------------------------------------

_WEATHER_SHOWN = """observation_date:d precipitation_inches temp_max_f temp_min_f snow_inches
    snow_depth_inches wind_speed_mph weather_condition station_id station_name"""


@query(t.with_tables(f"SELECT {t.shown_sql(_WEATHER_SHOWN)} FROM weather", "weather"))
def weather_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return t.weather(spark, folder)


_DAILY_SHOWN = _WEATHER_SHOWN + " weather_category_detailed weather_severity_score"


@query(t.with_tables(f"SELECT {t.shown_sql(_DAILY_SHOWN)} FROM weather_daily", "weather_daily"))
def weather_daily(spark: SparkSession, folder: str) -> DataFrame:
    return expectations.keep_valid(t.weather_daily(spark, folder), staging.WEATHER_RULES)


_TRANSIT_SHOWN = t.shown_sql(
    """performance_id predicted_arrival:t scheduled_arrival:t delay_seconds is_on_time stop_id
    stop_h3_index route_id route_long_name schedule_date:d hour hour_bucket day_type trip_id
    fetched_at:t weather_condition precipitation_inches temp_max_f temp_min_f snow_inches
    wind_speed_mph weather_category_detailed weather_severity_score"""
)
_TRANSIT_SQL = t.with_tables(f"SELECT {_TRANSIT_SHOWN} FROM transit", "transit")


@query(_TRANSIT_SQL)
def transit_performance(spark: SparkSession, folder: str) -> DataFrame:
    return expectations.keep_valid(t.transit(spark, folder), staging.TRANSIT_RULES)


@query(
    t.with_tables(
        f"""SELECT {_TRANSIT_SHOWN} FROM transit
        WHERE schedule_date = CAST(predicted_arrival AS DATE)""",
        "transit",
    )
)
def transit_performance_same_day(spark: SparkSession, folder: str) -> DataFrame:
    return t.transit(spark, folder, match_service_date=True)


@query(
    t.with_tables(
        """SELECT prediction_id, trip_id, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at
        FROM (SELECT trip_id AS prediction_id, trip_id, max(fetched_at) AS fetched_at
            FROM predictions GROUP BY trip_id)""",
        "predictions",
    )
)
def latest_predictions(spark: SparkSession, folder: str) -> DataFrame:
    repeated = t.predictions(spark, folder).withColumn("prediction_id", F.col("trip_id"))
    return staging.latest_predictions(repeated).select("prediction_id", "trip_id", "fetched_at")


@query(
    t.with_tables(
        """SELECT trip_id, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at
        FROM (SELECT trip_id, fetched_at FROM predictions WHERE trip_id IS NULL
            UNION ALL SELECT trip_id, fetched_at FROM predictions
            WHERE hash_key % 3 = 0 UNION ALL SELECT trip_id, max(fetched_at) FROM predictions
            WHERE hash_key % 3 <> 0 GROUP BY trip_id)""".replace("hash_key", "length(trip_id)"),
        "predictions",
    )
)
def latest_predictions_with_unknown_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of a prediction collapse; rows without an id all stay."""
    some = F.when(F.length("trip_id") % 3 != 0, F.col("trip_id"))
    repeated = t.predictions(spark, folder).withColumn("prediction_id", some)
    return staging.latest_predictions(repeated).select("trip_id", "fetched_at")


@query(
    """SELECT c_custkey, s_suppkey, c_nationkey AS nation FROM customer
    JOIN supplier ON c_nationkey = s_nationkey"""
)
def crowded_nations(spark: SparkSession, folder: str) -> DataFrame:
    """A many-to-many join in which every key is hot by the pairs it makes."""
    left = t.table(spark, folder, "customer").selectExpr("c_nationkey AS nation", "c_custkey")
    right = t.table(spark, folder, "supplier").selectExpr("s_nationkey AS nation", "s_suppkey")
    hot = joins.hot_keys(left, right, ["nation"], share=0.001, pairs_per_task=4)
    return joins.spread_join(left, right, ["nation"], hot).select("c_custkey", "s_suppkey", "nation")


_DRIVEN_SHOWN = t.shown_sql(
    """driving_id route_name origin_latitude origin_longitude origin_h3_index
    destination_latitude destination_longitude destination_h3_index distance_meters
    duration_seconds duration_in_traffic_seconds departure_time:t fetched_date:d fetched_at:t hour
    hour_bucket day_type traffic_delay_seconds traffic_impact_pct:r weather_condition
    precipitation_inches temp_max_f weather_category_detailed weather_severity_score"""
)
_DRIVEN_SQL = t.with_tables(
    f"SELECT {_DRIVEN_SHOWN.replace('driving_id, ', '')} FROM driven"
    " WHERE duration_in_traffic_seconds IS NOT NULL",
    "driven",
)


@query(_DRIVEN_SQL)
def driving_performance(spark: SparkSession, folder: str) -> DataFrame:
    # The id hashes timestamps as text, which the two engines write differently.
    rows = expectations.keep_valid(t.driven(spark, folder), staging.DRIVING_RULES)
    return rows.drop("driving_id")


@query(
    t.with_tables(
        """SELECT md5(concat_ws('||', route_name, strftime(departure_time, '%Y-%m-%d %H:%M:%S'),
        strftime(fetched_at, '%Y-%m-%d %H:%M:%S'))) AS driving_id
        FROM (SELECT route_name, date_trunc('second', departure_time) AS departure_time,
            fetched_at FROM driving)""",
        "driving",
    )
)
def driving_ids(spark: SparkSession, folder: str) -> DataFrame:
    whole = F.date_trunc("second", F.col("departure_time"))
    return t.driving(spark, folder).select(
        keys.surrogate_key(F.col("route_name"), whole, F.col("fetched_at")).alias("driving_id")
    )


# --- facts --------------------------------------------------------------------------

_SCORES = """on_time_count on_time_rate:r on_time_score:r stability_score:r reliability_score:r
    transit_volatility_cv:r percentile_spread_pct:r reliability_category volatility_category
    confidence_level recommended_buffer_min:r transportation_mode"""
_TRANSIT_FACT_SQL = t.with_tables(
    "SELECT "
    + t.shown_sql(
        """stop_h3_index route_id route_long_name hour_bucket day_type weather_condition
        trip_count p50_delay_sec p90_delay_sec p95_delay_sec mean_delay_sec:r stddev_delay_sec:r """
        + _SCORES
    )
    + " FROM transit_fact",
    "transit_fact",
)
_DRIVING_FACT_SQL = t.with_tables(
    "SELECT "
    + t.shown_sql(
        """origin_h3_index destination_h3_index route_name hour_bucket day_type weather_condition
        trip_count p50_duration_sec p90_duration_sec p95_duration_sec mean_duration_sec:r
        stddev_duration_sec:r avg_baseline_duration_sec:r avg_traffic_delay_sec:r
        avg_traffic_impact_pct:r median_duration_min:r baseline_duration_min:r """
        + _SCORES
    )
    + " FROM driving_fact",
    "driving_fact",
)


def _transit_fact(
    spark: SparkSession, folder: str, percentiles: str = "exact", known: DataFrame | None = None
) -> DataFrame:
    trips = t.transit(spark, folder, known)
    return reliability.reliability_fact(trips, reliability.TRANSIT, percentiles)


def _driving_fact(
    spark: SparkSession, folder: str, percentiles: str = "exact", known: DataFrame | None = None
) -> DataFrame:
    trips = t.driven(spark, folder, known)
    return reliability.reliability_fact(trips, reliability.DRIVING, percentiles)


@query(_TRANSIT_FACT_SQL)
def transit_reliability(spark: SparkSession, folder: str) -> DataFrame:
    return _transit_fact(spark, folder)


@query(_TRANSIT_FACT_SQL)
def transit_reliability_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Equal to the SQL while groups stay below some 5,000 rows, close to it beyond."""
    return _transit_fact(spark, folder, "sketch")


@query(_TRANSIT_FACT_SQL)
def transit_reliability_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks selected in two levels, without a window over the values of a group."""
    return _transit_fact(spark, folder, "ranked")


@query(_DRIVING_FACT_SQL)
def driving_reliability_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return _driving_fact(spark, folder, "ranked")


@query(_DRIVING_FACT_SQL)
def driving_reliability(spark: SparkSession, folder: str) -> DataFrame:
    return _driving_fact(spark, folder)


@query(_DRIVING_FACT_SQL)
def driving_reliability_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return _driving_fact(spark, folder, "sketch")


SHIPPING = reliability.FactSpec(
    table="shipping_reliability",
    mode="Shipping",
    measure="delay_seconds",
    stem="delay",
    keys=("l_suppkey", "l_returnflag"),
    on_time="is_on_time",
    enough_trips=30,
    firm_trips=200,
    signed=True,
)


@query(
    "SELECT "
    + t.shown_sql(
        """l_suppkey l_returnflag trip_count p50_delay_sec p90_delay_sec p95_delay_sec """
        + _SCORES
    )
    + ", round(mean_delay_sec, 2) AS mean_delay_sec, round(stddev_delay_sec, 2)"
    + " AS stddev_delay_sec FROM ("
    + t.fact_sql(
        """(SELECT *, CAST(epoch(l_shipdate) - epoch(o_orderdate) AS INTEGER) AS delay_seconds
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
        "l_suppkey, l_returnflag", "delay_seconds", "delay", "delay_seconds <= 300", {},
        30, 200, True, "Shipping",
    )
    + ")"
)
def ship_delay_reliability(spark: SparkSession, folder: str) -> DataFrame:
    delay = clock.seconds_between(F.col("l_shipdate"), F.col("o_orderdate"))
    shipped = _shipped(spark, folder).withColumns(
        {"delay_seconds": delay, "is_on_time": clock.is_on_time(delay)}
    )
    fact = reliability.reliability_fact(shipped, SHIPPING)
    return fact.withColumns(
        {c: F.round(c, 2) for c in ("mean_delay_sec", "stddev_delay_sec")}  # ten digits are kept
    )


# --- comparison of modes and weather impact ------------------------------------------


def _facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both facts written once, as their consumers read them more than once."""
    known = t.known_weather(spark, folder)
    facts = _transit_fact(spark, folder, known=known), _driving_fact(spark, folder, known=known)
    return stored(facts[0], "fact"), stored(facts[1], "fact")


_PLACE = "PARTITION BY location_h3, hour_bucket, day_type, weather_condition"
_TIES = "transportation_mode NULLS FIRST, route_id NULLS FIRST, route_long_name NULLS FIRST"


def _order_sql(column: str, direction: str) -> str:
    rest = [
        name
        for name in (
            "reliability_score", "reliability_category", "median_time_min", "p90_time_min",
            "transit_volatility_cv", "trip_count", "confidence_level",
        )
        if name != column
    ]
    return f"{column} {direction}, {_TIES}, " + ", ".join(f"{c} NULLS FIRST" for c in rest)


_BY_SCORE = _order_sql("reliability_score", "DESC NULLS LAST")
_BY_TIME = _order_sql("median_time_min", "ASC NULLS FIRST")
_BY_CV = _order_sql("transit_volatility_cv", "ASC NULLS FIRST")
_COMPARED_SQL = f"""SELECT *, CASE WHEN rank_by_reliability = 1
        OR (reliability_score >= 85 AND rank_by_speed = 1) THEN transportation_mode END
        AS is_recommended
    FROM (SELECT *,
        CAST(row_number() OVER ({_PLACE} ORDER BY {_BY_SCORE}) AS INTEGER) AS rank_by_reliability,
        CAST(row_number() OVER ({_PLACE} ORDER BY {_BY_TIME}) AS INTEGER) AS rank_by_speed,
        CAST(row_number() OVER ({_PLACE} ORDER BY {_BY_CV}) AS INTEGER) AS rank_by_predictability,
        first_value(transportation_mode) OVER ({_PLACE} ORDER BY {_BY_SCORE})
            AS most_reliable_mode,
        first_value(transportation_mode) OVER ({_PLACE} ORDER BY {_BY_TIME}) AS fastest_mode,
        first_value(transportation_mode) OVER ({_PLACE} ORDER BY {_BY_CV})
            AS most_predictable_mode,
        median_time_min - min(median_time_min) OVER ({_PLACE}) AS time_delta_from_fastest_min,
        reliability_score - max(reliability_score) OVER ({_PLACE}) AS reliability_delta_from_best
        FROM modes)"""
_COMPARED_SHOWN = t.shown_sql(
    """location_h3 route_id route_long_name hour_bucket day_type weather_condition
    transportation_mode reliability_score:r reliability_category median_time_min:r p90_time_min:r
    transit_volatility_cv:r trip_count confidence_level rank_by_reliability rank_by_speed
    rank_by_predictability most_reliable_mode fastest_mode most_predictable_mode is_recommended
    time_delta_from_fastest_min:r reliability_delta_from_best:r"""
)
_COMPARISON_SQL = t.with_tables(f"SELECT {_COMPARED_SHOWN} FROM ({_COMPARED_SQL})", "modes")


@query(_COMPARISON_SQL)
def mode_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.mode_comparison(*_facts(spark, folder))


@query(_COMPARISON_SQL)
def mode_comparison_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken when one place holds more rows than a task should."""
    return comparison.mode_comparison(*_facts(spark, folder), split_above=1)


@query(
    t.with_tables(
        f"SELECT {_COMPARED_SHOWN} FROM ({_COMPARED_SQL}) WHERE rank_by_reliability = 1", "modes"
    )
)
def recommended_modes(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.recommended_only(comparison.mode_comparison(*_facts(spark, folder)))


_SEVERITY = """CASE weather_condition WHEN 'clear' THEN 1 WHEN 'rain' THEN 2 WHEN 'snow' THEN 3
    ELSE 4 END"""
_ROUTE = "PARTITION BY transportation_mode, route_id, location_h3, hour_bucket, day_type"
_IMPACT_ORDER = f"""ORDER BY {_SEVERITY}, route_long_name NULLS FIRST,
    weather_condition NULLS FIRST, reliability_score NULLS FIRST,
    reliability_category NULLS FIRST, median_time_min NULLS FIRST, p90_time_min NULLS FIRST,
    transit_volatility_cv NULLS FIRST, trip_count NULLS FIRST, confidence_level NULLS FIRST"""
_LAGGED = f"""SELECT *,
    reliability_score - lag(reliability_score) OVER w AS reliability_delta_from_clear,
    median_time_min - lag(median_time_min) OVER w AS time_delta_from_clear_min,
    transit_volatility_cv - lag(transit_volatility_cv) OVER w AS volatility_delta_from_clear
    FROM modes WINDOW w AS ({_ROUTE} {_IMPACT_ORDER})"""
_FROM_CLEAR = """SELECT m.*, CASE WHEN m.weather_condition <> 'clear'
        THEN m.reliability_score - c.score END AS reliability_delta_from_clear,
    CASE WHEN m.weather_condition <> 'clear' THEN m.median_time_min - c.minutes END
        AS time_delta_from_clear_min,
    CASE WHEN m.weather_condition <> 'clear' THEN m.transit_volatility_cv - c.cv END
        AS volatility_delta_from_clear
    FROM modes m LEFT JOIN (SELECT transportation_mode, route_id, route_long_name, location_h3,
        hour_bucket, day_type, sum(reliability_score * trip_count) / sum(trip_count) AS score,
        sum(median_time_min * trip_count) / sum(trip_count) AS minutes,
        sum(transit_volatility_cv * trip_count) / sum(trip_count) AS cv
        FROM modes WHERE weather_condition = 'clear' GROUP BY ALL) c
    ON m.transportation_mode = c.transportation_mode
        AND m.route_id IS NOT DISTINCT FROM c.route_id
        AND m.route_long_name IS NOT DISTINCT FROM c.route_long_name
        AND m.location_h3 IS NOT DISTINCT FROM c.location_h3
        AND m.hour_bucket = c.hour_bucket AND m.day_type = c.day_type"""


def _impact_sql(deltas: str) -> str:
    shown = t.shown_sql(
        """transportation_mode route_id route_long_name location_h3 hour_bucket day_type
        weather_condition reliability_score:r median_time_min:r p90_time_min:r
        transit_volatility_cv:r trip_count reliability_delta_from_clear:r
        time_delta_from_clear_min:r volatility_delta_from_clear:r weather_impact_category
        weather_resilience_score:r"""
    )
    return t.with_tables(
        f"""SELECT {shown} FROM (SELECT *,
        CASE WHEN abs(reliability_delta_from_clear) >= 20 THEN 'major_impact'
            WHEN abs(reliability_delta_from_clear) >= 10 THEN 'moderate_impact'
            WHEN abs(reliability_delta_from_clear) >= 5 THEN 'minor_impact'
            ELSE 'minimal_impact' END AS weather_impact_category,
        CASE WHEN weather_condition = 'clear' THEN NULL ELSE 100.0::DOUBLE
            - least(100.0::DOUBLE, abs(reliability_delta_from_clear)) END
            AS weather_resilience_score
        FROM ({deltas}))""",
        "modes",
    )


@query(_impact_sql(_LAGGED))
def weather_impact(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.weather_impact(*_facts(spark, folder))


@query(_impact_sql(_LAGGED))
def weather_impact_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken when one route holds more rows than a task should."""
    return comparison.weather_impact(*_facts(spark, folder), split_above=1)


@query(_impact_sql(_FROM_CLEAR))
def weather_impact_from_clear(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.weather_impact(*_facts(spark, folder), baseline="clear")


# --- expectations ---------------------------------------------------------------------


_UNCHECKED = ("performance_id", "driving_id", "trip_id", "predicted_arrival", "departure_time", "fetched_at")


def _checked(spark: SparkSession, folder: str) -> list[tuple[DataFrame, str, tuple]]:
    weather = stored(t.weather(spark, folder), "weather")
    weather_daily = staging.weather_daily(weather)
    known = stored(t.reported(weather_daily), "weather")
    # written without texts that neither a rule nor a fact reads
    transit = stored(t.transit(spark, folder, known).drop(*_UNCHECKED), "transit")
    driven = stored(t.driven(spark, folder, known).drop(*_UNCHECKED), "driven")
    transit_fact = reliability.reliability_fact(transit, reliability.TRANSIT)
    driving_fact = reliability.reliability_fact(driven, reliability.DRIVING)
    return [
        (t.predictions(spark, folder), "predictions", feeds.PREDICTIONS.expectations),
        (t.schedules(spark, folder), "schedules", feeds.SCHEDULES.expectations),
        (weather, "weather", feeds.WEATHER.expectations),
        (t.driving(spark, folder), "driving", feeds.DRIVING.expectations),
        (weather_daily, "weather_daily", staging.WEATHER_RULES),
        (transit, "transit", staging.TRANSIT_RULES),
        (driven, "driven", staging.DRIVING_RULES),
        (transit_fact, "transit_fact", reliability.TRANSIT.expectations()),
        (driving_fact, "driving_fact", reliability.DRIVING.expectations()),
    ]


def _violations(spark: SparkSession, folder: str) -> DataFrame:
    reported = [expectations.violations(*item) for item in _checked(spark, folder)]
    report = reported[0]
    for more in reported[1:]:
        report = report.unionByName(more)
    return report


_RULES = (
    *(("predictions", rule) for rule in feeds.PREDICTIONS.expectations),
    *(("schedules", rule) for rule in feeds.SCHEDULES.expectations),
    *(("weather", rule) for rule in feeds.WEATHER.expectations),
    *(("driving", rule) for rule in feeds.DRIVING.expectations),
    *(("weather_daily", rule) for rule in staging.WEATHER_RULES),
    *(("transit", rule) for rule in staging.TRANSIT_RULES),
    *(("driven", rule) for rule in staging.DRIVING_RULES),
    *(("transit_fact", rule) for rule in reliability.TRANSIT.expectations()),
    *(("driving_fact", rule) for rule in reliability.DRIVING.expectations()),
)
_VIOLATIONS = " UNION ALL ".join(
    f"""SELECT '{name}' AS dataset, '{rule.name}' AS expectation, '{rule.action}' AS action,
    count(*) AS total_rows, count(*) FILTER (WHERE NOT coalesce({rule.predicate}, false))
    AS failed_rows FROM {name}"""
    for name, rule in _RULES
)


@query(t.with_tables(_VIOLATIONS, "transit_fact", "driving_fact"))
def expectation_report(spark: SparkSession, folder: str) -> DataFrame:
    return _violations(spark, folder)


@query(
    t.with_tables(
        f"""SELECT dataset || '.' || expectation AS test_name, failed_rows = 0 AS passed
        FROM ({_VIOLATIONS})""",
        "transit_fact",
        "driving_fact",
    )
)
def expectation_summary(spark: SparkSession, folder: str) -> DataFrame:
    return expectations.summary(_violations(spark, folder))


@query(
    t.with_tables(
        """SELECT route_name, fetched_date::VARCHAR AS fetched_date, duration_in_traffic_seconds
        FROM driving WHERE duration_in_traffic_seconds IS NOT NULL
        AND duration_seconds IS NOT NULL AND duration_seconds > 0""",
        "driving",
    )
)
def dropped_violations(spark: SparkSession, folder: str) -> DataFrame:
    strict = [
        expectations.Expectation(rule.name, rule.predicate, "drop")
        for rule in feeds.DRIVING.expectations
    ]
    rules = [*strict, staging.DRIVING_RULES[0]]
    kept = expectations.keep_valid(t.driving(spark, folder), rules)
    return kept.select("route_name", "fetched_date", "duration_in_traffic_seconds")


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Customers asking for a route between two places, some of them badly."""
    return t.table(spark, folder, "customer").selectExpr(
        "c_custkey",
        """CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 19 = 0
            THEN repeat(c_name, 6) ELSE c_name END AS name""",
        """named_struct('address', concat('NATION_', c_nationkey),
            'latitude', CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 100 / 1D END,
            'longitude', CASE WHEN c_custkey % 3 <> 1 THEN c_custkey % 190 / 1D END) AS origin""",
        """named_struct('address', CASE WHEN c_custkey % 5 <> 0
            THEN concat('NATION_', c_custkey % 30) END,
            'latitude', CASE WHEN c_custkey % 7 = 0 THEN 0D END,
            'longitude', CASE WHEN c_custkey % 7 = 0 THEN 0D END) AS destination""",
    )


_REQUESTS = """requests AS (SELECT c_custkey,
    CASE WHEN c_custkey % 17 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN repeat(c_name, 6)
        ELSE c_name END AS name,
    concat('NATION_', c_nationkey) AS o_address,
    CASE WHEN c_custkey % 3 = 0 THEN (c_custkey % 100)::DOUBLE END AS o_lat,
    CASE WHEN c_custkey % 3 <> 1 THEN (c_custkey % 190)::DOUBLE END AS o_lon,
    CASE WHEN c_custkey % 5 <> 0 THEN concat('NATION_', c_custkey % 30) END AS d_address,
    CASE WHEN c_custkey % 7 = 0 THEN 0::DOUBLE END AS d_lat,
    CASE WHEN c_custkey % 7 = 0 THEN 0::DOUBLE END AS d_lon FROM customer),
  checked AS (SELECT *, concat_ws(',',
    CASE WHEN NOT length(name) BETWEEN 1 AND 100 THEN 'name_length' END,
    CASE WHEN NOT (o_lat IS NULL OR o_lat BETWEEN -90 AND 90) THEN 'origin_latitude' END,
    CASE WHEN NOT (o_lon IS NULL OR o_lon BETWEEN -180 AND 180) THEN 'origin_longitude' END,
    CASE WHEN NOT ((o_lat IS NOT NULL AND o_lon IS NOT NULL) OR o_address <> '')
        THEN 'origin_given' END,
    CASE WHEN NOT ((d_lat IS NOT NULL AND d_lon IS NOT NULL)
        OR coalesce(d_address, '') <> '') THEN 'destination_given' END) AS broken
    FROM requests)"""


@query(f"WITH {_REQUESTS} SELECT c_custkey, broken FROM checked WHERE broken <> ''")
def quarantined_requests(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = routes.validate_requests(_requests(spark, folder))
    return rejected.select("c_custkey", F.array_join("broken_rules", ",").alias("broken"))


# --- routes ---------------------------------------------------------------------------


def _addresses(spark: SparkSession, folder: str) -> DataFrame:
    return t.table(spark, folder, "nation").selectExpr(
        "n_name AS address",
        "concat(n_name, ', Region ', n_regionkey) AS formatted_address",
        "n_nationkey / 2D AS latitude",
        "-n_nationkey / 1D AS longitude",
    )


_RESOLVED = f"""{_REQUESTS}, resolved AS (SELECT c_custkey, r.name,
    o_address, CASE WHEN o_lat IS NOT NULL AND o_lon IS NOT NULL
        THEN printf('%.6f, %.6f', o_lat, o_lon)
        ELSE concat(o.n_name, ', Region ', o.n_regionkey) END AS o_formatted,
    CASE WHEN o_lat IS NOT NULL AND o_lon IS NOT NULL THEN o_lat
        ELSE o.n_nationkey / 2::DOUBLE END AS o_latitude,
    d_address, CASE WHEN d_lat IS NOT NULL AND d_lon IS NOT NULL
        THEN printf('%.6f, %.6f', d_lat, d_lon)
        WHEN d.n_name IS NOT NULL THEN concat(d.n_name, ', Region ', d.n_regionkey) END
        AS d_formatted,
    CASE WHEN d_lat IS NOT NULL AND d_lon IS NOT NULL THEN d_lon
        ELSE -d.n_nationkey::DOUBLE END AS d_longitude,
    (d_lat IS NOT NULL AND d_lon IS NOT NULL) OR d.n_name IS NOT NULL AS known
    FROM checked r LEFT JOIN nation o ON r.o_address = o.n_name
    LEFT JOIN nation d ON r.d_address = d.n_name WHERE broken = '')"""
_RESOLVED_COLUMNS = """name, o_address, o_formatted, o_latitude, d_address, d_formatted,
    d_longitude"""


def _resolved(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    accepted, _ = routes.validate_requests(_requests(spark, folder))
    return routes.resolve_locations(accepted, _addresses(spark, folder))


def _route_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.selectExpr(
        *more,
        "name",
        "origin.input_address AS o_address",
        "origin.formatted_address AS o_formatted",
        "origin.latitude AS o_latitude",
        "destination.input_address AS d_address",
        "destination.formatted_address AS d_formatted",
        "destination.longitude AS d_longitude",
    )


@query(f"WITH {_RESOLVED} SELECT c_custkey, {_RESOLVED_COLUMNS} FROM resolved WHERE known")
def resolved_requests(spark: SparkSession, folder: str) -> DataFrame:
    return _route_columns(_resolved(spark, folder)[0], "c_custkey")


@query(f"WITH {_RESOLVED} SELECT c_custkey FROM resolved WHERE NOT known")
def unresolved_requests(spark: SparkSession, folder: str) -> DataFrame:
    return _resolved(spark, folder)[1].select("c_custkey")


def _stored_routes(spark: SparkSession, folder: str) -> DataFrame:
    end = """named_struct('input_address', CAST(NULL AS string), 'formatted_address',
        concat({0}, ' place'), 'latitude', {0} / 4D, 'longitude', -{0} / 4D)"""
    return t.table(spark, folder, "supplier").selectExpr(
        "concat('route-', s_suppkey) AS id",
        "s_name AS name",
        end.format("s_suppkey") + " AS origin",
        end.format("s_nationkey") + " AS destination",
        "'2024-01-01T00:00:00' AS created_at",
        "CASE s_suppkey % 4 WHEN 0 THEN false WHEN 1 THEN true END AS is_active",
    )


_STORED = """SELECT concat('route-', s_suppkey) AS id, s_name AS name, NULL AS o_address,
    concat(s_suppkey, ' place') AS o_formatted, s_suppkey / 4::DOUBLE AS o_latitude,
    NULL AS d_address, concat(s_nationkey, ' place') AS d_formatted,
    -s_nationkey / 4::DOUBLE AS d_longitude FROM supplier"""


@query(f"{_STORED} WHERE s_suppkey % 4 <> 0")
def active_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Stored as lines, read back and reduced to active routes."""
    path = scratch_path(spark, "routes")
    routes.save_routes(_stored_routes(spark, folder), path)
    return _route_columns(routes.load_driving_routes(spark, path, "lines"), "id")


@query("SELECT count(*) AS count FROM supplier WHERE s_suppkey % 4 <> 0")
def active_route_count(spark: SparkSession, folder: str) -> DataFrame:
    return routes.count_routes(_stored_routes(spark, folder))


@query(f"{_STORED} WHERE s_suppkey = 3")
def route_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return _route_columns(routes.find_route(_stored_routes(spark, folder), "route-3"), "id")


@query(
    f"""WITH {_RESOLVED} SELECT {_RESOLVED_COLUMNS}, true AS is_active FROM resolved WHERE known
    UNION ALL SELECT name, o_address, o_formatted, o_latitude, d_address, d_formatted,
    d_longitude, is_active FROM ({_STORED.replace("FROM supplier", '''
    , CASE s_suppkey % 4 WHEN 0 THEN false WHEN 1 THEN true END AS is_active FROM supplier''')})"""
)
def added_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and times of new routes differ from run to run and are left out."""
    grown = routes.add_routes(_stored_routes(spark, folder), _resolved(spark, folder)[0])
    return _route_columns(grown, "is_active")


@query(
    """SELECT concat('route-', s_suppkey) AS id, CASE WHEN s_suppkey IN
        (SELECT p_partkey FROM part WHERE p_size < 10) THEN false
        ELSE CASE s_suppkey % 4 WHEN 0 THEN false WHEN 1 THEN true END END AS is_active
    FROM supplier"""
)
def retired_routes(spark: SparkSession, folder: str) -> DataFrame:
    return _retired(spark, folder)[0].select("id", "is_active")


@query(
    """SELECT concat('route-', p_partkey) AS id FROM part WHERE p_size < 10
    AND p_partkey NOT IN (SELECT s_suppkey FROM supplier)"""
)
def unknown_route_ids(spark: SparkSession, folder: str) -> DataFrame:
    return _retired(spark, folder)[1]


def _retired(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    ids = t.table(spark, folder, "part").filter("p_size < 10")
    wanted = ids.selectExpr("concat('route-', p_partkey) AS id")
    return routes.retire_routes(_stored_routes(spark, folder), wanted)


# --- payloads -------------------------------------------------------------------------


def _through_json(df: DataFrame, schema: str) -> DataFrame:
    """Payload columns written to JSON text and parsed as a landed document would be."""
    parsed = F.from_json(F.to_json(F.struct(*[c for c in df.columns if c != "execution_date"])),
                         schema)
    return df.select("execution_date", parsed.alias("p")).select("execution_date", "p.*")


def _transit_payloads(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """One payload per line item with as many data items as its line number."""
    return _through_json(
        t.table(spark, folder, "lineitem").selectExpr(
            "CAST(CAST(l_shipdate AS date) AS string) AS execution_date",
            """transform(sequence(1, l_linenumber), i -> named_struct(
            'id', concat_ws('-', l_orderkey, l_partkey, l_suppkey, i),
            'attributes', named_struct(
                'arrival_time', CASE WHEN i <> 2 THEN date_format(l_shipdate,
                    "yyyy-MM-dd'T'HH:mm:ss") END,
                'direction_id', i % 2, 'status', l_linestatus, 'drop_off_type', i % 4,
                'stop_sequence', i, 'timepoint', i % 3 = 0),
            'relationships', named_struct(
                'stop', named_struct('data', named_struct('id', CAST(l_suppkey % 10 AS string))),
                'route', named_struct('data', named_struct('id', CAST(i AS string))),
                'trip', named_struct('data', named_struct('id',
                    CASE WHEN i <> 3 THEN concat('T', l_orderkey) END))))) AS data""",
            """transform(array(
                struct(CAST(l_suppkey % 10 AS string) AS id, 'stop' AS type, 'outdated' AS label,
                    0D AS latitude, 0D AS longitude),
                struct(CAST(l_suppkey % 10 AS string) AS id, 'stop' AS type,
                    concat('Stop ', l_suppkey) AS label,
                    CASE WHEN l_suppkey % 4 <> 0 THEN l_suppkey / 16D END AS latitude,
                    l_partkey / 16D AS longitude),
                struct('2' AS id, 'route' AS type, concat('Route ', l_partkey) AS label,
                    0D AS latitude, 0D AS longitude)),
                e -> named_struct('id', e.id, 'type', e.type, 'attributes', named_struct(
                    'name', e.label, 'latitude', e.latitude, 'longitude', e.longitude,
                    'long_name', e.label, 'type', 2))) AS included""",
        ),
        schema,
    )


_ITEMS = """FROM (SELECT *, CAST(unnest(range(1, l_linenumber + 1)) AS INTEGER) AS i
    FROM lineitem)"""
_ITEM_COLUMNS = """concat_ws('-', l_orderkey, l_partkey, l_suppkey, i) AS {id},
    CASE WHEN i <> 2 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS arrival_time,
    CAST(i % 2 AS INTEGER) AS direction_id, CAST(l_suppkey % 10 AS VARCHAR) AS stop_id,
    concat('Stop ', l_suppkey) AS stop_name,
    CASE WHEN l_suppkey % 4 <> 0 THEN l_suppkey / 16::DOUBLE END AS stop_latitude,
    l_partkey / 16::DOUBLE AS stop_longitude, CAST(i AS VARCHAR) AS route_id,
    CASE WHEN i = 2 THEN concat('Route ', l_partkey) END AS route_long_name,
    CASE WHEN i = 2 THEN 2 END AS route_type,
    CASE WHEN i <> 3 THEN concat('T', l_orderkey) END AS trip_id, 'then' AS fetched_at,
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS {day}"""


@query(
    f"""SELECT {_ITEM_COLUMNS.format(id="prediction_id", day="fetched_date")},
    l_linestatus AS status, l_suppkey % 4 <> 0 AS has_cell {_ITEMS}"""
)
def flattened_predictions(spark: SparkSession, folder: str) -> DataFrame:
    documents = _transit_payloads(spark, folder, payloads.PREDICTION_PAYLOAD)
    rows = payloads.flatten_predictions(documents, F.lit("then"))
    return rows.withColumn("has_cell", F.col("stop_h3_index").isNotNull()).drop(
        "departure_time", "schedule_relationship", "stop_h3_index"
    )


@query(
    f"""SELECT {_ITEM_COLUMNS.format(id="schedule_id", day="schedule_date")},
    CAST(i % 4 AS INTEGER) AS drop_off_type, i AS stop_sequence, i % 3 = 0 AS timepoint {_ITEMS}"""
)
def flattened_schedules(spark: SparkSession, folder: str) -> DataFrame:
    documents = _transit_payloads(spark, folder, payloads.SCHEDULE_PAYLOAD)
    rows = payloads.flatten_schedules(documents, F.lit("then"))
    return rows.drop("departure_time", "pickup_type", "stop_h3_index")


@query(
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS observation_date,
    'GHCND:USW00014739' AS station_id, 'Boston Logan Airport' AS station_name, rain + 1 / 16::DOUBLE
        AS precipitation_inches, CAST(NULL AS DOUBLE) AS temp_max_f,
    CASE WHEN o_custkey % 5 = 0 THEN 4.0::DOUBLE END AS temp_min_f, snow AS snow_inches,
    CAST(NULL AS DOUBLE) AS snow_depth_inches, 7.0::DOUBLE AS wind_speed_mph,
    CASE WHEN coalesce(snow, 0) > 0 THEN 'snow' WHEN rain + 1 / 16::DOUBLE > 0.1::DOUBLE
        THEN 'rain' ELSE 'clear' END AS weather_condition, 'then' AS fetched_at
    FROM (SELECT *, (o_custkey % 4) / 8::DOUBLE AS rain, CASE WHEN o_custkey % 3 <> 0
        THEN (o_custkey % 3 - 1)::DOUBLE END AS snow FROM orders)"""
)
def flattened_weather(spark: SparkSession, folder: str) -> DataFrame:
    documents = t.table(spark, folder, "orders").selectExpr(
        "CAST(CAST(o_orderdate AS date) AS string) AS execution_date",
        """array(named_struct('datatype', 'PRCP', 'value', 99D),
        named_struct('datatype', 'PRCP', 'value', o_custkey % 4 / 8D + 1 / 16D),
        named_struct('datatype', 'SNOW', 'value',
            CASE WHEN o_custkey % 3 <> 0 THEN (o_custkey % 3 - 1) / 1D END),
        named_struct('datatype', CASE WHEN o_custkey % 5 = 0 THEN 'TMIN' ELSE 'OTHER' END,
            'value', 4D),
        named_struct('datatype', 'AWND', 'value', 7D)) AS results""",
    )
    parsed = _through_json(documents, payloads.WEATHER_PAYLOAD)
    return payloads.flatten_weather(parsed, F.lit("then"))


def _direction_payloads(spark: SparkSession, folder: str) -> DataFrame:
    return _through_json(
        t.table(spark, folder, "orders").selectExpr(
            "CAST(CAST(o_orderdate AS date) AS string) AS execution_date",
            """named_struct('name', concat('Road ', o_custkey % 20),
            'origin', named_struct('formatted_address', 'here', 'latitude',
                CASE WHEN o_custkey % 6 <> 0 THEN 0D END, 'longitude', o_custkey / 16D),
            'destination', named_struct('formatted_address', 'there', 'latitude', 42D,
                'longitude', -71D)) AS route""",
            """CASE WHEN o_orderkey % 9 <> 0 THEN array(named_struct('legs', array(
                named_struct('distance', named_struct('value', CAST(o_custkey AS int)),
                    'duration', named_struct('value', 600), 'duration_in_traffic',
                    CASE WHEN o_orderkey % 5 <> 0
                        THEN named_struct('value', CAST(o_orderkey % 900 AS int)) END),
                named_struct('distance', named_struct('value', -1), 'duration',
                    named_struct('value', -1), 'duration_in_traffic',
                    named_struct('value', -1))))) ELSE array() END AS result""",
        ),
        payloads.DIRECTIONS_PAYLOAD,
    )


@query(
    """SELECT concat('Road ', o_custkey % 20) AS route_name, 'here' AS origin_address,
    0::DOUBLE AS origin_latitude, o_custkey / 16::DOUBLE AS origin_longitude,
    'there' AS destination_address, 42::DOUBLE AS destination_latitude,
    -71::DOUBLE AS destination_longitude, CAST(o_custkey AS INTEGER) AS distance_meters,
    600 AS duration_seconds,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 900 AS INTEGER) END
        AS duration_in_traffic_seconds,
    strftime(o_orderdate, '%Y-%m-%dT08:00:00') AS departure_time,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fetched_date, 'then' AS fetched_at
    FROM orders WHERE o_custkey % 6 <> 0 AND o_orderkey % 9 <> 0"""
)
def flattened_directions(spark: SparkSession, folder: str) -> DataFrame:
    rows = payloads.flatten_directions(_direction_payloads(spark, folder), F.lit("then"))
    return rows.drop("origin_h3_index", "destination_h3_index")


@query(
    """SELECT concat('Road ', o_custkey % 20) AS route_name, count(*) AS skipped FROM orders
    WHERE o_custkey % 6 = 0 GROUP BY 1"""
)
def skipped_routes(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.skipped_for_coordinates(_direction_payloads(spark, folder))


# --- files, tables and streams ----------------------------------------------------------


def _land(spark: SparkSession, feed: feeds.Feed, rows: DataFrame) -> str:
    landing = scratch_path(spark, "landing")
    sink.land(t.as_landed(rows, feed), landing, feed.folder, "2024-01-01")
    return landing


def _raw(spark: SparkSession, feed: feeds.Feed, rows: DataFrame) -> DataFrame:
    landing = _land(spark, feed, rows)
    return files.raw_batch(spark, feed, landing).drop("_ingested_at")


def _raw_streamed(spark: SparkSession, feed: feeds.Feed, rows: DataFrame) -> DataFrame:
    landing = _land(spark, feed, rows)
    store = streams.Store(scratch_path(spark, "store"))
    streams.finish(streams.append_raw(spark, feed, landing, store), feed.table)
    return files.snapshot(spark, store.table(feed.table)).drop("_ingested_at")


_LOCATED = """stop_id stop_name stop_latitude stop_longitude stop_h3_index route_id
    route_long_name route_type trip_id"""
_RAW_PREDICTIONS = t.with_tables(
    "SELECT "
    + t.shown_sql(
        f"""prediction_id arrival_time:t departure_time:t direction_id schedule_relationship
        status {_LOCATED} fetched_at:t fetched_date:d"""
    )
    + " FROM predictions",
    "predictions",
)
_RAW_SCHEDULES = t.with_tables(
    "SELECT "
    + t.shown_sql(
        f"""schedule_id arrival_time:t departure_time:t direction_id drop_off_type pickup_type
        stop_sequence timepoint {_LOCATED} schedule_date:d fetched_at:t"""
    )
    + " FROM schedules",
    "schedules",
)
_RAW_WEATHER = t.with_tables(
    f"SELECT {t.shown_sql(_WEATHER_SHOWN)}, '2024-01-01 00:00:00' AS fetched_at FROM weather",
    "weather",
)
_RAW_DRIVING = t.with_tables(
    "SELECT "
    + t.shown_sql(
        """route_name origin_address origin_latitude origin_longitude origin_h3_index
        destination_address destination_latitude destination_longitude destination_h3_index
        distance_meters duration_seconds duration_in_traffic_seconds departure_time:t
        fetched_date:d fetched_at:t"""
    )
    + " FROM driving",
    "driving",
)


def _weather_rows(spark: SparkSession, folder: str) -> DataFrame:
    return t.weather(spark, folder).withColumn("fetched_at", F.timestamp_seconds(F.lit(t.START)))


@query(_RAW_PREDICTIONS)
def raw_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, feeds.PREDICTIONS, t.predictions(spark, folder))


@query(_RAW_SCHEDULES)
def raw_schedules(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, feeds.SCHEDULES, t.schedules(spark, folder))


@query(_RAW_WEATHER)
def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, feeds.WEATHER, _weather_rows(spark, folder))


@query(_RAW_DRIVING)
def raw_driving(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, feeds.DRIVING, t.driving(spark, folder))


@query(_RAW_PREDICTIONS)
def raw_predictions_streamed(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_streamed(spark, feeds.PREDICTIONS, t.predictions(spark, folder))


@query(_RAW_SCHEDULES)
def raw_schedules_streamed(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_streamed(spark, feeds.SCHEDULES, t.schedules(spark, folder))


@query(_RAW_WEATHER)
def raw_weather_streamed(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_streamed(spark, feeds.WEATHER, _weather_rows(spark, folder))


@query(_RAW_DRIVING)
def raw_driving_streamed(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_streamed(spark, feeds.DRIVING, t.driving(spark, folder))


@query(f"SELECT event_id, {t.strata_sql('ts', 'ts')} FROM events")
def strata_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """New rows of a stored table, enriched without state."""
    schema = t.table(spark, folder, "events").schema
    # the pattern matches the table both as one file and as a folder of files
    arriving = files.increments(spark, f"{folder}/events.parquet*", schema)
    hour = F.hour("ts")
    rows = arriving.select(
        "event_id",
        hour.alias("hour"),
        clock.hour_bucket(hour).alias("hour_bucket"),
        clock.day_type(F.col("ts")).alias("day_type"),
    )
    store = streams.Store(scratch_path(spark, "store"))
    streams.finish(streams.append_dataset(rows, store, "strata", ()))
    return files.snapshot(spark, store.table("strata"))


def _written(spark: SparkSession, rows: DataFrame, *partition_by: str) -> str:
    return sink.write_table(rows, scratch_path(spark, "table"), partition_by)


@query(_TRANSIT_SQL)
def transit_performance_streamed(spark: SparkSession, folder: str) -> DataFrame:
    store = streams.Store(scratch_path(spark, "store"))
    # not partitioned, so that rows are written where they are read
    predictions = _written(spark, t.predictions(spark, folder))
    schedules = files.snapshot(spark, _written(spark, t.schedules(spark, folder)))
    known = t.known_weather(spark, folder)
    streams.finish(streams.append_transit(spark, store, predictions, schedules, known))
    return files.snapshot(spark, store.table(staging.TRANSIT_TABLE))


@query(_DRIVEN_SQL)
def driving_performance_streamed(spark: SparkSession, folder: str) -> DataFrame:
    store = streams.Store(scratch_path(spark, "store"))
    driving = _written(spark, t.driving(spark, folder), "fetched_date")
    known = t.known_weather(spark, folder)
    streams.finish(streams.append_driving(spark, store, driving, known))
    return files.snapshot(spark, store.table(staging.DRIVING_TABLE)).drop("driving_id")


@query(
    t.with_tables(
        """SELECT stop_h3_index, route_id, CAST(fetched_date AS VARCHAR) AS fetched_date,
        count(*) AS n FROM predictions GROUP BY ALL""",
        "predictions",
    )
)
def clustered_table(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned and clustered table, written and read back."""
    path = sink.write_table(
        t.predictions(spark, folder),
        scratch_path(spark, "table"),
        feeds.PREDICTIONS.partition_by,
        feeds.PREDICTIONS.cluster_by,
    )
    stored = files.snapshot(spark, path)
    return stored.groupBy("stop_h3_index", "route_id", "fetched_date").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    """WITH older AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
        WHERE c_mktsegment <> 'BUILDING'),
    newer AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL
        ELSE c_nationkey END AS c_nationkey, c_acctbal FROM customer
        WHERE c_mktsegment <> 'MACHINERY'),
    pairs AS (SELECT o.c_custkey AS ok, n.c_custkey AS nk, o, n FROM older o
        FULL JOIN newer n ON o.c_custkey = n.c_custkey
        WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL
            OR o.c_nationkey IS DISTINCT FROM n.c_nationkey)
    SELECT n.c_custkey AS c_custkey, n.c_name AS c_name, n.c_nationkey AS c_nationkey,
        n.c_acctbal AS c_acctbal,
        CASE WHEN ok IS NULL THEN 'insert' ELSE 'update_postimage' END AS _change_type
        FROM pairs WHERE nk IS NOT NULL
    UNION ALL SELECT o.c_custkey, o.c_name, o.c_nationkey, o.c_acctbal,
        CASE WHEN nk IS NULL THEN 'delete' ELSE 'update_preimage' END
        FROM pairs WHERE ok IS NOT NULL"""
)
def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    customers = t.table(spark, folder, "customer")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    moved = first_match([(F.col("c_acctbal") < 0, F.lit(None).cast("int"))], F.col("c_nationkey"))
    older = customers.filter("c_mktsegment <> 'BUILDING'").select(*columns)
    newer = customers.filter("c_mktsegment <> 'MACHINERY'").withColumn("c_nationkey", moved)
    return changes.change_feed(older, newer.select(*columns), ["c_custkey"])


# --- reports and the daily run ------------------------------------------------------------

_DAY = "2024-01-10"


@query(
    t.with_tables(
        f"""SELECT 'bronze_mbta_predictions' AS table_name, count(*) AS row_count,
            CAST(NULL AS DOUBLE) AS avg_score,
            CASE WHEN count(*) = 0 THEN 'no predictions for the day' END AS warning
            FROM predictions WHERE fetched_date = DATE '{_DAY}'
        UNION ALL SELECT 'stg_mbta_performance', count(*), NULL, NULL FROM transit
            WHERE schedule_date = DATE '{_DAY}'
        UNION ALL SELECT 'fct_mbta_route_reliability', count(*), round(avg(reliability_score), 6),
            CASE WHEN count(*) < 10 THEN 'few reliability records' END FROM transit_fact""",
        "transit_fact",
    )
)
def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.validation_report(
        t.predictions(spark, folder),
        t.transit(spark, folder),
        _transit_fact(spark, folder),
        _DAY,
    )


def _landing_jobs(spark: SparkSession, folder: str, reported_only: bool = False) -> dict:
    def weather_rows() -> DataFrame:
        rows = _weather_rows(spark, folder)
        return t.reported(rows) if reported_only else rows

    rows = {
        "mbta_predictions": lambda: t.predictions(spark, folder),
        "mbta_schedules": lambda: t.schedules(spark, folder),
        "noaa": weather_rows,
        "driving": lambda: t.driving(spark, folder),
    }
    return {
        source: (
            feeds.FEEDS[source].folder,
            lambda source=source: t.as_landed(rows[source](), feeds.FEEDS[source]),
        )
        for source in rows
    }


@query(
    t.with_tables(
        """SELECT 'mbta_predictions' AS source, count(*) AS records, true AS landed
            FROM predictions
        UNION ALL SELECT 'mbta_schedules', count(*), true FROM schedules
        UNION ALL SELECT 'noaa', count(*), true FROM weather
        UNION ALL SELECT 'driving', count(*), true FROM driving""",
        "predictions",
        "schedules",
        "weather",
        "driving",
    )
)
def landing_report(spark: SparkSession, folder: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    report = reports.land_sources(spark, _landing_jobs(spark, folder), landing, _DAY)
    return report.select("source", "records", F.col("path").isNotNull().alias("landed"))


@query(_COMPARISON_SQL)
def daily_run(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files through every table; the comparison is read by its name."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "root")
    reports.land_sources(spark, _landing_jobs(spark, folder, reported_only=True), landing, _DAY)
    daily.run_daily(spark, landing, root, _DAY)
    return spark.sql(f"SELECT * FROM {comparison.COMPARISON_TABLE}")


def _payload_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """The trial tables as payload files: a document per day and 10,000 orders, one damaged."""
    root = scratch_path(spark, "payloads")
    day = {"mbta_predictions": "fetched_date", "mbta_schedules": "schedule_date"}
    own = {
        "mbta_predictions": """arrival_time, departure_time, direction_id, schedule_relationship, status""",
        "mbta_schedules": """arrival_time, departure_time, direction_id, drop_off_type, pickup_type,
            stop_sequence, timepoint""",
    }
    rows = {"mbta_predictions": t.predictions, "mbta_schedules": t.schedules}
    for source, make in rows.items():
        feed = feeds.FEEDS[source]
        key = feed.schema.split()[0]
        link = "named_struct('data', named_struct('id', {}))"
        items = t.as_landed(make(spark, folder), feed).selectExpr(
            f"{day[source]} AS day",
            "CAST(substring(trip_id, 2) AS bigint) div 10000 AS slice",
            f"""named_struct('id', {key}, 'attributes', struct({own[source]}), 'relationships',
            named_struct('stop', {link.format("stop_id")}, 'route', {link.format("route_id")},
                'trip', {link.format("trip_id")})) AS item""",
            """array(named_struct('id', stop_id, 'type', 'stop', 'attributes', named_struct('name', stop_name,
                'latitude', stop_latitude, 'longitude', stop_longitude, 'long_name', null, 'type', null)),
            named_struct('id', route_id, 'type', 'route', 'attributes', named_struct('name', null,
                'latitude', null, 'longitude', null, 'long_name', route_long_name, 'type', route_type)))
            AS entities""",
        )
        documents = items.groupBy("day", "slice").agg(
            F.collect_list("item").alias("data"),
            F.array_distinct(F.flatten(F.collect_set("entities"))).alias("included"),
        )
        _write_documents(documents.select("day", F.struct("data", "included").alias("doc")), f"{root}/{source}")
    broken = spark.range(1).select(F.lit('{"data": [{"id": "p').alias("value"))
    broken.write.mode("append").text(f"{root}/mbta_predictions/day=2024-01-05")
    measured = t.reported(t.weather(spark, folder)).selectExpr(
        "CAST(observation_date AS string) AS day",
        "struct(array({}) AS results) AS doc".format(
            ", ".join(
                f"struct('{code}' AS datatype, {column} AS value)"
                for code, column in observations.MEASURES.items()
            )
        ),
    )
    _write_documents(measured, f"{root}/noaa")
    ends = ", ".join(
        f"""named_struct('formatted_address', {side}_address, 'latitude', {side}_latitude,
            'longitude', {side}_longitude) AS {side}"""
        for side in ("origin", "destination")
    )
    legs = ", ".join(
        f"named_struct('value', {column}) AS {name}"
        for name, column in (
            ("distance", "distance_meters"),
            ("duration", "duration_seconds"),
            ("duration_in_traffic", "duration_in_traffic_seconds"),
        )
    )
    driven = t.as_landed(t.driving(spark, folder), feeds.DRIVING).selectExpr(
        "fetched_date AS day",
        f"struct(struct(route_name AS name, {ends}) AS route, array(struct(array(struct({legs})) AS legs)) AS result) AS doc",
    )
    _write_documents(driven, f"{root}/driving", per_file=None)
    return {source: f"{root}/{source}" for source in feeds.FEEDS}


def _write_documents(rows: DataFrame, path: str, per_file: int | None = 1) -> None:
    texts = rows.select("day", F.to_json("doc").alias("value")).repartition("day")
    writer = texts.write.partitionBy("day").option("compression", "gzip")
    (writer if per_file is None else writer.option("maxRecordsPerFile", per_file)).text(path)


@query(
    t.with_tables(
        """SELECT 'transit' AS mode, route_id AS route, hour_bucket, day_type, weather_condition,
            count(*) AS trips, CAST(sum(delay_seconds) AS BIGINT) AS seconds FROM transit GROUP BY ALL
        UNION ALL SELECT 'driving', route_name, 'AM_PEAK', day_type, weather_condition, count(*),
            CAST(sum(duration_in_traffic_seconds) AS BIGINT) FROM driven
            WHERE duration_in_traffic_seconds IS NOT NULL AND route_name <> 'Road 2' GROUP BY ALL
        UNION ALL SELECT 'set aside', 'mbta_predictions', NULL, NULL, NULL, 1, NULL""",
        "transit",
        "driven",
    )
)
def daily_run_from_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payload files through landing and every table; a damaged file is reported, others land."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "root")
    names = t.driving(spark, folder).select(F.col("route_name").alias("name")).distinct()
    known = names.withColumn("is_active", F.col("name") != "Road 2")
    jobs = payload_landing.payload_jobs(routes.list_routes(known), driving_lines=True)
    report, _ = payload_landing.run_daily_from_payloads(
        spark, _payload_files(spark, folder), landing, root, _DAY, jobs
    )

    def totals(mode: str, table: str, route: str, measure: str) -> DataFrame:
        rows = spark.table(table).groupBy(
            F.lit(mode).alias("mode"), F.col(route).alias("route"), "hour_bucket", "day_type", "weather_condition"
        )
        return rows.agg(F.count(F.lit(1)).alias("trips"), F.sum(measure).alias("seconds"))

    none = F.lit(None).cast("string")
    aside = report.filter("damaged > 0 OR error IS NOT NULL").select(
        F.lit("set aside").alias("mode"),
        F.col("source").alias("route"),
        *(none.alias(c) for c in ("hour_bucket", "day_type", "weather_condition")),
        F.col("damaged").alias("trips"),
        F.lit(None).cast("long").alias("seconds"),
    )
    return (
        totals("transit", staging.TRANSIT_TABLE, "route_id", "delay_seconds")
        .unionByName(totals("driving", staging.DRIVING_TABLE, "route_name", "duration_in_traffic_seconds"))
        .unionByName(aside)
    )


@query(
    t.with_tables(
        """SELECT 'bronze_mbta_predictions' AS name, count(*) AS n FROM predictions
        UNION ALL SELECT 'stg_mbta_performance', count(*) FROM transit
        UNION ALL SELECT 'fct_mbta_route_reliability', count(*) FROM transit_fact
        UNION ALL SELECT 'bronze_driving_routes', 0 UNION ALL SELECT 'stg_driving_performance', 0
        UNION ALL SELECT 'fct_driving_route_reliability', 0""",
        "transit_fact",
    )
)
def daily_run_without_driving(spark: SparkSession, folder: str) -> DataFrame:
    """A feed that has landed nothing gives tables without rows, and the others are complete."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "root")
    jobs = _landing_jobs(spark, folder, reported_only=True)
    reports.land_sources(spark, {k: v for k, v in jobs.items() if k != "driving"}, landing, _DAY)
    daily.run_daily(spark, landing, root, _DAY)
    return _sizes(
        spark,
        *("bronze_mbta_predictions", "stg_mbta_performance", "fct_mbta_route_reliability"),
        *("bronze_driving_routes", "stg_driving_performance", "fct_driving_route_reliability"),
    )


@query(
    t.with_tables(
        """SELECT 'bronze_mbta_predictions' AS name, count(*) AS n FROM predictions
        UNION ALL SELECT 'bronze_mbta_schedules', count(*) FROM schedules
        UNION ALL SELECT 'stg_mbta_performance', 0
        UNION ALL SELECT 'stg_driving_performance', count(*) FROM driven
            WHERE duration_in_traffic_seconds IS NOT NULL""",
        "predictions",
        "schedules",
        "driven",
    )
)
def daily_run_without_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Trips that no schedule has give staging tables and facts without rows."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "root")
    jobs = _landing_jobs(spark, folder, reported_only=True)
    place, rows = jobs["mbta_schedules"]
    other = F.concat(F.lit("other "), "trip_id")
    jobs["mbta_schedules"] = place, lambda: rows().withColumn("trip_id", other)
    reports.land_sources(spark, jobs, landing, _DAY)
    daily.run_daily(spark, landing, root, _DAY)
    return _sizes(
        spark,
        *("bronze_mbta_predictions", "bronze_mbta_schedules", "stg_mbta_performance"),
        "stg_driving_performance",
    )


def _run_with_late_weather(spark: SparkSession, folder: str) -> None:
    """Two maintained runs; weather from the 21st of a month on lands with the second alone."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "root")
    jobs = _landing_jobs(spark, folder, reported_only=True)
    place, rows = jobs["noaa"]
    is_late = F.dayofmonth(F.col("observation_date").cast("date")) > 20
    early = {"noaa": (place, lambda: rows().filter(~is_late))}
    late = {"noaa": (place, lambda: rows().filter(is_late))}
    reports.land_sources(spark, {**jobs, **early}, landing, _DAY)
    daily.run_daily(spark, landing, root, _DAY, maintained=True)
    reports.land_sources(spark, late, landing, "2024-01-11")
    daily.run_daily(spark, landing, root, _DAY, maintained=True)


@query(_TRANSIT_SQL)
def transit_performance_late_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Trips appended before their weather was known, read by name from the maintained table."""
    _run_with_late_weather(spark, folder)
    return spark.table(staging.TRANSIT_TABLE)


@query(_impact_sql(_LAGGED))
def daily_run_late_weather(spark: SparkSession, folder: str) -> DataFrame:
    """The effect of weather as a run writes it whose weather came in two parts."""
    _run_with_late_weather(spark, folder)
    return spark.table(comparison.IMPACT_TABLE)


def _sizes(spark: SparkSession, *names: str) -> DataFrame:
    counts = [
        spark.table(n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in names
    ]
    return functools.reduce(DataFrame.unionByName, counts)


_RUN_RULES = {
    feeds.PREDICTIONS.table: ("predictions", feeds.PREDICTIONS.expectations),
    feeds.SCHEDULES.table: ("schedules", feeds.SCHEDULES.expectations),
    feeds.WEATHER.table: ("known_weather", feeds.WEATHER.expectations),
    feeds.DRIVING.table: ("driving", feeds.DRIVING.expectations),
    staging.WEATHER_TABLE: ("known_weather", staging.WEATHER_RULES),
    staging.TRANSIT_TABLE: ("transit", staging.TRANSIT_RULES),
    staging.DRIVING_TABLE: ("driven", staging.DRIVING_RULES),
    reliability.TRANSIT.table: ("transit_fact", reliability.TRANSIT.expectations()),
    reliability.DRIVING.table: ("driving_fact", reliability.DRIVING.expectations()),
}


@query(
    t.with_tables(
        " UNION ALL ".join(
            f"""SELECT '{stored_as}' AS dataset, '{rule.name}' AS expectation,
            '{rule.action}' AS action, count(*) AS total_rows,
            count(*) FILTER (WHERE NOT coalesce({rule.predicate}, false)) AS failed_rows
            FROM {name}"""
            for stored_as, (name, rules) in _RUN_RULES.items()
            for rule in rules
        ),
        "transit_fact",
        "driving_fact",
    )
)
def daily_run_expectations(spark: SparkSession, folder: str) -> DataFrame:
    """Every rule of a run, counted in its streams or over its stored tables."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "root")
    reports.land_sources(spark, _landing_jobs(spark, folder, reported_only=True), landing, _DAY)
    return daily.run_daily(spark, landing, root, _DAY).expectations


@query(
    t.with_tables(
        "SELECT observation_date::VARCHAR AS observation_date FROM weather UNION ALL "
        "SELECT observation_date::VARCHAR FROM weather",
        "weather",
    )
)
def late_files_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Files that are much older than those read before come in with a second run."""
    landing, late = scratch_path(spark, "landing"), scratch_path(spark, "late")
    store = streams.Store(scratch_path(spark, "store"))
    rows = t.as_landed(_weather_rows(spark, folder), feeds.WEATHER)
    sink.land(rows, landing, feeds.WEATHER.folder, _DAY)
    streams.finish(streams.append_raw(spark, feeds.WEATHER, landing, store))
    sink.land(rows, late, feeds.WEATHER.folder, "2023-12-01")
    _move_back_in_time(spark, f"{late}/{feeds.WEATHER.folder}/2023-12-01", landing)
    streams.finish(streams.append_raw(spark, feeds.WEATHER, landing, store))
    return files.snapshot(spark, store.table(feeds.WEATHER.table)).select("observation_date")


def _move_back_in_time(spark: SparkSession, source: str, landing: str, days: int = 30) -> None:
    """Set the times of landed files back, then put them where the feed is read."""
    paths = spark._jvm.org.apache.hadoop.fs
    path = paths.Path(source)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(path):
        moment = status.getModificationTime() - days * 86_400_000
        store.setTimes(status.getPath(), moment, -1)
    target = paths.Path(f"{landing}/{feeds.WEATHER.folder}/{path.getName()}")
    store.rename(path, target)


# --- operators for training data, where their subpackage is there ---------------------------

try:
    import corpus_pipeline
    from headway.llm import queries as _llm
except ImportError as missing:
    if missing.name not in ("corpus_pipeline", "headway.llm", "headway.llm.queries"):
        raise
    LLM_QUERIES: tuple[str, ...] = ()
else:
    for _name, _run in {**_llm.QUERIES, "pipeline": corpus_pipeline.run}.items():
        _QUERIES[_name] = lambda spark, folder, _run=_run: _run(tune(spark), folder)
    _SQL.update(_llm.SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        _SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
    LLM_QUERIES = (*_llm.QUERIES, "pipeline")
