"""The given tables in the shape of the raw feeds, in Spark and in SQL.

Each Spark function has a SQL twin of the same name in ``SQL``; both are plain
arithmetic on the given columns, so results can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.feeds import Feed
from headway.operators.observations import pivot_observations, with_condition
from headway.plans import staging
from headway.session import stored

START = 1704067200  # 2024-01-01 00:00:00 UTC
SPAN = 40 * 86400  # the schedule runs longer than the weather is known
STATION = "station-1"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, spread over the cores when it has fewer parts than cores.

    A table of many files already has more parts and is left as it is.
    """
    given = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return given if given.rdd.getNumPartitions() >= cores else given.repartition(cores)


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Times as text and rounded doubles, so that two engines agree on the value."""

    def shown(name: str, kind: str) -> Column:
        if kind.startswith("timestamp"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        if kind == "date":
            return F.col(name).cast("string")
        return F.round(name, digits).alias(name) if kind == "double" else F.col(name)

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    stop = "l_orderkey % 12"
    noise = "(l_partkey * 7 + l_suppkey * 13 + l_linenumber * 31) % 1000"
    planned = f"{START} + (l_orderkey * 977) % {SPAN}"
    arrival = f"{planned} + ({noise}) * ({stop} + 1) div 12 - 40"
    return table(spark, folder, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS prediction_id",
        f"CASE WHEN l_partkey % 50 <> 0 THEN timestamp_seconds({arrival}) END AS arrival_time",
        f"timestamp_seconds({arrival} + 30) AS departure_time",
        "CAST(l_linenumber % 2 AS int) AS direction_id",
        "l_linestatus AS schedule_relationship",
        "l_returnflag AS status",
        f"concat('S', {stop}) AS stop_id",
        f"concat('Stop ', {stop}) AS stop_name",
        f"CAST(42 + ({stop}) / 16D AS double) AS stop_latitude",
        f"CAST(-71 - ({stop}) / 16D AS double) AS stop_longitude",
        f"CASE WHEN {stop} <> 11 THEN concat('C', ({stop}) div 2) END AS stop_h3_index",
        "concat('R', l_suppkey % 3) AS route_id",
        "concat('Route ', l_suppkey % 3) AS route_long_name",
        "CAST(l_suppkey % 3 AS int) AS route_type",
        "concat('T', l_orderkey) AS trip_id",
        f"timestamp_seconds({planned} - 600 - l_linenumber) AS fetched_at",
        f"CAST(timestamp_seconds({planned} - 600) AS date) AS fetched_date",
    )


def schedules(spark: SparkSession, folder: str) -> DataFrame:
    stop = "o_orderkey % 12"
    planned = f"{START} + (o_orderkey * 977) % {SPAN}"
    return table(spark, folder, "orders").selectExpr(
        "concat('P', o_orderkey) AS schedule_id",
        f"CASE WHEN o_orderkey % 101 <> 0 THEN timestamp_seconds({planned}) END AS arrival_time",
        f"timestamp_seconds({planned} + 30) AS departure_time",
        "CAST(o_orderkey % 2 AS int) AS direction_id",
        "CAST(o_custkey % 4 AS int) AS drop_off_type",
        "CAST(o_custkey % 3 AS int) AS pickup_type",
        f"CAST({stop} AS int) AS stop_sequence",
        "o_custkey % 2 = 0 AS timepoint",
        f"concat('S', {stop}) AS stop_id",
        f"concat('Stop ', {stop}) AS stop_name",
        f"CAST(42 + ({stop}) / 16D AS double) AS stop_latitude",
        f"CAST(-71 - ({stop}) / 16D AS double) AS stop_longitude",
        f"CASE WHEN {stop} <> 11 THEN concat('C', ({stop}) div 2) END AS stop_h3_index",
        "concat('R', o_custkey % 3) AS route_id",
        "concat('Route ', o_custkey % 3) AS route_long_name",
        "CAST(o_custkey % 3 AS int) AS route_type",
        "concat('T', o_orderkey) AS trip_id",
        f"CAST(timestamp_seconds({planned}) AS date) AS schedule_date",
        f"timestamp_seconds({planned} - 3600) AS fetched_at",
    )


def driving(spark: SparkSession, folder: str) -> DataFrame:
    baseline = (
        "CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 89 <> 0"
        " THEN 600 + (user_id % 15) * 4 END"
    )
    jam = "((event_id * 13 + user_id) % 500) * (user_id % 5 + 1) div 5"
    return (
        table(spark, folder, "events")
        .withColumn("at", F.col("ts").cast("timestamp"))
        .selectExpr(
            "concat('Road ', user_id % 3) AS route_name",
            "concat('Home ', user_id % 6) AS origin_address",
            "CAST(42 + (user_id % 6) / 8D AS double) AS origin_latitude",
            "CAST(-71 - (user_id % 6) / 8D AS double) AS origin_longitude",
            "CASE WHEN user_id % 6 <> 5 THEN concat('C', user_id % 6) END AS origin_h3_index",
            "concat('Work ', user_id div 6 % 2) AS destination_address",
            "CAST(43 + (user_id div 6 % 2) / 8D AS double) AS destination_latitude",
            "CAST(-72 - (user_id div 6 % 2) / 8D AS double) AS destination_longitude",
            "concat('D', user_id div 6 % 2) AS destination_h3_index",
            "CAST(5000 + user_id AS int) AS distance_meters",
            f"CAST({baseline} AS int) AS duration_seconds",
            "CASE WHEN event_id % 53 <> 0 THEN"
            f" CAST(600 + (user_id % 15) * 4 + {jam} AS int) END AS duration_in_traffic_seconds",
            "at AS departure_time",
            "CAST(at AS date) AS fetched_date",
            "timestamp_seconds(unix_timestamp(at) + 3600) AS fetched_at",
        )
    )


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Long-form station readings."""
    codes = "array('PRCP', 'TMAX', 'TMIN', 'SNOW', 'SNWD', 'AWND', 'WSF2')"
    code = f"{codes}[event_id % 7]"
    k = "(event_id * 5 + user_id)"
    return (
        table(spark, folder, "events")
        .selectExpr(
            "CAST(ts AS date) AS observation_date",
            "event_id AS pos",
            f"{code} AS datatype",
            f"""CASE {code} WHEN 'PRCP' THEN greatest(0, {k} % 10 - 5) / 8D
            WHEN 'SNOW' THEN greatest(0, {k} % 12 - 8) / 1D
            WHEN 'TMAX' THEN (10 + {k} % 95) / 1D WHEN 'TMIN' THEN {k} % 60 / 1D
            WHEN 'SNWD' THEN {k} % 5 / 1D ELSE {k} % 40 / 1D END AS value""",
        )
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    wide = pivot_observations(observations(spark, folder), ["observation_date"])
    return with_condition(wide).withColumns(
        {"station_id": F.lit(STATION), "station_name": F.concat(F.lit("at "), F.lit(STATION))}
    )


def weather_daily(spark: SparkSession, folder: str) -> DataFrame:
    return staging.weather_daily(weather(spark, folder))


def reported(weather_rows: DataFrame) -> DataFrame:
    """Without Wednesdays, of which nothing is known when trips are joined to their weather."""
    return weather_rows.filter("dayofweek(observation_date) <> 4")


def known_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Daily weather as a stored result, which joins may then size up cheaply."""
    return stored(reported(weather_daily(spark, folder)), "weather")


def transit(
    spark: SparkSession, folder: str, known: DataFrame | None = None, **options: object
) -> DataFrame:
    return staging.transit_performance(
        predictions(spark, folder),
        schedules(spark, folder),
        known_weather(spark, folder) if known is None else known,
        **options,
    )


def driven(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    known = known_weather(spark, folder) if known is None else known
    return staging.driving_performance(driving(spark, folder), known)


def as_landed(df: DataFrame, feed: Feed) -> DataFrame:
    """Typed rows back to the text times that feed files hold."""
    times = {name: F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss") for name in feed.timestamps}
    days = {name: F.col(name).cast("string") for name in feed.dates}
    return df.withColumns({**times, **days})


_LOCATED = """
    concat('S', {k} % 12) AS stop_id, concat('Stop ', {k} % 12) AS stop_name,
    42 + ({k} % 12) / 16::DOUBLE AS stop_latitude, -71 - ({k} % 12) / 16::DOUBLE AS stop_longitude,
    CASE WHEN {k} % 12 <> 11 THEN concat('C', ({k} % 12) // 2) END AS stop_h3_index,
    concat('R', {r} % 3) AS route_id, concat('Route ', {r} % 3) AS route_long_name,
    CAST({r} % 3 AS INTEGER) AS route_type, concat('T', {k}) AS trip_id
"""


def _moment(seconds: str) -> str:
    return f"make_timestamp(({seconds}) * 1000000)"


_PLANNED_L = f"{START} + (l_orderkey * 977) % {SPAN}"
_PLANNED_O = f"{START} + (o_orderkey * 977) % {SPAN}"
_ARRIVAL = (
    f"{_PLANNED_L} + ((l_partkey * 7 + l_suppkey * 13 + l_linenumber * 31) % 1000)"
    " * (l_orderkey % 12 + 1) // 12 - 40"
)

SQL = {
    "predictions": f"""SELECT
        concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS prediction_id,
        CASE WHEN l_partkey % 50 <> 0 THEN {_moment(_ARRIVAL)} END AS arrival_time,
        {_moment(_ARRIVAL + " + 30")} AS departure_time,
        CAST(l_linenumber % 2 AS INTEGER) AS direction_id,
        l_linestatus AS schedule_relationship, l_returnflag AS status,
        {_LOCATED.format(k="l_orderkey", r="l_suppkey")},
        {_moment(_PLANNED_L + " - 600 - l_linenumber")} AS fetched_at,
        CAST({_moment(_PLANNED_L + " - 600")} AS DATE) AS fetched_date
        FROM lineitem""",
    "schedules": f"""SELECT concat('P', o_orderkey) AS schedule_id,
        CASE WHEN o_orderkey % 101 <> 0 THEN {_moment(_PLANNED_O)} END AS arrival_time,
        {_moment(_PLANNED_O + " + 30")} AS departure_time,
        CAST(o_orderkey % 2 AS INTEGER) AS direction_id,
        CAST(o_custkey % 4 AS INTEGER) AS drop_off_type,
        CAST(o_custkey % 3 AS INTEGER) AS pickup_type,
        CAST(o_orderkey % 12 AS INTEGER) AS stop_sequence, o_custkey % 2 = 0 AS timepoint,
        {_LOCATED.format(k="o_orderkey", r="o_custkey")},
        CAST({_moment(_PLANNED_O)} AS DATE) AS schedule_date,
        {_moment(_PLANNED_O + " - 3600")} AS fetched_at
        FROM orders""",
    "driving": """SELECT concat('Road ', user_id % 3) AS route_name,
        concat('Home ', user_id % 6) AS origin_address,
        42 + (user_id % 6) / 8::DOUBLE AS origin_latitude,
        -71 - (user_id % 6) / 8::DOUBLE AS origin_longitude,
        CASE WHEN user_id % 6 <> 5 THEN concat('C', user_id % 6) END AS origin_h3_index,
        concat('Work ', user_id // 6 % 2) AS destination_address,
        43 + (user_id // 6 % 2) / 8::DOUBLE AS destination_latitude,
        -72 - (user_id // 6 % 2) / 8::DOUBLE AS destination_longitude,
        concat('D', user_id // 6 % 2) AS destination_h3_index,
        CAST(5000 + user_id AS INTEGER) AS distance_meters,
        CAST(CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 89 <> 0
            THEN 600 + (user_id % 15) * 4 END AS INTEGER) AS duration_seconds,
        CASE WHEN event_id % 53 <> 0 THEN CAST(600 + (user_id % 15) * 4
            + ((event_id * 13 + user_id) % 500) * (user_id % 5 + 1) // 5 AS INTEGER) END
            AS duration_in_traffic_seconds,
        ts AS departure_time, CAST(ts AS DATE) AS fetched_date,
        date_trunc('second', ts) + INTERVAL 1 HOUR AS fetched_at
        FROM events""",
    "observations": """SELECT CAST(ts AS DATE) AS observation_date, event_id AS pos, datatype,
        CASE datatype WHEN 'PRCP' THEN greatest(0, k % 10 - 5) / 8::DOUBLE
            WHEN 'SNOW' THEN greatest(0, k % 12 - 8)::DOUBLE
            WHEN 'TMAX' THEN (10 + k % 95)::DOUBLE WHEN 'TMIN' THEN (k % 60)::DOUBLE
            WHEN 'SNWD' THEN (k % 5)::DOUBLE ELSE (k % 40)::DOUBLE END AS value
        FROM (SELECT *, event_id * 5 + user_id AS k,
            (['PRCP', 'TMAX', 'TMIN', 'SNOW', 'SNWD', 'AWND', 'WSF2'])[event_id % 7 + 1]
            AS datatype FROM events)""",
    "weather": f"""SELECT *, CASE WHEN coalesce(snow_inches, 0) > 0 THEN 'snow'
            WHEN coalesce(precipitation_inches, 0) > 0.1::DOUBLE THEN 'rain'
            ELSE 'clear' END AS weather_condition,
            '{STATION}' AS station_id, 'at {STATION}' AS station_name
        FROM (SELECT observation_date,
            arg_max(value, pos) FILTER (WHERE datatype = 'PRCP') AS precipitation_inches,
            arg_max(value, pos) FILTER (WHERE datatype = 'TMAX') AS temp_max_f,
            arg_max(value, pos) FILTER (WHERE datatype = 'TMIN') AS temp_min_f,
            arg_max(value, pos) FILTER (WHERE datatype = 'SNOW') AS snow_inches,
            arg_max(value, pos) FILTER (WHERE datatype = 'SNWD') AS snow_depth_inches,
            arg_max(value, pos) FILTER (WHERE datatype = 'AWND') AS wind_speed_mph
        FROM observations GROUP BY observation_date)""",
    "weather_daily": """SELECT *, CASE WHEN snow_inches > 2 THEN 'heavy_snow'
            WHEN snow_inches > 0 THEN 'light_snow'
            WHEN precipitation_inches > 0.5 THEN 'heavy_rain'
            WHEN precipitation_inches > 0.1::DOUBLE THEN 'light_rain'
            WHEN temp_max_f < 20 THEN 'extreme_cold' ELSE 'clear' END
            AS weather_category_detailed,
        least(100.0::DOUBLE, coalesce(precipitation_inches * 10, 0)
            + coalesce(snow_inches * 20, 0)
            + CASE WHEN temp_max_f < 20 THEN 30 WHEN temp_max_f > 95 THEN 20 ELSE 0 END
            + CASE WHEN wind_speed_mph > 30 THEN 20 WHEN wind_speed_mph > 15 THEN 10
              ELSE 0 END)::DOUBLE AS weather_severity_score
        FROM weather""",
    "known_weather": "SELECT * FROM weather_daily WHERE dayofweek(observation_date) <> 3",
}


def strata_sql(moment: str, day: str) -> str:
    hour = f"hour({moment})"
    return f"""CAST({hour} AS INTEGER) AS hour,
        CASE WHEN {hour} >= 6 AND {hour} < 9 THEN 'AM_PEAK'
            WHEN {hour} >= 16 AND {hour} < 19 THEN 'PM_PEAK'
            WHEN {hour} >= 9 AND {hour} < 16 THEN 'MIDDAY' ELSE 'OFF_PEAK' END AS hour_bucket,
        CASE WHEN dayofweek({day}) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type"""


SQL["transit"] = f"""SELECT
    md5(concat_ws('||', coalesce(p.prediction_id, '_null_'), coalesce(s.schedule_id, '_null_')))
        AS performance_id,
    p.arrival_time AS predicted_arrival, s.arrival_time AS scheduled_arrival,
    CAST(epoch(p.arrival_time) - epoch(s.arrival_time) AS INTEGER) AS delay_seconds,
    coalesce(epoch(p.arrival_time) - epoch(s.arrival_time) <= 300, false) AS is_on_time,
    p.stop_id, p.stop_h3_index, p.route_id, p.route_long_name, s.schedule_date,
    {strata_sql("s.arrival_time", "s.schedule_date")},
    p.trip_id, p.fetched_at, coalesce(w.weather_condition, 'clear') AS weather_condition,
    w.precipitation_inches, w.temp_max_f, w.temp_min_f, w.snow_inches, w.wind_speed_mph,
    w.weather_category_detailed, w.weather_severity_score
    FROM predictions p JOIN schedules s ON p.trip_id = s.trip_id AND p.stop_id = s.stop_id
    LEFT JOIN known_weather w ON CAST(s.arrival_time AS DATE) = w.observation_date
    WHERE p.arrival_time IS NOT NULL AND s.arrival_time IS NOT NULL"""

SQL["driven"] = f"""SELECT
    d.* EXCLUDE (origin_address, destination_address),
    {strata_sql("d.departure_time", "d.fetched_date")},
    duration_in_traffic_seconds - duration_seconds AS traffic_delay_seconds,
    CASE WHEN duration_seconds > 0 THEN
        (duration_in_traffic_seconds - duration_seconds)::DOUBLE / duration_seconds * 100
        ELSE 0.0::DOUBLE END AS traffic_impact_pct,
    coalesce(w.weather_condition, 'clear') AS weather_condition, w.precipitation_inches,
    w.temp_max_f, w.weather_category_detailed, w.weather_severity_score
    FROM driving d LEFT JOIN known_weather w ON d.fetched_date = w.observation_date"""


def fact_sql(
    source: str, keys: str, measure: str, stem: str, on_time: str, averages: dict[str, str],
    enough: int, firm: int, signed: bool, mode: str,
) -> str:
    """A reliability fact with the percentiles of ``quantile_disc``."""
    p50, p90, p95 = (f"p{p}_{stem}_sec" for p in (50, 90, 95))

    def size(name: str) -> str:
        return f"abs({name})" if signed else name

    extra = "".join(f", avg({column}) AS {name}" for name, column in averages.items())
    return f"""SELECT *,
        CASE WHEN reliability_score >= 90 THEN 'highly_reliable'
            WHEN reliability_score >= 75 THEN 'moderately_reliable'
            WHEN reliability_score >= 60 THEN 'unreliable' ELSE 'very_unreliable' END
            AS reliability_category,
        CASE WHEN transit_volatility_cv < 15 THEN 'low_volatility'
            WHEN transit_volatility_cv < 30 THEN 'medium_volatility' ELSE 'high_volatility' END
            AS volatility_category,
        CASE WHEN trip_count < {enough} THEN 'insufficient_data'
            WHEN trip_count < {firm} THEN 'low_confidence' ELSE 'standard_confidence' END
            AS confidence_level,
        {p90} / 60.0::DOUBLE AS recommended_buffer_min, '{mode}' AS transportation_mode
    FROM (SELECT *, least(100.0::DOUBLE, greatest(0.0::DOUBLE, on_time_score * 0.6::DOUBLE
            + stability_score * 0.4::DOUBLE)) AS reliability_score
      FROM (SELECT *, on_time_count::DOUBLE / trip_count AS on_time_rate,
            on_time_count::DOUBLE / trip_count * 100 AS on_time_score,
            greatest(0.0::DOUBLE, (1.0::DOUBLE - ({p95} - {p50})::DOUBLE
                / greatest({size(p50)}::DOUBLE, 0.1::DOUBLE)) * 100.0::DOUBLE) AS stability_score,
            CASE WHEN {size(f"mean_{stem}_sec")} > 0.1::DOUBLE THEN stddev_{stem}_sec
                / {size(f"mean_{stem}_sec")} * 100 ELSE 0.0::DOUBLE END AS transit_volatility_cv,
            CASE WHEN {size(p50)} > 0.1::DOUBLE THEN ({p90} - {p50})::DOUBLE / {size(p50)} * 100
                ELSE 0.0::DOUBLE END AS percentile_spread_pct
        FROM (SELECT {keys}, count(*) AS trip_count,
            quantile_disc({measure}, 0.5) AS {p50}, quantile_disc({measure}, 0.9) AS {p90},
            quantile_disc({measure}, 0.95) AS {p95}, avg({measure}) AS mean_{stem}_sec,
            stddev_samp({measure}) AS stddev_{stem}_sec{extra},
            count(*) FILTER (WHERE {on_time}) AS on_time_count
          FROM {source} WHERE {measure} IS NOT NULL GROUP BY {keys}
          HAVING count(*) >= {enough})))"""


SQL["transit_fact"] = fact_sql(
    "transit",
    "stop_h3_index, route_id, route_long_name, hour_bucket, day_type, weather_condition",
    "delay_seconds", "delay", "is_on_time", {}, 30, 100, True, "MBTA",
)
SQL["driving_fact"] = (
    "SELECT *, p50_duration_sec / 60.0::DOUBLE AS median_duration_min,"
    " avg_baseline_duration_sec / 60.0::DOUBLE AS baseline_duration_min FROM ("
    + fact_sql(
        "driven",
        "origin_h3_index, destination_h3_index, route_name, hour_bucket, day_type,"
        " weather_condition",
        "duration_in_traffic_seconds", "duration",
        "duration_in_traffic_seconds <= duration_seconds + 300",
        {
            "avg_baseline_duration_sec": "duration_seconds",
            "avg_traffic_delay_sec": "traffic_delay_seconds",
            "avg_traffic_impact_pct": "traffic_impact_pct",
        },
        20, 50, False, "Driving",
    )
    + ")"
)
SQL["modes"] = """SELECT stop_h3_index AS location_h3, route_id, route_long_name, hour_bucket,
    day_type, weather_condition, transportation_mode, reliability_score, reliability_category,
    p50_delay_sec / 60.0::DOUBLE AS median_time_min, p90_delay_sec / 60.0::DOUBLE AS p90_time_min,
    transit_volatility_cv, trip_count, confidence_level FROM transit_fact
    UNION ALL SELECT origin_h3_index, route_name, route_name, hour_bucket, day_type,
    weather_condition, transportation_mode, reliability_score, reliability_category,
    median_duration_min, recommended_buffer_min, transit_volatility_cv, trip_count,
    confidence_level FROM driving_fact"""

NEEDS = {
    "weather": ["observations"],
    "weather_daily": ["weather"],
    "known_weather": ["weather_daily"],
    "transit": ["predictions", "schedules", "known_weather"],
    "driven": ["driving", "known_weather"],
    "transit_fact": ["transit"],
    "driving_fact": ["driven"],
    "modes": ["transit_fact", "driving_fact"],
}


def with_tables(query: str, *names: str) -> str:
    """A query preceded by the named tables and everything they are built from."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{name} AS ({SQL[name]})" for name in order) + " " + query


def shown_sql(columns: str) -> str:
    """Select list with the same presentation as ``plain``.

    A name may carry a kind: ``:t`` time, ``:d`` date, ``:r`` rounded double.
    """
    forms = {
        "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
        "d": "CAST({c} AS VARCHAR)",
        "r": "round({c}, 6)",
    }
    items = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        items.append(f"{forms[kind].format(c=name)} AS {name}" if kind else name)
    return ", ".join(items)
