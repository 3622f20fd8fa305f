from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from headway import feeds
from headway.operators import joins
from headway.operators.joins import hot_keys
from headway.plans import staging
from headway.sinks import tables as sink
from headway.sinks.tables import land, write_table
from headway.sources import files
from headway.streaming import feeds as streams


def _file(root, feed, day, name, *records):
    folder = root / feed.folder / day
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / name).write_text("\n".join(lines))


def _prediction(key, **more):
    return {"prediction_id": key, "route_id": "R", "trip_id": "T", "stop_id": "S",
            "fetched_date": "2024-01-05", **more}


def test_raw_stream_reads_each_file_once(spark, tmp_path):
    store = streams.Store(str(tmp_path / "store"))

    def run():
        query = streams.append_raw(spark, feeds.PREDICTIONS, str(tmp_path), store)
        return streams.finish(query, feeds.PREDICTIONS.table)

    _file(
        tmp_path, feeds.PREDICTIONS, "2024-01-05", "a.json",
        _prediction("1", arrival_time="2024-01-05T08:30:00-05:00"),
        _prediction("2", arrival_time="soon"),
        "{malformed",
        {"prediction_id": "3", "fetched_date": "2024-01-05", "unknown": 1},
    )
    assert run() == {"rows": 4, "valid_prediction_id": 1, "valid_route_id": 2}
    _file(tmp_path, feeds.PREDICTIONS, "2024-01-06", "b.json", _prediction("4"))
    assert run()["rows"] == 1
    assert run() == {}
    rows = files.snapshot(spark, store.table(feeds.PREDICTIONS.table)).collect()
    found = {r.prediction_id: r for r in rows}
    assert len(rows) == 5 and found.keys() == {"1", "2", "3", "4", None}
    assert found["1"].arrival_time == dt.datetime(2024, 1, 5, 13, 30)
    assert found["2"].arrival_time is None
    assert found["1"].fetched_date == dt.date(2024, 1, 5)
    assert all(r._ingested_at is not None for r in rows)


def test_raw_batch_equals_raw_stream(spark, tmp_path):
    _file(
        tmp_path, feeds.DRIVING, "2024-01-05", "a.json",
        {"route_name": "Road", "duration_seconds": 600, "fetched_date": "2024-01-05"},
        {"route_name": None, "duration_seconds": 0, "fetched_date": "2024-01-06"},
    )
    store = streams.Store(str(tmp_path / "store"))
    query = streams.append_raw(spark, feeds.DRIVING, str(tmp_path), store)
    assert streams.finish(query, feeds.DRIVING.table) == {
        "rows": 2, "valid_route_name": 1, "valid_duration": 1,
    }
    batch = files.raw_batch(spark, feeds.DRIVING, str(tmp_path)).drop("_ingested_at")
    streamed = files.snapshot(spark, store.table(feeds.DRIVING.table)).select(*batch.columns)
    assert sorted(batch.collect(), key=str) == sorted(streamed.collect(), key=str)


BASE = dt.datetime(2024, 1, 5, 8, 0)


@pytest.fixture
def tables(spark, tmp_path):
    """Predictions where one trip holds a third of the rows, with NULL keys and times."""
    ids = spark.range(600)
    trip = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 20 == 1, None)
    predictions = ids.select(
        F.col("id").cast("string").alias("prediction_id"),
        trip.otherwise(F.concat(F.lit("T"), F.col("id") % 50)).alias("trip_id"),
        F.lit("S").alias("stop_id"),
        F.lit("C").alias("stop_h3_index"),
        F.lit("R").alias("route_id"),
        F.lit("Route").alias("route_long_name"),
        F.when(F.col("id") % 7 != 0, F.timestamp_seconds(F.lit(1704441600) + F.col("id"))).alias(
            "arrival_time"
        ),
        F.lit(BASE).alias("fetched_at"),
        F.lit(BASE.date()).alias("fetched_date"),
    )
    schedules = spark.range(60).select(
        F.concat(F.lit("P"), F.col("id")).alias("schedule_id"),
        F.when(F.col("id") < 3, "hot").otherwise(F.concat(F.lit("T"), F.col("id"))).alias("trip_id"),
        F.lit("S").alias("stop_id"),
        F.when(F.col("id") % 10 != 5, F.lit(BASE)).alias("arrival_time"),
        F.lit(BASE.date()).alias("schedule_date"),
    )
    weather = spark.createDataFrame(
        [(BASE.date(), "snow", 0.0, 30.0, 20.0, 3.0, 5.0, "heavy_snow", 60.0)],
        """observation_date date, weather_condition string, precipitation_inches double,
        temp_max_f double, temp_min_f double, snow_inches double, wind_speed_mph double,
        weather_category_detailed string, weather_severity_score double""",
    )
    path = write_table(predictions, str(tmp_path / "predictions"), ["fetched_date"])
    return path, schedules, weather


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("slots", [None, 2])
def test_transit_stream_equals_batch(spark, tmp_path, tables, spread, slots):
    path, schedules, weather = tables
    predictions = files.snapshot(spark, path)
    hot = hot_keys(predictions, schedules, staging.TRIP_KEYS, 2, 0.04) if spread else None
    assert (hot is not None) == spread
    store = streams.Store(str(tmp_path / "store"))
    query = streams.append_transit(spark, store, path, schedules, weather, hot, None, slots)
    counts = streams.finish(query, staging.TRANSIT_TABLE)
    batch = staging.transit_performance(predictions, schedules, weather)
    streamed = files.snapshot(spark, store.table(staging.TRANSIT_TABLE)).select(*batch.columns)
    expected = sorted(batch.collect())
    assert sorted(streamed.collect()) == expected
    assert counts == {
        "rows": len(expected), "valid_delay": 0, "valid_schedule": 0, "valid_hour_bucket": 0,
        "valid_day_type": 0,
    }
    left, right = predictions.collect(), schedules.collect()
    brute = [
        (p, s)
        for p in left
        for s in right
        if p.trip_id is not None and p.trip_id == s.trip_id and p.arrival_time and s.arrival_time
    ]
    assert len(expected) == len(brute)
    assert {r.weather_condition for r in expected} == {"snow"}


def test_long_weather_is_salted_in_a_stream(spark, tmp_path, tables, monkeypatch):
    """Weather beyond the broadcast limit gives the same rows."""
    path, schedules, weather = tables
    store = streams.Store(str(tmp_path / "store"))
    batch = staging.transit_performance(files.snapshot(spark, path), schedules, weather)
    monkeypatch.setattr(joins.with_daily_weather, "__defaults__", (joins.WEATHER_FIELDS, 0))
    streams.finish(streams.append_transit(spark, store, path, schedules, weather))
    streamed = files.snapshot(spark, store.table(staging.TRANSIT_TABLE)).select(*batch.columns)
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_late_weather_stays_clear_in_a_stream(spark, tmp_path, tables):
    path, schedules, weather = tables
    store = streams.Store(str(tmp_path / "store"))
    none_yet = weather.filter("false")
    streams.finish(streams.append_transit(spark, store, path, schedules, none_yet))
    streams.finish(streams.append_transit(spark, store, path, schedules, weather))
    streamed = files.snapshot(spark, store.table(staging.TRANSIT_TABLE))
    assert [r[0] for r in streamed.select("weather_condition").distinct().collect()] == ["clear"]


def test_landing_nothing_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "a int")
    assert land(empty, str(tmp_path), "feed", "2024-01-05") is None
    assert not (tmp_path / "feed").exists()
    path = land(spark.range(3), str(tmp_path), "feed", "2024-01-05")
    assert spark.read.json(path).count() == 3


def test_landed_lines_are_packed_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(sink._PACKED, "maxRecordsPerFile", 300)
    rows = spark.range(0, 1000, 1, 2).selectExpr(
        "concat('p', id) AS prediction_id", "'R1' AS route_id", "concat('T', id) AS trip_id",
        "'2024-01-05T08:30:00' AS arrival_time", "'2024-01-05' AS fetched_date",
    )
    rows.write.json(str(tmp_path / "plain"))
    path = land(rows, str(tmp_path), feeds.PREDICTIONS.folder, "2024-01-05")
    packed, plain = (list((tmp_path / p).glob("part-*")) for p in (path, "plain"))
    assert len(packed) == 4 and all(f.name.endswith(".json.gz") for f in packed)
    assert sum(f.stat().st_size for f in packed) * 4 < sum(f.stat().st_size for f in plain)
    assert all(spark.read.text(str(f)).count() <= 300 for f in packed)
    store = streams.Store(str(tmp_path / "store"))
    streams.finish(streams.append_raw(spark, feeds.PREDICTIONS, str(tmp_path), store))
    for read in (
        files.snapshot(spark, store.table(feeds.PREDICTIONS.table)),
        files.raw_batch(spark, feeds.PREDICTIONS, str(tmp_path)),
    ):
        assert read.select("prediction_id", "trip_id").distinct().count() == read.count() == 1000


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    write_table(rows, path, ["p"])
    write_table(rows.filter("p = 'a'").withColumn("v", F.lit(9)), path, ["p"],
                only_touched_partitions=True)
    assert {(r.v, r.p) for r in spark.read.parquet(path).collect()} == {(9, "a"), (2, "b")}


@pytest.mark.parametrize("copies", [False, True])
def test_clustering_spreads_a_hot_value(spark, copies):
    from headway.sinks.tables import clustered

    rows = spark.range(20000).select(
        F.lit("same").alias("k"), (F.lit(1) if copies else F.col("id")).alias("v")
    )
    placed = clustered(rows.repartition(4), ["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[0] for r in placed.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and sum(sizes) == 20000


def test_a_micro_batch_writes_few_files_to_each_partition(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id", "CAST(id % 3 AS int) AS day").repartition(40)
    rows.write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for slots in (None, 2):
        out = tmp_path / f"out-{slots}"
        sink.append_stream(arriving, str(out), f"{out}-progress", ("day",), slots).awaitTermination()
        for day in range(3):
            files = list((out / f"day={day}").glob("*.parquet"))
            assert 0 < len(files) <= (slots or sink.SLOTS)
        assert spark.read.parquet(str(out)).count() == 4000
