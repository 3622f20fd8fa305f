from __future__ import annotations

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import trial_tables as t
from headway import feeds
from headway.operators import layout
from headway.operators.expectations import keep_valid
from headway.plans import daily, maintenance, staging
from headway.sources.files import snapshot
from headway.streaming import feeds as streams

DATA = "/root/testdata/sf0.001"


def _ranks(cuts, values):
    return [sum(c <= v for c in cuts) if v is not None else 0 for v in values]


@pytest.mark.parametrize(
    "schema, values",
    [
        ("v int", [None, -5, 0, 3, 3, 7, 100]),
        ("v string", [None, "", "a", "ab", "b", "é", "zz"]),
        ("v date", [None, dt.date(2023, 1, 1), dt.date(2024, 1, 1)]),
        ("v double", [None, float("-inf"), -0.5, 0.0, 1e300]),
    ],
)
def test_bucket_counts_the_cut_points_below(spark, schema, values):
    known = sorted(v for v in values if v is not None)
    cuts = [known[len(known) * i // 8] for i in range(1, 8)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    found = rows.select("i", layout.rank_bucket(F.col("v"), cuts).alias("b")).orderBy("i").collect()
    assert [r.b for r in found] == _ranks(cuts, values)
    assert [r[0] for r in rows.select(layout.rank_bucket(F.col("v"), [])).collect()] == [0] * len(values)


def test_bits_are_interleaved(spark):
    rows = spark.range(32).crossJoin(spark.range(32).withColumnRenamed("id", "jd"))
    key = layout.interleaved([F.col("id"), F.col("jd")], 5)
    found = {(r[0], r[1]): r[2] for r in rows.select("id", "jd", key).collect()}
    for (a, b), z in found.items():
        bits = "".join(x + y for x, y in zip(f"{a:05b}", f"{b:05b}"))
        assert z == int(bits, 2)
    with pytest.raises(ValueError):
        layout.interleaved([F.col("id")] * 13, 5)


def _holding(files, column, value):
    """Files whose footers do not rule out the value."""
    kept = 0
    for name in files:
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        groups = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        kept += any(s.min <= value <= s.max for s in groups)
    return kept


def test_a_filter_on_either_column_reads_few_files(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.pmod(F.xxhash64("id"), F.lit(997)).alias("a"),
        F.concat(F.lit("R"), F.lpad(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).cast("string"), 3, "0")).alias("b"),
        "id",
    )
    cuts = layout.cut_points(rows, ["a", "b"], 60_000, sampled=5_000)
    assert len(cuts["a"]) == len(cuts["b"]) == 31
    layout.z_clustered(rows, cuts, files=64).write.parquet(str(tmp_path / "z"))
    files = glob.glob(str(tmp_path / "z" / "*.parquet"))
    assert len(files) > 40
    assert spark.read.parquet(str(tmp_path / "z")).agg(F.sum("id"), F.count("id")).first() == (
        60_000 * 59_999 // 2, 60_000,
    )
    for column, value in (("a", 17), ("a", 500), ("b", "R250"), ("b", "R499")):
        assert 0 < _holding(files, column, value) < len(files) / 3


def test_a_hot_value_spreads_over_files(spark, tmp_path):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        F.lit(None).cast("string").alias("b"),
    )
    cuts = layout.cut_points(rows, ["a", "b"], 30_000)
    assert cuts["b"] == []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = layout.z_clustered(rows, cuts, files=12)
        sizes = [r[1] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 30_000 and max(sizes) < 3 * 30_000 / 12


def _sorted(df):
    return sorted(df.drop("fetched_at").collect(), key=str)


@pytest.fixture
def store(spark, tmp_path):
    return streams.Store(str(tmp_path / "store"))


def _land(spark, store, tables):
    """Append typed rows to the raw tables as the streams would."""
    schemas = daily.table_schemas(spark)
    for feed, rows in tables.items():
        typed = rows.select(
            *(
                F.col(f.name).cast(f.dataType) if f.name in rows.columns
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schemas[feed.table].fields
            )
        )
        typed.write.mode("append").partitionBy(*feed.partition_by).parquet(store.table(feed.table))
    return schemas


def _set_weather(spark, store, rows):
    rows.write.mode("overwrite").parquet(store.table(staging.WEATHER_TABLE))
    return spark.read.parquet(store.table(staging.WEATHER_TABLE))


def _append(spark, store, schemas, known):
    maintenance.before_streams(spark, store, known, schemas)
    schedules = snapshot(spark, store.table(feeds.SCHEDULES.table), schemas[feeds.SCHEDULES.table])
    streams.finish(streams.append_transit(
        spark, store, store.table(feeds.PREDICTIONS.table), schedules, known,
        schema=schemas[feeds.PREDICTIONS.table],
    ))
    streams.finish(streams.append_driving(
        spark, store, store.table(feeds.DRIVING.table), known, schema=schemas[feeds.DRIVING.table],
    ))


def _files(store, table):
    return set(glob.glob(f"{store.root}/maintained/{table}/**/*.parquet", recursive=True))


def test_late_weather_reaches_trips_appended_before(spark, store):
    raw = {
        feeds.PREDICTIONS: t.predictions(spark, DATA),
        feeds.SCHEDULES: t.schedules(spark, DATA),
        feeds.DRIVING: t.driving(spark, DATA),
    }
    schemas = _land(spark, store, raw)
    whole = t.known_weather(spark, DATA)
    whole.write.parquet(f"{store.root}/whole")
    whole = spark.read.parquet(f"{store.root}/whole")
    planned = F.to_date("scheduled_arrival")

    def table(name):
        return snapshot(spark, store.table(name), schemas.get(name))

    def read(layout_):
        return maintenance.current(spark, store, layout_, schemas[layout_.table])

    def batch(known):
        trips = staging.transit_performance(
            table(feeds.PREDICTIONS.table), table(feeds.SCHEDULES.table), known
        )
        drives = staging.driving_performance(table(feeds.DRIVING.table), known)
        return (
            keep_valid(trips, staging.TRANSIT_RULES),
            keep_valid(drives, staging.DRIVING_RULES),
        )

    late = [r[0] for r in whole.select("observation_date").distinct().orderBy("observation_date").limit(2).collect()]
    early = _set_weather(spark, store, whole.filter(~F.col("observation_date").isin(late)))
    _append(spark, store, schemas, early)
    written = maintenance.maintain_all(spark, store, schemas)
    assert written[staging.TRANSIT_TABLE].filter("recomputed").isEmpty()
    first = [_sorted(rows) for rows in batch(early)]
    assert [_sorted(read(x)) for x in (maintenance.TRANSIT, maintenance.DRIVING)] == first
    before = {x.table: _files(store, x.table) for x in maintenance.LAYOUTS}

    # nothing new: no file is written
    again = maintenance.maintain_all(spark, store, schemas)
    assert all(days.isEmpty() for days in again.values())
    assert {x.table: _files(store, x.table) for x in maintenance.LAYOUTS} == before

    # two days of weather come late: only partitions with trips of these days are written
    opened = read(maintenance.TRANSIT)
    full = _set_weather(spark, store, whole)
    written = maintenance.maintain_all(spark, store, schemas)
    days = {r.day for r in written[staging.TRANSIT_TABLE].collect()}
    trips, drives = batch(full)
    touched = {
        str(r[0] or "") for r in table(feeds.SCHEDULES.table)
        .filter(F.to_date("arrival_time").isin(late)).select("schedule_date").distinct().collect()
    }
    assert days == touched and 0 < len(days) < trips.select("schedule_date").distinct().count()
    assert written[feeds.PREDICTIONS.table].isEmpty()
    assert _sorted(read(maintenance.TRANSIT)) == _sorted(trips)
    assert _sorted(read(maintenance.DRIVING)) == _sorted(drives)
    assert before[staging.TRANSIT_TABLE] <= _files(store, staging.TRANSIT_TABLE)
    assert _sorted(opened) == first[0]  # a reader keeps the files it has open
    assert read(maintenance.TRANSIT).filter(planned.isin(late)).count() > 0

    # a step that failed before its lines were filed is not seen
    orphan = read(maintenance.TRANSIT).limit(5)
    orphan.write.partitionBy("schedule_date").parquet(
        f"{store.root}/maintained/{staging.TRANSIT_TABLE}/_in=s999999-failed"
    )
    assert read(maintenance.TRANSIT).count() == trips.count()

    # more rows of a partition that was computed anew, and of others
    _land(spark, store, {feeds.PREDICTIONS: raw[feeds.PREDICTIONS].limit(50),
                         feeds.DRIVING: raw[feeds.DRIVING].limit(20)})
    _append(spark, store, schemas, full)
    maintenance.maintain_all(spark, store, schemas)
    trips, drives = batch(full)
    assert _sorted(read(maintenance.TRANSIT)) == _sorted(trips)
    assert _sorted(read(maintenance.DRIVING)) == _sorted(drives)
    assert read(maintenance.PREDICTIONS).count() == table(feeds.PREDICTIONS.table).count()


def test_maintenance_of_a_store_without_rows(spark, store):
    schemas = daily.table_schemas(spark)
    none = staging.weather_daily(spark.createDataFrame([], schemas[feeds.WEATHER.table]))
    known = _set_weather(spark, store, none)
    maintenance.before_streams(spark, store, known, schemas)
    written = maintenance.maintain_all(spark, store, schemas)
    assert all(days.isEmpty() for days in written.values())
    for layout_ in maintenance.LAYOUTS:
        assert maintenance.current(spark, store, layout_, schemas[layout_.table]).isEmpty()


def test_changed_days(spark):
    texts = ("weather_condition", "weather_category_detailed")
    schema = "observation_date date, weather_condition string, " + ", ".join(
        f"{c} {'string' if c in texts else 'double'}" for c in maintenance.WEATHER_FIELDS
    )

    def rows(*days):
        return spark.createDataFrame(
            [(d, c, *([None] * len(maintenance.WEATHER_FIELDS))) for d, c in days], schema
        )

    one, two, three = (dt.date(2024, 1, d) for d in (1, 2, 3))
    old = rows((one, "clear"), (two, "rain"), (three, "snow"), (None, "rain"))
    new = rows((one, "clear"), (two, "snow"), (three, "snow"), (three, "snow"))
    assert {r[0] for r in maintenance.changed_days(old, new).collect()} == {two, three}
    assert maintenance.changed_days(old, old).isEmpty()
