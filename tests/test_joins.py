from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.operators import joins


def _sides(spark, hot_right):
    """A third of the left rows share one key, and maybe of the right rows too."""
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.col("id").alias("a"),
    )
    right = spark.range(60).select(
        F.when(F.col("id") < (20 if hot_right else 3), "hot")
        .when(F.col("id") % 5 == 0, "k1")
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id").alias("b"),
    )
    return left, right


@pytest.mark.parametrize("hot_right", [False, True])
def test_spread_join_equals_plain_join(spark, hot_right):
    left, right = _sides(spark, hot_right)
    hot = joins.hot_keys(left, right, ["k"], rows_per_task=7, share=0.1)
    found = {r.k: (r._left_slots, r._right_slots) for r in hot.collect()}
    assert found == {"hot": (43, 3 if hot_right else 1), "k1": (1, 2)}
    spread = joins.spread_join(left, right, ["k"], hot)
    plain = left.join(right, "k")
    assert spread.columns == plain.columns
    assert sorted(spread.collect()) == sorted(plain.collect())


def test_a_hot_key_goes_to_many_tasks(spark):
    left, right = _sides(spark, False)
    hot = joins.hot_keys(left, right, ["k"], rows_per_task=7, share=0.1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = joins.spread_join(left, right, ["k"], hot).filter("k = 'hot'")
        loads = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(loads) == 4
    assert max(r["count"] for r in loads) < 900 / 2


def test_no_hot_keys(spark):
    left, right = _sides(spark, True)
    assert joins.hot_keys(left, right, ["k"]) is None


def _weather(spark):
    rows = [(dt.date(2024, 1, 1), "snow", 1.0), (dt.date(2024, 1, 2), None, 2.0), (None, "rain", 3.0)]
    return spark.createDataFrame(
        rows, "observation_date date, weather_condition string, snow_inches double"
    )


@pytest.mark.parametrize("limit", [100, 1])
def test_weather_is_the_same_with_and_without_broadcast(spark, limit):
    trips = spark.range(40).select(
        F.col("id").alias("trip"),
        F.when(F.col("id") < 30, F.lit(dt.date(2024, 1, 1)))
        .when(F.col("id") < 34, F.lit(dt.date(2024, 1, 2)))
        .when(F.col("id") < 38, F.lit(dt.date(2024, 1, 9)))
        .alias("day"),
    )
    joined = joins.with_daily_weather(
        trips, F.col("day"), _weather(spark), ["snow_inches"], max_broadcast=limit
    )
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit == 100)
    found = {r.trip: (r.weather_condition, r.snow_inches) for r in joined.collect()}
    assert len(found) == joined.count() == 40
    assert found[0] == ("snow", 1.0)
    assert found[30] == ("clear", 2.0)
    assert found[35] == ("clear", None)
    assert found[39] == ("clear", None)


def test_keys_are_hot_by_their_pairs(spark):
    """Few rows on both sides, many pairs: no task gets more of them than asked for."""
    left = spark.range(120).selectExpr("id % 2 AS k", "id AS a")
    right = spark.range(90).selectExpr("id % 2 AS k", "id AS b")
    hot = joins.hot_keys(left, right, ["k"], rows_per_task=1000, pairs_per_task=300)
    found = {r.k: (r._left_slots, r._right_slots) for r in hot.collect()}
    assert all(60 / a * 45 / b <= 300 for a, b in found.values()) and len(found) == 2
    spread = joins.spread_join(left, right, ["k"], hot)
    assert sorted(spread.collect()) == sorted(left.join(right, "k").collect())
    assert joins.hot_keys(left, right, ["k"], rows_per_task=1000, pairs_per_task=2700) is None


def test_slots_by_pairs_do_not_grow_with_the_pairs(spark):
    """Ten times the rows are a hundred times the pairs, but ten times the rows that are repeated."""
    repeated = []
    for times in (1, 10):
        left = spark.range(400 * times).selectExpr("id % 2 AS k", "id AS a")
        right = spark.range(30 * times).selectExpr("id % 2 AS k", "id AS b")
        hot = joins.hot_keys(left, right, ["k"], share=0.01, pairs_per_task=4)
        found = hot.collect()
        assert all(100 >= r._left_slots * r._right_slots >= 50 for r in found) and len(found) == 2
        repeated.append(sum(200 * times * r._right_slots + 15 * times * r._left_slots for r in found))
        spread = joins.spread_join(left, right, ["k"], hot)
        assert sorted(spread.collect()) == sorted(left.join(right, "k").collect())
    assert repeated[1] == 10 * repeated[0]
