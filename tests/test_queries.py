"""Every registered query against its SQL, and the shape of the main plans."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
import check

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return check.connection(DATA)


#: Queries whose groups are too small for a row at this size.
MAY_BE_EMPTY: set[str] = set()
OWN = sorted(registered.queries().keys() - set(registered.LLM_QUERIES))


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, db, name):
    problem = check.difference(spark, db, name, DATA)
    assert problem == ("no rows" if name in MAY_BE_EMPTY else None), problem


def test_every_query_has_sql():
    assert set(OWN) <= registered.oracle_sql().keys()


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = """hour_and_day_strata weather_pivot transit_performance driving_performance
    transit_reliability transit_reliability_sketch ship_delay_reliability mode_comparison
    weather_impact mode_comparison_sliced change_feed flattened_predictions retired_routes""".split()


@pytest.mark.parametrize("name", LAZY)
def test_plan_stays_on_the_jvm_without_products(spark, name):
    plan = _plan(registered.queries()[name](spark, DATA))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert unwanted not in plan, plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(registered.queries()["ship_delay_reliability"](spark, DATA))
    assert "l_comment" not in plan and "l_extendedprice" not in plan
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_sketch_fact_shuffles_once(spark):
    """Beyond spreading a small input, one exchange: from partial to final aggregate."""
    from pyspark.sql import functions as F

    from headway.operators import reliability

    rows = spark.read.parquet(f"{DATA}/lineitem.parquet").select(
        F.col("l_suppkey").alias("l_suppkey"),
        "l_returnflag",
        F.col("l_linenumber").alias("delay_seconds"),
        F.lit(True).alias("is_on_time"),
    )
    sketch = reliability.reliability_fact(rows, registered.SHIPPING, "sketch")
    assert _plan(sketch).count("Exchange") == 1
    exact = reliability.reliability_fact(rows, registered.SHIPPING, "exact")
    assert _plan(exact).count("Exchange") == 2


def test_ranked_fact_gathers_no_whole_group(spark):
    """No window: the values of a group never come together."""
    plan = _plan(registered.queries()["transit_reliability_ranked"](spark, DATA))
    assert "Window" not in plan and "Python" not in plan, plan


@pytest.fixture
def own_tables(spark, tmp_path):
    """Some trips, roads and readings of a few days."""
    orders = spark.range(40).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey")
    items = spark.range(120).selectExpr(
        "id % 40 AS l_orderkey", "id AS l_partkey", "id % 9 AS l_suppkey",
        "CAST(1 + id % 3 AS int) AS l_linenumber", "'F' AS l_linestatus", "'N' AS l_returnflag",
    )
    events = spark.range(200).selectExpr(
        "id AS event_id", "id % 11 AS user_id",
        "to_timestamp_ntz(timestamp_seconds(1704067200 + id * 5000)) AS ts",
    )
    for name, rows in (("orders", orders), ("lineitem", items), ("events", events)):
        rows.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_report_works_out_the_weather_once(spark, own_tables, monkeypatch):
    """And writes no texts of trips that no rule and no fact reads."""
    made, weather = [], registered.t.weather
    monkeypatch.setattr(registered.t, "weather", lambda *at: made.append(1) or weather(*at))
    checked = {name: (rows, rules) for rows, name, rules in registered._checked(spark, own_tables)}
    assert len(made) == 1
    assert not set(registered._UNCHECKED) & set(checked["transit"][0].columns)
    plain = registered.t.transit(spark, own_tables)
    rules = checked["transit"][1]
    count = registered.expectations.violations
    found = count(checked["transit"][0], "transit", rules).collect()
    assert found == count(plain, "transit", rules).collect() and found[0].total_rows > 0
    days = registered.t.weather_daily(spark, own_tables)
    assert sorted(checked["weather_daily"][0].collect()) == sorted(days.select(checked["weather_daily"][0].columns).collect())


def test_input_of_the_streamed_trips_is_not_dealt_by_day(spark, own_tables, monkeypatch):
    written, write = [], registered._written
    monkeypatch.setattr(registered, "_written", lambda *a: written.append(write(*a)) or written[-1])
    rows = registered.transit_performance_streamed(spark, own_tables)
    assert not any(name.startswith("fetched_date=") for name in os.listdir(written[0]))
    plain = registered.t.transit(spark, own_tables).filter("delay_seconds IS NOT NULL")
    assert rows.count() == plain.count() > 0
