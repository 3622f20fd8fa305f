"""Incremental runs: raw feeds and staging tables as file streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from headway.feeds import Feed
from headway.operators.expectations import Expectation, counted
from headway.plans import staging
from headway.sinks.tables import append_stream
from headway.sources.files import LANDED_BYTES_PER_BATCH, increments, raw_stream
from headway.streaming.counts import RunCounts, watched


@dataclass(frozen=True)
class Store:
    """Folders of one generation of the tables and of their stream progress."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def progress(self, name: str) -> str:
        return f"{self.root}/progress/{name}"


def append_dataset(
    df: DataFrame,
    store: Store,
    table: str,
    rules: Sequence[Expectation],
    partition_by: Sequence[str] = (),
    slots: int | None = None,
) -> StreamingQuery:
    """Append what is new to a table, counting rule violations on the way."""
    checked = counted(df, rules, f"{table}_rules")
    return append_stream(checked, store.table(table), store.progress(table), partition_by, slots)


def append_raw(
    spark: SparkSession,
    feed: Feed,
    landing: str,
    store: Store,
    bytes_per_batch: int = LANDED_BYTES_PER_BATCH,
    slots: int | None = None,
) -> StreamingQuery:
    rows = raw_stream(spark, feed, landing, bytes_per_batch)
    return append_dataset(rows, store, feed.table, feed.expectations, feed.partition_by, slots)


def append_transit(
    spark: SparkSession,
    store: Store,
    predictions: str,
    schedules: DataFrame,
    daily: DataFrame,
    hot: DataFrame | None = None,
    time_zone: str | None = None,
    slots: int | None = None,
    match_service_date: bool = False,
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """New predictions against the schedules and weather known now.

    Weather that arrives later does not change rows already appended; a full
    refresh does.
    """
    arriving = increments(spark, predictions, schema)
    rows = staging.transit_performance(
        arriving, schedules, daily, hot, time_zone, match_service_date
    )
    return append_dataset(
        rows, store, staging.TRANSIT_TABLE, staging.TRANSIT_RULES, staging.TRANSIT_PARTITION, slots
    )


def append_driving(
    spark: SparkSession,
    store: Store,
    driving: str,
    daily: DataFrame,
    time_zone: str | None = None,
    slots: int | None = None,
    schema: T.StructType | None = None,
) -> StreamingQuery:
    rows = staging.driving_performance(increments(spark, driving, schema), daily, time_zone)
    return append_dataset(
        rows, store, staging.DRIVING_TABLE, staging.DRIVING_RULES, staging.DRIVING_PARTITION, slots
    )


def finish_all(
    started: Mapping[str, StreamingQuery], filed: RunCounts | None = None
) -> dict[str, dict[str, int]]:
    """Rule counts of queries that run side by side; if one fails, the others are stopped."""
    return watched(started, filed)


def finish(query: StreamingQuery, rules_of: str | None = None) -> dict[str, int]:
    """Wait for a query to end; returns its rule counts summed over micro-batches."""
    return watched({rules_of: query})[rules_of]
