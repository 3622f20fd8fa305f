"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.keys import row_hash
from headway.functions.weather import MISSING_CONDITION
from headway.session import durable

WEATHER_FIELDS = (
    "precipitation_inches",
    "temp_max_f",
    "temp_min_f",
    "snow_inches",
    "wind_speed_mph",
    "weather_category_detailed",
    "weather_severity_score",
)
# A day of weather is one short row, so this many stay around 20 MB.
MAX_BROADCAST_DAYS = 100_000
ROWS_PER_TASK = 2_000_000
# Pairs of rows that one task should make at most.
PAIRS_PER_TASK = 200_000_000


def hot_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    share: float = 1e-5,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame | None:
    """Keys too large for one task, with the tasks each side of them should get.

    A key is hot when one side has more than ``rows_per_task`` rows of it, or both make
    more than ``pairs_per_task`` pairs, and when that is also more than ``share`` of all
    rows or pairs. So there are at most ``1 / share`` hot keys of each of the three kinds,
    which bounds what a join may broadcast. The slots of a key leave no task with more than
    ``rows_per_task`` rows of a side, or with more pairs than the larger of the two limits on
    pairs. So pairs ask for some ``1 / share`` slots over all keys, however many pairs there
    are, and the rows that slots repeat grow with the rows and not with the pairs. None when
    no key is hot. The result is checkpointed so that both sides of a join, and every
    micro-batch, see the same keys.
    """
    keys = list(keys)

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    met = counts(left, "_l").join(counts(right, "_r"), keys)
    met = durable(met.withColumn("_pairs", F.col("_l").cast("double") * F.col("_r")))
    totals = met.agg(*(F.sum(c).alias(c) for c in ("_l", "_r", "_pairs"))).first()
    if totals["_l"] is None:
        return None
    limits = {"_l": rows_per_task, "_r": rows_per_task, "_pairs": pairs_per_task}
    limits = {c: max(limit, totals[c] * share) for c, limit in limits.items()}
    above = {c: F.col(c) > limit for c, limit in limits.items()}
    by_rows = {
        c: F.when(above[c], F.ceil(F.col(c) / rows_per_task)).otherwise(F.lit(1)) for c in ("_l", "_r")
    }
    # Slots by rows first. What is missing for the pairs is dealt in proportion to the rows of
    # the sides, so that both are repeated about equally often.
    more = F.ceil(F.col("_pairs") / (by_rows["_l"] * by_rows["_r"] * F.lit(float(limits["_pairs"]))))
    larger = F.greatest("_l", "_r")
    even = F.ceil(F.sqrt(more * larger / F.least("_l", "_r")))
    first = F.least(even, more, larger)
    second = F.ceil(more / first)
    left_larger = F.col("_l") >= F.col("_r")
    slots = met.filter(above["_l"] | above["_r"] | above["_pairs"]).select(
        *keys,
        (by_rows["_l"] * F.when(left_larger, first).otherwise(second)).cast("int").alias("_left_slots"),
        (by_rows["_r"] * F.when(left_larger, second).otherwise(first)).cast("int").alias("_right_slots"),
    )
    marked = durable(slots)
    return None if marked.isEmpty() else marked


def spread_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame | None
) -> DataFrame:
    """Inner equi-join whose hot keys, a result of ``hot_keys``, go to many tasks.

    A row of a hot side takes one slot, and the rows it can meet are repeated
    for every slot, so each pair still meets exactly once. Rows of other keys
    are neither salted nor repeated. Batch plans also have AQE's skew join; a
    stream has not, and relies on this.
    """
    keys = list(keys)
    if hot is None:
        return left.join(right, keys, "inner")

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        slots, repeats = (F.coalesce(name, F.lit(1)) for name in (own, other))
        marked = df.join(F.broadcast(hot), keys, "left")
        return marked.withColumns(
            {
                f"{own}_at": F.pmod(row_hash(df), slots).cast("int"),
                f"{other}_at": F.explode(F.sequence(F.lit(0), repeats - 1)),
            }
        ).drop(own, other)

    met = placed(left, "_left_slots", "_right_slots").join(
        placed(right, "_right_slots", "_left_slots"),
        [*keys, "_left_slots_at", "_right_slots_at"],
        "inner",
    )
    return met.drop("_left_slots_at", "_right_slots_at")


def with_daily_weather(
    df: DataFrame,
    day: Column,
    weather: DataFrame,
    fields: Sequence[str] = WEATHER_FIELDS,
    max_broadcast: int = MAX_BROADCAST_DAYS,
) -> DataFrame:
    """Left join to daily weather; a day without weather counts as clear.

    The weather side is broadcast only after its row count is checked. Beyond
    the limit a batch is left to AQE, which splits a day that holds a large
    part of ``df``. A stream has no AQE: there the rows of a day are spread
    over salts, for which the weather rows are repeated.
    """
    daily = weather.select(F.col("observation_date").alias("_day"), "weather_condition", *fields)
    keyed = df.withColumn("_day", day)
    known = daily.filter(F.col("_day").isNotNull())
    if known.select("_day").limit(max_broadcast + 1).count() <= max_broadcast:
        joined = keyed.join(F.broadcast(known), "_day", "left")
    elif not df.isStreaming:
        joined = keyed.join(known, "_day", "left")
    else:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slot = F.pmod(row_hash(keyed), F.lit(salts)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        joined = (
            keyed.withColumn("_salt", slot)
            .join(known.withColumn("_salt", every), ["_day", "_salt"], "left")
            .drop("_salt")
        )
    return joined.drop("_day").withColumn(
        "weather_condition", F.coalesce("weather_condition", F.lit(MISSING_CONDITION))
    )
