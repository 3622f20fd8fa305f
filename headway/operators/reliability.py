"""Reliability facts: grouped travel statistics, scores and labels."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.functions import scoring
from headway.operators.expectations import Expectation
from headway.session import stored

PERCENTS = (50, 90, 95)
STRATA = ("hour_bucket", "day_type", "weather_condition")


@dataclass(frozen=True)
class FactSpec:
    """What differs between the facts of two travel modes."""

    table: str
    mode: str
    measure: str
    stem: str
    keys: tuple[str, ...]
    on_time: str
    enough_trips: int
    firm_trips: int
    signed: bool
    averages: Mapping[str, str] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()

    def expectations(self) -> tuple[Expectation, ...]:
        return (
            Expectation("valid_reliability_score", "reliability_score BETWEEN 0 AND 100"),
            Expectation("sufficient_sample_size", f"trip_count >= {self.enough_trips}"),
        )


# Names, keys and thresholds that results are compared on.
TRANSIT = FactSpec(
    table="fct_mbta_route_reliability",
    mode="MBTA",
    measure="delay_seconds",
    stem="delay",
    keys=("stop_h3_index", "route_id", "route_long_name", *STRATA),
    on_time="is_on_time",
    enough_trips=30,
    firm_trips=100,
    signed=True,
    cluster_by=("stop_h3_index", "route_id"),
)
DRIVING = FactSpec(
    table="fct_driving_route_reliability",
    mode="Driving",
    measure="duration_in_traffic_seconds",
    stem="duration",
    keys=("origin_h3_index", "destination_h3_index", "route_name", *STRATA),
    on_time="duration_in_traffic_seconds <= CAST(duration_seconds AS BIGINT) + 300",
    enough_trips=20,
    firm_trips=50,
    signed=False,
    averages={
        "avg_baseline_duration_sec": "duration_seconds",
        "avg_traffic_delay_sec": "traffic_delay_seconds",
        "avg_traffic_impact_pct": "traffic_impact_pct",
    },
)


def trip_statistics(df: DataFrame, spec: FactSpec, percentiles: str = "exact") -> DataFrame:
    """Count, discrete percentiles, mean, deviation and on-time count per group.

    ``exact`` first counts equal values: a large group is spread over tasks by
    value and shrinks to its distinct whole seconds, whose counts are then
    ranked by a window per group. ``ranked`` gives the same without one: ranks
    are selected in two levels, so no task holds the values of a whole group.
    It takes about twice as long where groups are small, and is meant for
    measures that spread over months of seconds. Neither depends on how the
    rows are split. ``sketch`` is one
    pass with a bounded sketch per group, combined on the map side, for
    measures with too many distinct values to count. It is exact up to some
    5,000 rows in a group and off by at most 1/10,000 of the ranks beyond.
    """
    rows = df.filter(F.col(spec.measure).isNotNull())
    if percentiles == "sketch":
        return _sketched(rows, spec)
    if percentiles == "exact":
        return _counted(rows, spec)
    if percentiles == "ranked":
        return _ranked(rows, spec)
    raise ValueError(f"percentiles must be exact, ranked or sketch, not {percentiles}")


def _column(spec: FactSpec, statistic: str) -> str:
    return f"{statistic}_{spec.stem}_sec"


def _sketched(rows: DataFrame, spec: FactSpec) -> DataFrame:
    measure = F.col(spec.measure)
    points = F.percentile_approx(measure, [p / 100 for p in PERCENTS], 10_000)
    stats = rows.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("trip_count"),
        points.alias("_points"),
        F.avg(measure).alias(_column(spec, "mean")),
        F.stddev_samp(measure).alias(_column(spec, "stddev")),
        *[F.avg(source).alias(name) for name, source in spec.averages.items()],
        F.count_if(F.expr(spec.on_time)).alias("on_time_count"),
    )
    return stats.withColumns(
        {_column(spec, f"p{p}"): F.get("_points", F.lit(i)) for i, p in enumerate(PERCENTS)}
    ).drop("_points")


def _counted(rows: DataFrame, spec: FactSpec) -> DataFrame:
    value = F.col(spec.measure)
    parts = []
    for name, source in spec.averages.items():
        parts += [F.sum(source).alias(f"_sum_{name}"), F.count(source).alias(f"_n_{name}")]
    counts = rows.groupBy(*spec.keys, spec.measure).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.expr(spec.on_time)).alias("_on_time"), *parts
    )
    group = W.partitionBy(*spec.keys)
    upto = group.orderBy(spec.measure).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = counts.withColumns(
        {
            "_upto": F.sum("_n").over(upto),
            "_all": F.sum("_n").over(group),
            "_sum": F.sum(value * F.col("_n")).over(group),
        }
    ).withColumn("_mean", F.col("_sum") / F.col("_all"))
    # Whole numbers on both sides keep the rank free of rounding.
    reached = {p: F.col("_upto") * 100 >= F.col("_all") * p for p in PERCENTS}
    trips = F.sum("_n")
    squares = F.sum(F.pow(value - F.col("_mean"), 2) * F.col("_n"))
    return ranked.groupBy(*spec.keys).agg(
        trips.alias("trip_count"),
        F.max("_mean").alias(_column(spec, "mean")),
        F.when(trips > 1, F.sqrt(squares / F.nullif(trips - 1, F.lit(0)))).alias(
            _column(spec, "stddev")
        ),
        *[
            (F.sum(f"_sum_{name}") / F.nullif(F.sum(f"_n_{name}"), F.lit(0))).alias(name)
            for name in spec.averages
        ],
        F.sum("_on_time").alias("on_time_count"),
        *[F.min(F.when(hit, value)).alias(_column(spec, f"p{p}")) for p, hit in reached.items()],
    )


# Values of a measure are whole seconds in 32 bits. A slot is named by the high bits, so a
# group has at most 2^20 slots and a slot at most 2^12 values. Sums of squares of the low bits
# fit a long for 5e11 rows of a slot.
_LOW_BITS = 12
_WIDE = "decimal(38,0)"


def _first_reaching(entries: Column, name: str, before: Column, total: Column, percent: int | Column) -> Column:
    """The first of the sorted ``entries`` (``name``, n) with which a share of ``total`` is reached.

    ``before`` counts what lies ahead of them. Returns a struct of the name and of the count
    ahead of that entry. Whole numbers on both sides keep the rank free of rounding.
    """
    start = F.struct(
        before.alias("upto"), F.lit(None).cast("int").alias("found"), F.lit(0).cast("long").alias("ahead")
    )

    def step(state: Column, entry: Column) -> Column:
        upto = state["upto"] + entry["n"]
        hit = state["found"].isNull() & (upto * 100 >= total * percent)
        return F.struct(
            upto.alias("upto"),
            F.when(hit, entry[name]).otherwise(state["found"]).alias("found"),
            F.when(hit, state["upto"]).otherwise(state["ahead"]).alias("ahead"),
        )

    return F.aggregate(entries, start, step)


def _ranked(rows: DataFrame, spec: FactSpec) -> DataFrame:
    """Exact statistics by rank selection in two levels, for groups with any number of values.

    Equal values are counted first. Counts by the high bits of the values say which slot
    holds each rank; only these slots are then looked into. Nothing gathers more of a group
    than its slots, or more of a slot than its values.
    """
    value, n = F.col(spec.measure), F.col("_n")
    parts, sums = [], []
    for name, source in spec.averages.items():
        parts += [F.sum(source).alias(f"_sum_{name}"), F.count(source).alias(f"_n_{name}")]
        sums += [F.sum(f"_{part}_{name}").alias(f"_{part}_{name}") for part in ("sum", "n")]
    counts = stored(
        rows.groupBy(*spec.keys, spec.measure).agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(F.expr(spec.on_time)).alias("_on_time"), *parts
        ),
        "counts",
    )
    slot = F.shiftright(value.cast("int"), _LOW_BITS).alias("_slot")
    low = F.col(spec.measure).bitwiseAND(F.lit((1 << _LOW_BITS) - 1)).cast("long")
    slots = counts.groupBy(*spec.keys, slot).agg(
        F.sum("_n").alias("_n"),
        F.sum("_on_time").alias("_on_time"),
        F.sum(low * n).alias("_low"),
        F.sum(low * low * n).alias("_low_squares"),
        *sums,
    )
    base, wide_n = (F.col("_slot") * F.lit(1 << _LOW_BITS).cast("long")).cast("decimal(10,0)"), n.cast("decimal(18,0)")
    wide_low = F.col("_low").cast("decimal(19,0)")
    squared = (base * base * wide_n).cast(_WIDE) + (base * wide_low * 2).cast(_WIDE) + F.col("_low_squares")
    entry = F.struct(F.col("_slot").alias("slot"), n.alias("n"))
    groups = slots.groupBy(*spec.keys).agg(
        F.sum("_n").alias("trip_count"),
        F.sum("_on_time").alias("on_time_count"),
        F.sum((base * wide_n + wide_low).cast(_WIDE)).cast(_WIDE).alias("_sum"),
        F.sum(squared.cast(_WIDE)).cast(_WIDE).alias("_squares"),
        *sums,
        F.sort_array(F.collect_list(entry)).alias("_slots"),
    )

    total = F.col("trip_count")
    places = [
        F.struct(F.lit(p).alias("_percent"), *(found[c].alias(f"_{c}") for c in ("found", "ahead")))
        for p in PERCENTS
        for found in [_first_reaching(F.col("_slots"), "slot", F.lit(0).cast("long"), total, p)]
    ]
    own = ["trip_count", "on_time_count", "_sum", "_squares"]
    own += [f"_{part}_{name}" for name in spec.averages for part in ("sum", "n")]
    wanted = groups.select(*spec.keys, *own, F.inline(F.array(*places)))
    others = {c: f"_of_{c}" for c in spec.keys}
    values = counts.select(
        *(F.col(c).alias(other) for c, other in others.items()), slot, value.cast("int").alias("_value"), "_n"
    )
    same = [F.col(c).eqNullSafe(F.col(other)) for c, other in others.items()]
    listed = (
        values.join(wanted, [F.col("_slot") == F.col("_found"), *same])
        .groupBy(*spec.keys, "_percent")
        .agg(
            F.sort_array(F.collect_list(F.struct(F.col("_value").alias("value"), n.alias("n")))).alias("_values"),
            *(F.first(c).alias(c) for c in ("_ahead", *own)),
        )
    )
    found = _first_reaching(F.col("_values"), "value", F.col("_ahead"), total, F.col("_percent"))["found"]
    kind = rows.schema[spec.measure].dataType
    stats = (
        listed.select(*spec.keys, *own, "_percent", found.cast(kind).alias("_value"))
        .groupBy(*spec.keys)
        .agg(
            *(F.first(c).alias(c) for c in own),
            *[
                F.max(F.when(F.col("_percent") == p, F.col("_value"))).alias(_column(spec, f"p{p}"))
                for p in PERCENTS
            ],
        )
    )

    # squares around the whole part of the mean are exact; the rest is below one second
    center = F.expr("CAST(_sum DIV trip_count AS DECIMAL(10,0))")
    squares = (
        F.col("_squares")
        - (center * F.col("_sum") * 2).cast(_WIDE)
        + (center * center * total.cast("decimal(18,0)")).cast(_WIDE)
    ).cast("double")
    mean = F.col("_sum").cast("double") / total
    off = (F.col("_sum") - (center * total.cast("decimal(18,0)")).cast(_WIDE)).cast("double")
    around = F.greatest(squares - off * off / total, F.lit(0.0))
    return stats.select(
        *spec.keys,
        "trip_count",
        mean.alias(_column(spec, "mean")),
        F.when(total > 1, F.sqrt(around / F.nullif(total - 1, F.lit(0)))).alias(_column(spec, "stddev")),
        *[
            (F.col(f"_sum_{name}") / F.nullif(F.col(f"_n_{name}"), F.lit(0))).alias(name)
            for name in spec.averages
        ],
        "on_time_count",
        *[_column(spec, f"p{p}") for p in PERCENTS],
    )


def with_scores(stats: DataFrame, spec: FactSpec) -> DataFrame:
    """Scores, volatility and labels from the trip statistics."""
    p50, p90, p95 = (F.col(_column(spec, f"p{p}")) for p in PERCENTS)
    rate = scoring.share(F.col("on_time_count"), F.col("trip_count"))
    scored = stats.withColumns(
        {
            "on_time_rate": rate,
            "on_time_score": rate * 100,
            "stability_score": scoring.stability_score(p50, p95, spec.signed),
            "transit_volatility_cv": scoring.volatility_cv(
                F.col(_column(spec, "stddev")), F.col(_column(spec, "mean")), spec.signed
            ),
            "percentile_spread_pct": scoring.percentile_spread_pct(p50, p90, spec.signed),
        }
    ).withColumn(
        "reliability_score",
        scoring.reliability_score(F.col("on_time_score"), F.col("stability_score")),
    )
    return scored.withColumns(
        {
            "reliability_category": scoring.reliability_category(F.col("reliability_score")),
            "volatility_category": scoring.volatility_category(F.col("transit_volatility_cv")),
            "confidence_level": scoring.confidence_level(
                F.col("trip_count"), spec.enough_trips, spec.firm_trips
            ),
            "recommended_buffer_min": scoring.minutes(p90),
            "transportation_mode": F.lit(spec.mode),
        }
    )


def _extra_minutes(spec: FactSpec) -> dict[str, Column]:
    if spec.stem != "duration":
        return {}
    return {
        "median_duration_min": scoring.minutes(F.col("p50_duration_sec")),
        "baseline_duration_min": scoring.minutes(F.col("avg_baseline_duration_sec")),
    }


def reliability_fact(
    performance: DataFrame,
    spec: FactSpec,
    percentiles: str = "exact",
    min_trips: int | None = None,
) -> DataFrame:
    """Scored groups that have at least ``min_trips`` trips."""
    least = spec.enough_trips if min_trips is None else min_trips
    stats = trip_statistics(performance, spec, percentiles).filter(F.col("trip_count") >= least)
    fact = with_scores(stats, spec).withColumns(_extra_minutes(spec))
    return fact.select(*_layout(spec))


def _layout(spec: FactSpec) -> list[str]:
    return [
        *spec.keys,
        "trip_count",
        *[_column(spec, s) for s in ("p50", "p90", "p95", "mean", "stddev")],
        *spec.averages,
        "on_time_count",
        "on_time_rate",
        "on_time_score",
        "stability_score",
        "reliability_score",
        "transit_volatility_cv",
        "percentile_spread_pct",
        "reliability_category",
        "volatility_category",
        "confidence_level",
        *(["median_duration_min"] if spec.stem == "duration" else []),
        "recommended_buffer_min",
        *(["baseline_duration_min"] if spec.stem == "duration" else []),
        "transportation_mode",
    ]
