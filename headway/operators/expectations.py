"""Named data-quality rules on a dataset.

A rule is a SQL predicate. ``warn`` keeps violating rows and counts them,
``drop`` removes them as well. A predicate that is NULL counts as violated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ("warn", "drop"):
            raise ValueError(f"{self.name}: action must be warn or drop, not {self.action}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def keep_valid(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Remove the rows that violate a ``drop`` rule."""
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.holds())
    return df


def counted(df: DataFrame, rules: Sequence[Expectation], observation: object) -> DataFrame:
    """Count the violations while rows flow to a sink, then drop what must go.

    ``observation`` is a name (streams) or an ``Observation`` (batch).
    """
    if not rules:
        return df
    return keep_valid(df.observe(observation, *_counts(rules)), rules)


def violations(df: DataFrame, dataset: str, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule with the rows seen and failed, from a single pass."""
    totals = df.agg(*_counts(rules))
    lines = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(rule.name).alias("expectation"),
            F.lit(rule.action).alias("action"),
            F.col("rows").alias("total_rows"),
            F.col(rule.name).alias("failed_rows"),
        )
        for rule in rules
    ]
    return totals.select(F.inline(F.array(*lines)))


def quarantine(df: DataFrame, rules: Sequence[Expectation]) -> tuple[DataFrame, DataFrame]:
    """Split into accepted rows and rejected rows with the names of broken rules."""
    broken = F.filter(
        F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]),
        lambda name: name.isNotNull(),
    )
    checked = df.withColumn("broken_rules", broken)
    passed = F.size("broken_rules") == 0
    return checked.filter(passed).drop("broken_rules"), checked.filter(~passed)


def summary(report: DataFrame) -> DataFrame:
    """Pass or fail per rule of a violation report."""
    return report.select(
        F.concat_ws(".", "dataset", "expectation").alias("test_name"),
        (F.col("failed_rows") == 0).alias("passed"),
    )


def _counts(rules: Sequence[Expectation]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(~rule.holds()).alias(rule.name) for rule in rules),
    ]
