"""Helpers that turn a list of rules into one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule whose condition is true, else ``default``."""
    chain = None
    for condition, value in rules:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return F.lit(default) if chain is None else chain.otherwise(default)


def at_least(value: Column, floors: Iterable[tuple[float, str]], default: str) -> Column:
    """Label of the first floor that ``value`` reaches; floors run from high to low."""
    return first_match(((value >= floor, label) for floor, label in floors), default)


def below(value: Column, ceilings: Iterable[tuple[float, str]], default: str) -> Column:
    """Label of the first ceiling that ``value`` stays under; ceilings run from low to high."""
    return first_match(((value < ceiling, label) for ceiling, label in ceilings), default)
