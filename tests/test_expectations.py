from __future__ import annotations

import pytest
from pyspark.sql import Observation

from headway.operators import expectations as ex

RULES = (
    ex.Expectation("positive", "x > 0", "drop"),
    ex.Expectation("small", "x < 10"),
)


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(1,), (20,), (-3,), (None,)], "x int")


def test_null_counts_as_violation(numbers):
    report = {r.expectation: r for r in ex.violations(numbers, "numbers", RULES).collect()}
    assert report["positive"].failed_rows == 2
    assert report["small"].failed_rows == 2
    assert {r.total_rows for r in report.values()} == {4}


def test_drop_removes_and_warn_keeps(numbers):
    assert sorted(r.x for r in ex.keep_valid(numbers, RULES).collect()) == [1, 20]


def test_counts_while_writing(numbers):
    seen = Observation("seen")
    assert ex.counted(numbers, RULES, seen).count() == 2
    assert seen.get == {"rows": 4, "positive": 2, "small": 2}


def test_quarantine_names_broken_rules(numbers):
    accepted, rejected = ex.quarantine(numbers, RULES)
    assert [r.x for r in accepted.collect()] == [1]
    assert {r.x: r.broken_rules for r in rejected.collect()} == {
        20: ["small"], -3: ["positive"], None: ["positive", "small"],
    }


def test_summary(numbers):
    report = ex.violations(numbers.filter("x > 0"), "numbers", RULES)
    found = {r.test_name: r.passed for r in ex.summary(report).collect()}
    assert found == {"numbers.positive": True, "numbers.small": False}


def test_unknown_action():
    with pytest.raises(ValueError, match="action"):
        ex.Expectation("a", "true", "fail")
