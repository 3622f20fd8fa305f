from __future__ import annotations

from collections import Counter

from headway.operators import changes
from headway.operators.changes import change_feed

SCHEMA = "k int, v string"


def _feed(spark, old, new):
    df = change_feed(
        spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["k"]
    )
    return Counter((r.k, r.v, r._change_type) for r in df.collect())


def test_kinds_of_change(spark):
    old = [(1, "a"), (2, "b"), (3, "c"), (4, None), (None, "x")]
    new = [(1, "a"), (2, "B"), (4, "d"), (5, "e"), (None, "x")]
    assert _feed(spark, old, new) == Counter(
        {
            (2, "b", "update_preimage"): 1,
            (2, "B", "update_postimage"): 1,
            (3, "c", "delete"): 1,
            (4, None, "update_preimage"): 1,
            (4, "d", "update_postimage"): 1,
            (5, "e", "insert"): 1,
        }
    )


def test_repeated_rows_are_counted(spark):
    old = [(1, "a")] * 5 + [(2, "b")]
    new = [(1, "a")] * 2 + [(2, "b")] * 3
    assert _feed(spark, old, new) == Counter({(1, "a", "delete"): 3, (2, "b", "insert"): 2})


def test_many_copies_are_emitted_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(changes, "COPIES_PER_TASK", 4)
    old = [(1, "a")] * 3
    new = [(1, "a")] * 14 + [(2, "b")] * 8 + [(3, "c")] * 4
    assert _feed(spark, old, new) == Counter(
        {(1, "a", "insert"): 11, (2, "b", "insert"): 8, (3, "c", "insert"): 4}
    )


def test_no_change(spark):
    assert not _feed(spark, [(1, "a")], [(1, "a")])


def test_chunks_of_one_row_go_to_many_tasks(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(changes, "COPIES_PER_TASK", 100)
    old = spark.range(40).selectExpr("CAST(id AS int) AS k", "'v' AS v")
    copies = spark.range(101).selectExpr("id AS n")
    new = old.crossJoin(copies).select("k", F.lit("w").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = change_feed(old.limit(0), new, ["k"])
        loads = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(loads) == 40 * 101 and max(loads) < 0.6 * sum(loads)
