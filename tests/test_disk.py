"""What runs leave on disk besides their tables."""

from __future__ import annotations

import glob
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from headway.plans import maintenance, reports
from headway.plans.maintenance import Layout
from headway.session import freed_shuffles, stored
from headway.sinks import tables as sink
from headway.sources import files
from headway.streaming import feeds as streams

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffled(spark):
    """Shuffle files that are there now."""
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that are new and stay; Spark removes files in the background."""
    for _ in range(50):
        left = _shuffled(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def _rows(spark, n=2000):
    return spark.range(n).select("id", F.concat(F.lit("d"), F.col("id") % 5).alias("at"))


def test_shuffles_go_with_their_execution(spark):
    before = _shuffled(spark)
    setting = spark.conf.get(_CLEANUP, None)
    with freed_shuffles(spark):
        kept = _rows(spark).groupBy("at").agg(F.sum("id").alias("s"))
        first = sorted(kept.collect())
        assert not _left(spark, before)
        assert sorted(kept.collect()) == first  # a second execution writes its shuffle again
    assert spark.conf.get(_CLEANUP, None) == setting


def test_streams_and_landings_leave_no_shuffles(spark, tmp_path):
    source = str(tmp_path / "source")
    _rows(spark).write.parquet(source)
    before = _shuffled(spark)
    store = streams.Store(str(tmp_path / "store"))
    arriving = files.increments(spark, source)
    streams.finish(streams.append_dataset(arriving, store, "t", (), ("at",)))
    spread = lambda: spark.read.parquet(source).repartition(3, "id")
    reports.land_sources(spark, {"x": ("x", spread)}, str(tmp_path / "landing"), "2024-01-01")
    assert not _left(spark, before)
    assert files.snapshot(spark, store.table("t")).count() == 2000


def test_stored_tables_are_packed(spark, tmp_path):
    rows = _rows(spark)
    sink.write_table(rows, str(tmp_path / "table"))
    source = stored(rows, "packed").inputFiles()[0].removeprefix("file://")
    store = streams.Store(str(tmp_path / "store"))
    arriving = files.increments(spark, str(tmp_path / "table"))
    streams.finish(streams.append_dataset(arriving, store, "t", (), ("at",)))
    maintenance.maintain(spark, store, Layout("t", "at", ("id",)), rows.schema)
    written = [source]
    for folder in ("table", "store/tables/t", "store/maintained/t"):
        found = glob.glob(f"{tmp_path}/{folder}/**/*.parquet", recursive=True)
        assert found
        written.append(found[0])
    for name in written:
        assert pq.ParquetFile(name).metadata.row_group(0).column(0).compression == "ZSTD"


def test_rows_are_not_shuffled_to_their_days(spark):
    """Neither the days of a step nor the ledger may make the rows of a table move."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = _rows(spark, 2).select(F.col("at").alias("day"))
        kept = maintenance._on_days(_rows(spark), Layout("t", "at", ()), days)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 800
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_backlog_is_cut_into_batches_that_a_disk_holds(spark, tmp_path):
    """A micro-batch shuffles its rows twice and keeps the files until it ends: a few GB at most."""
    assert files.BYTES_PER_BATCH <= 2 * 2**30 and files.LANDED_BYTES_PER_BATCH <= 4 * 2**30
    source = str(tmp_path / "source")
    _rows(spark).repartition(4).write.parquet(source)
    store = streams.Store(str(tmp_path / "store"))
    arriving = files.increments(spark, source, bytes_per_batch=1)
    query = streams.append_dataset(arriving, store, "t", (), ("at",))
    streams.finish(query)
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 4
    found = files.snapshot(spark, store.table("t")).agg(F.count("id"), F.sum("id")).first()
    assert tuple(found) == (2000, 2000 * 1999 // 2)
