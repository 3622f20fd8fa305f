"""Stored tables, landing files and streaming sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions.keys import row_hash
from headway.session import TABLE_CODEC, freed_shuffles, has_rows
from headway.streaming.counts import KEPT_REPORTS


_REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
# Files that a micro-batch writes to one partition at most, unless a run asks for others.
SLOTS = 8
# Landed lines repeat every field name: packed they take a tenth of the disk. A packed file is
# read by one task, so no file gets more lines than this.
LINES_PER_FILE = 500_000
_PACKED = {
    "compression": "gzip",
    "zlib.compress.level": "SIX",
    "maxRecordsPerFile": LINES_PER_FILE,
}


def clustered(
    df: DataFrame, cluster_by: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Range-partition and sort so that files hold narrow ranges of the columns.

    A hash of the row is the last range column: it lets one value that holds
    many rows spread over several ranges.
    """
    lead = list(dict.fromkeys([*partition_by, *cluster_by]))
    return df.repartitionByRange(*lead, row_hash(df)).sortWithinPartitions(*lead)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    only_touched_partitions: bool = False,
) -> str:
    """Store a dataset as Parquet, optionally replacing only the partitions it has.

    Rows are either clustered or brought together by partition, so that tasks
    do not each write a file for every partition. AQE sizes the latter: it
    splits a partition value that holds many rows and merges small ones.
    """
    if cluster_by:
        df = clustered(df, cluster_by, partition_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if only_touched_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path, compression=TABLE_CODEC)
    return path


def write_lines(df: DataFrame, path: str, mode: str = "append") -> str:
    """Write rows as packed JSON lines, in files that one task can read each."""
    df.write.mode(mode).options(**_PACKED).json(path)
    return path


def land(df: DataFrame, landing: str, folder: str, day: str) -> str | None:
    """Append rows as JSON lines to a dated folder; no rows, no folder."""
    return land_counted(df, landing, folder, day)[0]


def land_counted(df: DataFrame, landing: str, folder: str, day: str) -> tuple[str | None, int]:
    """As ``land``, with the number of rows, which is counted while they are written."""
    if not has_rows(df):
        return None, 0
    path = f"{landing}/{folder}/{day}"
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("records"))
    write_lines(counted, path)
    return path, written.get["records"]


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    slots: int | None = None,
) -> StreamingQuery:
    """Append everything that is available now to a stored table, then stop.

    Rows of a partitioned table are shuffled by partition and slot, so that a micro-batch
    writes at most ``slots`` files to each partition instead of one from every task. A
    backlog with very large partitions asks for more slots. The shuffle of a micro-batch is
    removed with it.
    """
    if partition_by:
        df = df.repartition(*partition_by, F.pmod(row_hash(df), F.lit(slots or SLOTS)))
    writer = df.writeStream.format("parquet").option("compression", TABLE_CODEC).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # the reports of micro-batches carry the rule counts; a query takes this number as it starts
    conf = df.sparkSession.conf
    kept = conf.get(_REPORTS)
    conf.set(_REPORTS, max(int(kept), KEPT_REPORTS))
    try:
        with freed_shuffles(df.sparkSession):
            return (
                writer.option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start(path)
            )
    finally:
        conf.set(_REPORTS, kept)
