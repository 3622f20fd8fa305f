"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stored tables hold many keys and times that hardly repeat, which Spark's default codec leaves as they are.
TABLE_CODEC = "zstd"
# Spark removes the shuffle files of an execution when it has ended; else they stay until the
# driver's garbage collector finds them unused.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Apply the settings the datasets rely on to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go with the execution that wrote them, also those of streams started.

    A frame that is executed a second time writes its shuffles again, so this is for steps that
    execute each frame once. The session's own setting is put back.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def frees_shuffles(step: Callable[..., Any]) -> Callable[..., Any]:
    """A step whose first argument is the session and that runs inside ``freed_shuffles``."""

    @functools.wraps(step)
    def run(spark: SparkSession, *args: Any, **options: Any) -> Any:
        with freed_shuffles(spark):
            return step(spark, *args, **options)

    return run


def has_rows(df: DataFrame) -> bool:
    """Whether there is a row; ``isEmpty`` would leave its shuffles inside ``freed_shuffles``."""
    return bool(df.select(F.lit(1)).take(1))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would each see a different one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="headway-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from its files.

    For results that are read more than once: readers take the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=TABLE_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from there."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
