"""Raw feed files and stored tables, as batches and as streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.feeds import Feed
from headway.functions.clock import parse_date, parse_timestamp

# Keeps one micro-batch of a long backlog to a few GB of shuffle: the files of a shuffle stay
# until its micro-batch has ended. A row takes about twice the bytes as a landed packed line.
BYTES_PER_BATCH = 2**30
LANDED_BYTES_PER_BATCH = 2 * BYTES_PER_BATCH
# Spark's own default skips files more than seven days older than the newest one read. Late
# and restored files must not be lost, so by default none is too old. A shorter age bounds
# the names of files seen that the driver keeps, at the price of such files.
NO_FILE_TOO_OLD = "36500d"


def _absent(problem: AnalysisException) -> bool:
    return problem.getCondition() == "PATH_NOT_FOUND"


def typed(df: DataFrame, feed: Feed) -> DataFrame:
    """Parse the text times of a feed and stamp the ingest clock."""
    times = {name: parse_timestamp(F.col(name)) for name in feed.timestamps}
    days = {name: parse_date(F.col(name)) for name in feed.dates}
    return df.withColumns({**times, **days, "_ingested_at": F.current_timestamp()})


def raw_batch(spark: SparkSession, feed: Feed, landing: str) -> DataFrame:
    """Every landed file of a feed, with the feed's fixed schema; none if nothing has landed."""
    reader = spark.read.schema(feed.schema).option("recursiveFileLookup", "true")
    try:
        rows = reader.json(f"{landing}/{feed.folder}")
    except AnalysisException as problem:
        if not _absent(problem):
            raise
        rows = spark.createDataFrame([], feed.schema)
    return typed(rows, feed)


def raw_stream(
    spark: SparkSession,
    feed: Feed,
    landing: str,
    bytes_per_batch: int = LANDED_BYTES_PER_BATCH,
    max_file_age: str = NO_FILE_TOO_OLD,
) -> DataFrame:
    """Landed files of a feed as they arrive; each is read once per checkpoint.

    The folder is named by a pattern, because Spark lets a pattern match nothing yet.
    """
    reader = (
        spark.readStream.schema(feed.schema)
        .option("recursiveFileLookup", "true")
        .option("maxBytesPerTrigger", bytes_per_batch)
        .option("maxFileAge", max_file_age)
    )
    return typed(reader.json(f"{landing}/{feed.folder[:-1]}[{feed.folder[-1]}]"), feed)


def typed_schema(spark: SparkSession, feed: Feed) -> T.StructType:
    return typed(spark.createDataFrame([], feed.schema), feed).schema


def snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole stored table. With a schema, a table without rows or files is read too."""
    if schema is None:
        return spark.read.parquet(path)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if not _absent(problem):
            raise
        return spark.createDataFrame([], schema)


def increments(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    bytes_per_batch: int = BYTES_PER_BATCH,
    max_file_age: str = NO_FILE_TOO_OLD,
    **options: str,
) -> DataFrame:
    """The rows added to a stored table since the reader's checkpoint."""
    schema = spark.read.options(**options).parquet(path).schema if schema is None else schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch)
    return reader.option("maxFileAge", max_file_age).options(**options).parquet(path)
