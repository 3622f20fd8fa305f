"""Payload files to landed rows: every file once, damaged ones set aside, sources alone.

A run lists the payload files of a source, plans those it has not planned before in
numbered batches, and lands one batch after the other into a folder of its own. A batch
that is planned but not recorded as landed is done again into the same folder, so a run
that failed half-way neither loses files nor lands them twice. Plans are tables; of a batch,
the driver holds the paths of at most ``FILES_PER_BATCH`` files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway import feeds
from headway.feeds import Feed
from headway.plans.daily import RunResult, run_daily
from headway.session import frees_shuffles, has_rows, stored
from headway.sinks.tables import write_lines
from headway.sources import payloads as pay

FILES_PER_BATCH = 100_000
# Spark looks at given paths in a job with a task per path; a path takes less than a task.
LISTING_TASKS = 200
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Characters of a damaged document that are kept with its path.
SHOWN = 200
PLAN = "path string, modified timestamp, day string, batch int"
LANDED = "batch int, records long, damaged long"
REPORT = "source string, records long, damaged long, paths array<string>, error string"


@dataclass(frozen=True)
class PayloadJob:
    """How the documents of a source become rows of its feed."""

    feed: Feed
    schema: str
    flatten: Callable[[DataFrame], DataFrame]
    #: Whether a file holds a document per line instead of one document.
    lines: bool = False


def payload_jobs(routes: DataFrame | None = None, driving_lines: bool = False) -> dict[str, PayloadJob]:
    """The four sources. With ``routes``, directions of other routes are left out."""

    def directions(documents: DataFrame) -> DataFrame:
        if routes is not None:
            names = routes.select(F.col("name").alias("_name"))
            documents = documents.join(names, F.col("route.name") == F.col("_name"), "left_semi")
        return pay.flatten_directions(documents)

    return {
        "mbta_predictions": PayloadJob(
            feeds.PREDICTIONS, pay.PREDICTION_PAYLOAD, pay.flatten_predictions
        ),
        "mbta_schedules": PayloadJob(feeds.SCHEDULES, pay.SCHEDULE_PAYLOAD, pay.flatten_schedules),
        "noaa": PayloadJob(feeds.WEATHER, pay.WEATHER_PAYLOAD, pay.flatten_weather),
        "driving": PayloadJob(feeds.DRIVING, pay.DIRECTIONS_PAYLOAD, directions, driving_lines),
    }


def _or_none(spark: SparkSession, schema: str, read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def payload_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths and times of the files of a source; their content is not read.

    Spark passes over files without a byte, so such a file waits until it has some.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = _or_none(
        spark, "path string, modificationTime timestamp", lambda: reader.load(folder)
    )
    return files.select("path", F.col("modificationTime").alias("modified"))


def documents(spark: SparkSession, paths: Sequence[str], schema: str, lines: bool) -> DataFrame:
    """Parsed documents: path, execution_date, shown, doc; ``doc`` is null where damaged."""
    tasks = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, min(int(tasks), LISTING_TASKS))
    try:
        text = spark.read.text(list(paths), wholetext=not lines)
    finally:
        spark.conf.set(_LISTING, tasks)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = F.from_json("value", f"{schema}, _broken string", options)
    path = F.col("_metadata.file_path")
    return (
        text.withColumns({"path": path, "parsed": parsed})
        .filter(~(F.lit(lines) & (F.trim("value") == "")))
        .select(
            "path",
            pay.day_of(F.col("path")).alias("execution_date"),
            F.substring("value", 1, SHOWN).alias("shown"),
            F.when(F.col("parsed._broken").isNull(), F.col("parsed")).alias("doc"),
        )
    )


def _counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    if not has_rows(rows):
        return 0
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


@dataclass(frozen=True)
class _Source:
    spark: SparkSession
    job: PayloadJob
    folder: str
    landing: str
    progress: str

    def plans(self) -> DataFrame:
        read = self.spark.read.schema(PLAN).parquet
        return _or_none(self.spark, PLAN, lambda: read(f"{self.progress}/plans"))

    def landed(self) -> DataFrame:
        read = self.spark.read.schema(LANDED).json
        return _or_none(self.spark, LANDED, lambda: read(f"{self.progress}/landed"))

    def plan(self, day: str) -> None:
        """Give the files that are in no plan yet to new batches."""
        known = self.plans()
        new = payload_files(self.spark, self.folder).join(known, ["path", "modified"], "left_anti")
        n = new.count()
        if n:
            first = (known.agg(F.max("batch")).first()[0] or 0) + 1
            batch = F.pmod(F.xxhash64("path"), F.lit(-(-n // FILES_PER_BATCH))) + first
            planned = new.withColumns({"day": F.lit(day), "batch": batch.cast("int")})
            planned.write.mode("append").parquet(f"{self.progress}/plans")

    def waiting(self) -> list[tuple[int, str]]:
        batches = self.plans().select("batch", "day").distinct().join(self.landed(), "batch", "left_anti")
        return sorted((r.batch, r.day) for r in batches.collect())

    def land(self, batch: int, day: str) -> tuple[int, int, str | None]:
        """Rows landed, documents set aside and the folder of a batch."""
        planned = self.plans().filter(F.col("batch") == batch)
        paths = [r.path for r in planned.select("path").collect()]
        docs = stored(documents(self.spark, paths, self.job.schema, self.job.lines), "documents")
        whole = docs.filter("doc IS NOT NULL").select("doc.*", "execution_date").drop("_broken")
        target = f"{self.landing}/{self.job.feed.folder}/{day}/batch-{batch}"
        records = _counted(
            self.job.flatten(whole), lambda rows: write_lines(rows, target, "overwrite")
        )
        aside = docs.filter("doc IS NULL").select("path", "shown")
        damaged = _counted(
            aside,
            lambda rows: rows.write.mode("overwrite").json(f"{self.progress}/damaged/batch={batch}"),
        )
        done = self.spark.createDataFrame([(batch, records, damaged)], LANDED)
        done.coalesce(1).write.mode("append").json(f"{self.progress}/landed")
        return records, damaged, target if records else None


@frees_shuffles
def land_payloads(
    spark: SparkSession,
    folders: Mapping[str, str],
    landing: str,
    progress: str,
    day: str,
    jobs: Mapping[str, PayloadJob] | None = None,
    sources: Sequence[str] | None = None,
) -> DataFrame:
    """Land what is new in the payload folders; a source that fails does not stop the others.

    ``folders`` maps sources to their payload files. No choice of ``sources`` means all;
    unknown names are ignored. The report has one row per source.
    """
    jobs = payload_jobs() if jobs is None else jobs
    lines = []
    for name in sources or list(folders):
        if name not in folders or name not in jobs:
            continue
        source = _Source(spark, jobs[name], folders[name], landing, f"{progress}/{name}")
        records = damaged = 0
        paths: list[str] = []
        error = None
        try:
            source.plan(day)
            for batch, planned_for in source.waiting():
                rows, broken, path = source.land(batch, planned_for)
                records, damaged = records + rows, damaged + broken
                paths += [path] if path else []
        except Exception as problem:  # noqa: BLE001 - reported per source
            error = str(problem)
        lines.append((name, records, damaged, paths, error))
    return spark.createDataFrame(lines, REPORT)


def damaged_documents(spark: SparkSession, progress: str, source: str) -> DataFrame:
    """Paths and beginnings of all documents of a source that were set aside."""
    schema = "path string, shown string, batch int"
    read = spark.read.schema(schema).json
    return _or_none(spark, schema, lambda: read(f"{progress}/{source}/damaged"))


def run_daily_from_payloads(
    spark: SparkSession,
    folders: Mapping[str, str],
    landing: str,
    root: str,
    day: str,
    jobs: Mapping[str, PayloadJob] | None = None,
    **options: object,
) -> tuple[DataFrame, RunResult]:
    """Payload files to facts: the landing report and the result of the run."""
    report = land_payloads(spark, folders, landing, f"{root}/payloads", day, jobs)
    return report, run_daily(spark, landing, root, day, **options)
