"""Helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.session import stored  # noqa: F401 - the operators take it from here

#: Rows handed to a Python worker at once. Texts are long, so far fewer than Spark's default.
BATCH_ROWS = 500
#: Applications whose workers have the package.
_SENT: set[str] = set()


def documents(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the rows that a Python worker holds at once, and send the package to the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        package = Path(__file__).resolve().parents[1]
        # Spark's file server serves the archive from here for as long as the application runs.
        archive = f"{tempfile.mkdtemp(prefix='headway-')}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(archive)
        _SENT.add(context.applicationId)


def sampled(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """At most ``rows`` rows, those with the least hashes of ``keys``, the same in every run.

    A share of the hashes is taken before anything moves, so what is sorted does not grow
    with the table.
    """
    share = min(1.0, 1.1 * rows / max(df.count(), 1))
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 30))
    return df.filter(place < int(share * (1 << 30)) + 1).orderBy(place, *keys).limit(rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not use yet, in any case."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def raw_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null gives no bytes."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def plain_texts(column: pa.Array) -> list[str]:
    """The texts of a string column; null gives the empty text."""
    return [b.decode("utf-8", "replace") for b in raw_texts(column)]


def appended(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with further columns behind its own."""
    arrays = [*batch.columns, *columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *columns])


def add_columns(df: DataFrame, added: str, work) -> DataFrame:
    """``df`` with the columns of the schema text ``added``, which ``work`` makes of a batch.

    ``work`` maps a record batch to a dictionary of arrays, in the order of ``added``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield appended(batch, work(batch))

    return df.mapInArrow(run, with_fields(df, added))


def with_fields(df: DataFrame, added: str) -> T.StructType:
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(added)])


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each key, for sorted rows whose first ``keys`` columns are the key.

    Runs that go over the end of a batch are put together again.
    """
    import numpy as np

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = np.zeros(batch.num_rows, dtype=bool)
        for k in range(keys):
            values = batch.column(k).to_numpy(zero_copy_only=False)
            cuts[1:] |= values[1:] != values[:-1]
        if waiting:
            last = waiting[-1]
            cuts[0] = any(
                batch.column(k)[0] != last.column(k)[last.num_rows - 1] for k in range(keys)
            )
        starts = np.flatnonzero(cuts).tolist()
        at = 0
        for start in starts:
            if start > at:
                waiting.append(batch.slice(at, start - at))
            if waiting:
                yield pa.Table.from_batches(waiting)
            waiting, at = [], start
        waiting.append(batch.slice(at))
    if waiting:
        yield pa.Table.from_batches(waiting)


def empty_as(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The connected components of undirected ``links``: rows (node, root), root the least node.

    Large-star and small-star steps alternate until nothing changes; the rounds grow with
    the logarithm of the nodes. Each round is stored in the shared folder. Nodes without
    links are not returned; loops, repeated links and empty tables are allowed.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u <> v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbours and itself."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    )
    least = both.groupBy("x").agg(F.min("y").alias("m"))
    return (
        both.filter("y > x")
        .join(least, "x")
        .select(F.col("y").alias("u"), F.least("m", "x").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.filter("u <> v").unionByName(
        least.select("u", F.col("m").alias("v"))
    ).distinct()
