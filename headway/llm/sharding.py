"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` places. Each shard stands at ``VIRTUAL_NODES`` of them, given by a
hash of its number, and a document at one given by a hash of its id and text. A document
belongs to the first shard clockwise. No shard takes more than its bound; what overflows
continues clockwise to the first shard with room. Documents of a shard's own arcs go
before those that overflow from others, so another shard moves little.

With a slack of 0 the bounds add up to the number of documents, so all shards are full and
their counts differ by one at most: the law "rows". More slack moves fewer documents.

Only counts by cell reach the driver, which follows the overflow in whole cells and gives
each cell ranges of ranks. A cell with more than ``CHUNK_ROWS`` documents is cut into
chunks that are ranked alone, so copies of one document are no one task's work.

Defined results: a null text has no bytes; null ids are an id like any other; repeated rows
are placed each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm import common

CELLS = 1 << 16
VIRTUAL_NODES = 128
CHUNK_ROWS = 1_000_000


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the virtual nodes in clockwise order, and their shards."""
    nodes = sorted(
        (xxhash.xxh64_intdigest(f"shard {s} node {v}") % CELLS, xxhash.xxh64_intdigest(f"{s}/{v}"), s)
        for s in range(shards)
        for v in range(virtual_nodes)
    )
    return np.array([n[0] for n in nodes]), np.array([n[2] for n in nodes])


def bounds(total: int, shards: int, slack: float) -> list[int]:
    """How many documents each shard takes at most."""
    if slack > 0:
        return [int(np.ceil(total * (1 + slack) / shards))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def place_cells(
    counts: np.ndarray, shards: int, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES
) -> list[tuple[int, int, int, int, int]]:
    """Ranges (cell, first rank, end rank, shard, first slot) that hold every document once."""
    places, owners = ring(shards, virtual_nodes)
    room = bounds(int(counts.sum()), shards, slack)
    used = [0] * shards
    out: list[tuple[int, int, int, int, int]] = []
    left: list[tuple[int, int, int, int]] = []
    homes = np.searchsorted(places, np.arange(CELLS)) % len(places)

    def take(cell: int, first: int, n: int, shard: int) -> int:
        taken = min(n, room[shard] - used[shard])
        if taken:
            out.append((cell, first, first + taken, shard, used[shard]))
            used[shard] += taken
        return taken

    for cell in np.flatnonzero(counts).tolist():
        n, home = int(counts[cell]), int(homes[cell])
        taken = take(cell, 0, n, int(owners[home]))
        if taken < n:
            left.append((cell, taken, n - taken, home))
    for cell, first, n, home in left:
        node = home
        while n:
            node = (node + 1) % len(places)
            taken = take(cell, first, n, int(owners[node]))
            first, n = first + taken, n - taken
    return out


def sharded(docs: DataFrame, shards: int = 16, slack: float = 0.0) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot and grown_shard."""
    spark = docs.sparkSession
    text = common.empty_as("text")
    key = F.xxhash64("doc_id", text)
    rows = common.stored(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.pmod(key, F.lit(CELLS)).cast("int").alias("cell"),
            F.xxhash64(key, F.monotonically_increasing_id()).alias("mark"),
        ),
        "placed",
    )
    by_cell = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    found = by_cell.toArrow()  # at most one row per cell
    counts = np.zeros(CELLS, dtype=np.int64)
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    plan = spark.createDataFrame(
        place_cells(counts, shards, slack),
        "at_cell int, first long, end long, shard int, first_slot long",
    )
    # at most a row per cell, with the number of chunks of the crowded ones
    hot = [(int(c), int(-(-counts[c] // CHUNK_ROWS))) for c in np.flatnonzero(counts > CHUNK_ROWS)]
    chunk = F.lit(0).cast("long")
    if hot:
        rows = rows.join(F.broadcast(spark.createDataFrame(hot, "cell int, chunks long")), "cell", "left")
        chunk = F.pmod("mark", F.coalesce("chunks", F.lit(1).cast("long")))
    rows = rows.withColumn("chunk", chunk)
    in_chunk = Window.partitionBy("cell", "chunk").orderBy("mark")
    before = Window.partitionBy("cell").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("rank", F.row_number().over(in_chunk) - F.lit(1).cast("long"))
    if hot:
        offsets = (
            rows.groupBy("cell", "chunk")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("cell", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
        )
        ranked = ranked.join(offsets, ["cell", "chunk"]).withColumn("rank", F.col("rank") + F.col("ahead"))
    # a range for each cell and, beyond, one for each time that a shard fills up
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    placed = ranked.join(F.broadcast(plan), (F.col("cell") == F.col("at_cell")) & inside)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("first_slot") + F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
