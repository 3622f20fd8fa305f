"""SimHash fingerprints and exact search for near fingerprints, tile against tile.

A fingerprint has 64 bits. Every word shingle is hashed, and a bit is 1 if it is set in
over half of the hashes. Fingerprints that differ in few bits are linked, and links make
components.

Fingerprints are compared in blocks. Two fingerprints within a radius of r bits agree in
at least one of r + 1 ranges of bits, so a block for each range and value loses no link.
Inside a block, rows are cut into tiles of similar population count; tiles whose counts
differ by more than the radius cannot hold a link and never meet. Each pair of tiles is a
group of its own, compared with exclusive-or and bit counts on whole arrays. What leaves
it is a spanning forest of the links, never all pairs.

Defined results: a null text counts as empty; texts without words have fingerprint zero
and are linked like any other; fewer words than a shingle count as one shingle; null ids
are kept and never name a component that has another id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import common

SEED = 42
#: Rows of a tile: two tiles of 8-byte fingerprints and their comparison fit a worker's cache.
TILE = 2048
#: Hashes whose bits are counted at once, to bound memory for very long texts.
AT_ONCE = 1 << 16


def normal_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every shingle of ``size`` words; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends[:-size]]
    hashed = xxhash.xxh64_intdigest
    return np.array(
        [hashed(line[s : e - 1], SEED) for s, e in zip(starts, ends[size - 1 :])],
        dtype=np.uint64,
    )


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of ``hashes``; zero for none."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        part = hashes[at : at + AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def signed(values: Iterable[int]) -> np.ndarray:
    return np.array(list(values), dtype=np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, text: str = "text", size: int = 3, name: str = "fingerprint"):
    """``docs`` with a column of fingerprints, as the signed view of 64 bits."""
    place = docs.columns.index(text)

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = common.raw_texts(batch.column(place))
        found = signed(majority(shingle_hashes(normal_words(t), size)) for t in texts)
        return {name: pa.array(found)}

    return common.add_columns(docs, f"`{name}` long", work)


def bit_ranges(fingerprint: Column, radius: int) -> Column:
    """Block keys: one of ``radius + 1`` ranges of bits is equal for linked fingerprints."""
    edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("part"),
                F.shiftrightunsigned(fingerprint, low)
                .bitwiseAND(F.lit((1 << (high - low)) - 1 if high - low < 64 else -1))
                .alias("value"),
            )
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        )
    )


def _band(radius: int) -> Column:
    """Population counts in bands of ``radius + 1``: within the radius, bands differ by one at most."""
    return F.floor(F.bit_count("fp") / (radius + 1)).cast("int")


def cells(rows: DataFrame, ones: Column, tile: int = TILE) -> DataFrame:
    """Deal rows (node, part, value, ...) to the pairs of tiles in which they are compared.

    A block of at most ``tile`` rows is one tile. A larger one is cut
    by the bands ``ones`` and, within a band, by a hash of the node; a row goes to each pair
    of its own tile and a tile of its band or one beside it, so no pair is missed whose
    bands differ by one at most. Returns the rows with ``t1`` and ``t2``, the two tiles, and ``side``: 0 if the
    row is of tile t1, else 1.
    """
    counted = (
        rows.withColumn("ones", ones)
        .groupBy("part", "value", "ones")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    large = (
        counted.groupBy("part", "value")
        .agg(
            F.sum("n").alias("total"),
            # at most an entry for each of 65 population counts
            F.map_from_entries(
                F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int")))
            ).alias("tiles"),
        )
        .filter("total > 1")
        .select("part", "value", F.when(F.col("total") > tile, F.col("tiles")).alias("tiles"))
    )

    def tile_name(count: Column, slot: Column) -> Column:
        return (count * F.lit(1 << 20) + slot).cast("long")

    own_slots = F.element_at("tiles", ones)
    own = tile_name(ones, F.pmod(F.xxhash64("node"), own_slots).cast("int"))
    others = F.flatten(
        F.transform(
            F.filter(
                F.sequence(ones - 1, ones + 1),
                lambda c: F.map_contains_key("tiles", c),
            ),
            lambda c: F.transform(
                F.sequence(F.lit(0), F.element_at("tiles", c) - 1), lambda s: tile_name(c, s)
            ),
        )
    )
    pairs = F.transform(
        others,
        lambda t: F.struct(
            F.least(own, t).alias("t1"),
            F.greatest(own, t).alias("t2"),
            F.when(own <= t, 0).otherwise(1).alias("side"),
        ),
    )
    zero = F.lit(0).cast("long")
    whole = F.array(F.struct(zero.alias("t1"), zero.alias("t2"), F.lit(0).alias("side")))
    rest = [c for c in rows.columns if c not in ("part", "value")]
    return (
        rows.join(large, ["part", "value"])
        .withColumn("cell", F.explode(F.when(F.col("tiles").isNull(), whole).otherwise(pairs)))
        .drop("tiles")
        .select("part", "value", "cell.t1", "cell.t2", "cell.side", *rest)
    )


class Forest:
    """Union-find over the rows of one comparison."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def near_rows(fp: np.ndarray, side: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows within the radius, band by band; of both tiles if there are two."""
    ones = np.bitwise_count(fp).astype(np.int64)
    order = np.argsort(ones, kind="stable")
    fp, ones, side = fp[order], ones[order], side[order]
    two = bool(side.any()) and not side.all()
    step = 256
    for at in range(0, len(fp), step):
        upto = min(at + step, len(fp))
        far = np.searchsorted(ones, ones[upto - 1] + radius, side="right")
        close = np.bitwise_count(fp[at:upto, None] ^ fp[None, at:far]) <= radius
        if two:
            close &= side[at:upto, None] != side[None, at:far]
        i, j = np.nonzero(close)
        later = j > i
        yield order[i[later] + at], order[j[later] + at]


def linked(rows: DataFrame, radius: int) -> DataFrame:
    """A spanning forest of the links in every cell: rows (a, b) of nodes."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in common.runs(batches, 4):
            if cell.num_rows < 2:
                continue
            node = cell.column("node").to_numpy()
            fp = cell.column("fp").to_numpy().view(np.uint64)
            forest, a, b = Forest(len(fp)), [], []
            for i, j in near_rows(fp, cell.column("side").to_numpy(), radius):
                for x, y in zip(i.tolist(), j.tolist()):
                    if forest.join(x, y):
                        a.append(node[x])
                        b.append(node[y])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
                )

    keys = ["part", "value", "t1", "t2"]
    dealt = rows.select(*keys, "side", "node", "fp").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, "a long, b long")


def near_fingerprints(distinct: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) whose components are those of all fingerprints within ``radius`` bits.

    ``distinct`` has one row for each fingerprint, in column ``fp``.
    """
    rows = distinct.select(
        F.col("fp").alias("node"), "fp", F.explode(bit_ranges(F.col("fp"), radius)).alias("block")
    ).select("node", "fp", "block.part", "block.value")
    return linked(cells(rows, _band(radius), tile), radius)


def near_dedup(docs: DataFrame, size: int = 3, radius: int = 2, tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, component_size.

    ``component_id`` is the least doc_id of the documents reachable over links. Equal
    fingerprints are one node, so copies add no links. Empty tables give no rows.
    """
    common.prepare(docs.sparkSession)
    rows = common.stored(
        fingerprints(docs.select("doc_id", "text"), "text", size, "fp").select("doc_id", "fp"),
        "fingerprints",
    )
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    distinct = common.stored(distinct, "distinct")
    roots = common.components(near_fingerprints(distinct.select("fp"), radius, tile))
    grouped = (
        distinct.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    )
    classes = grouped.groupBy("root").agg(
        F.min("least").alias("component_id"), F.sum("n").alias("component_size")
    )
    named = grouped.join(classes, "root").select("fp", "component_id", "component_size")
    return rows.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "component_size",
    )


def kept_documents(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """One document of each component of ``near_dedup``, with the columns of ``docs``.

    The document with the least id of a component stays; null ids come last, and of equal
    ids the first row stays. Documents without words are one component.
    """
    row = common.fresh(docs, "row")[0]
    staged = common.stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    near = near_dedup(staged.select(F.col(f"`{row}`").alias("doc_id"), "text"), size, radius)
    near = near.filter("component_size > 1").select(F.col("doc_id").alias("row"), "component_id")
    ids = staged.select(F.col(f"`{row}`").alias("row"), "doc_id")
    met = common.stored(near.join(ids, "row"), "copies")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    stays = met.groupBy("component_id").agg(F.min(rank).alias("first"))
    gone = met.join(stays, "component_id").filter(F.col("row") != F.col("first.row"))
    gone = gone.select(F.col("row").alias(row))
    return staged.join(gone, row, "left_anti").select(*(f"`{c}`" for c in docs.columns))
