"""Quartile digests of documents, and how alike two of them are.

Byte triplets of a sliding window are hashed into buckets and counted. The digest holds,
for each bucket, the quartile that its count lies in, and the length and the ratios of the
quartiles in the header. Two digests are compared by a difference that adds the steps
between quartiles and between the headers, and is bounded: likeness is 1 for equal digests
and 0 from ``FARTHEST`` on.

Defined results: a null text counts as empty; texts too short for a triplet have all
counts zero and differ by length only; equal texts have equal digests. Documents follow
each other by doc_id, null ids first; equal ids follow each other by a hash of their
texts. A single document follows itself. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm import common

BUCKETS = 256
#: Offsets of the triplets inside a window, and an odd factor that tells them apart.
TRIPLETS = ((0, 1, 2, 0x9E3779B1), (0, 1, 3, 0x85EBCA6B), (0, 2, 3, 0xC2B2AE35))
WINDOW = 4
#: Bytes counted at once, to bound memory for very long texts.
AT_ONCE = 1 << 20
#: Steps between lengths; a length differs from the next class by a fifth.
LENGTH_BASE = 1.2
#: Weight of a step between lengths and between quartile ratios, and of opposite quartiles.
HEADER_WEIGHT, OPPOSITE = 4, 6
#: The difference from which likeness is zero.
FARTHEST = 512


def triplet_counts(data: bytes, first: int = 0) -> np.ndarray:
    """Counts by bucket over the windows that start at ``first`` or later."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    for at in range(max(first, 0), len(raw) - WINDOW + 2, AT_ONCE):
        part = raw[at : at + AT_ONCE + WINDOW - 1].astype(np.uint32)
        for a, b, c, factor in TRIPLETS:
            n = min(AT_ONCE, len(part) - c)
            if n <= 0:
                continue
            value = part[a : a + n] | part[b : b + n] << 8 | part[c : c + n] << 16
            counts += np.bincount((value * np.uint32(factor)) >> np.uint32(24), minlength=BUCKETS)
    return counts


_STEPS = np.array(
    [[OPPOSITE if abs(a - b) == 3 else abs(a - b) for b in range(4)] for a in range(4)], dtype=np.int64
)


class Digest:
    """Quartile codes and header of one text."""

    def __init__(self, counts: np.ndarray, size: int) -> None:
        low, middle, high = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
        self.codes = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
        self.length = min(int(math.log(size + 1, LENGTH_BASE)), 255)
        self.ratios = (16 * low // max(high, 1) % 16, 16 * middle // max(high, 1) % 16)

    def text(self) -> str:
        packed = self.codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], dtype=np.uint8)
        head = bytes([self.length, self.ratios[0] << 4 | self.ratios[1]])
        return (head + packed.astype(np.uint8).tobytes()).hex()

    def difference(self, other: Digest) -> int:
        header = abs(self.length - other.length) + sum(abs(a - b) for a, b in zip(self.ratios, other.ratios))
        return int(_STEPS[self.codes, other.codes].sum()) + HEADER_WEIGHT * header

    def likeness(self, other: Digest) -> float:
        return 1.0 - min(self.difference(other), FARTHEST) / FARTHEST


def read(text: str) -> Digest:
    """The digest that ``text`` writes down."""
    data = bytes.fromhex(text)
    out = Digest.__new__(Digest)
    out.length, out.ratios = data[0], (data[1] >> 4, data[1] & 15)
    packed = np.frombuffer(data[2:], dtype=np.uint8)
    out.codes = (packed[:, None] >> np.array([0, 2, 4, 6], dtype=np.uint8) & 3).reshape(-1)
    return out


def digest(text: str) -> Digest:
    data = text.encode("utf-8")
    return Digest(triplet_counts(data), len(data))


RESULT = """doc_id long, n_chars long, edited_sha256 string, fingerprint string,
    edited_fingerprint string, near_edited double, near_next double"""
_NAMES = [c.split()[0] for c in RESULT.split(",")]


def with_next(
    doc_id: int | None,
    text: str,
    own: Digest,
    counts_at: int,
    shared: np.ndarray,
    following: str,
    next_digest: Digest,
) -> tuple:
    """The result row of a document and the one that follows it."""
    half = len(text) // 2
    kept = text[: len(text) - half].encode("utf-8")
    edited = kept + following[:half].encode("utf-8")
    changed = Digest(shared + triplet_counts(edited, counts_at), len(edited))
    return (
        doc_id, len(text), hashlib.sha256(edited).hexdigest(), own.text(), changed.text(),
        own.likeness(changed), own.likeness(next_digest),
    )


def split_counts(text: str) -> tuple[Digest, int, np.ndarray]:
    """The digest, where the windows that an edit leaves alone end, and their counts."""
    kept = len(text[: len(text) - len(text) // 2].encode("utf-8"))
    data = text.encode("utf-8")
    alone = max(kept - WINDOW + 1, 0)
    shared = triplet_counts(data[: alone + WINDOW - 1]) if alone else np.zeros(BUCKETS, dtype=np.int64)
    if alone:
        shared -= triplet_counts(data[: alone + WINDOW - 1], alone)
    return Digest(shared + triplet_counts(data, alone), len(data)), alone, shared


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document with its digest, that of its edited text, and both likenesses.

    Documents are dealt to sorted ranges of ids. Inside a range every document meets the
    next. The last of a range meets the first of the next range in a join of as many rows
    as there are ranges.
    """
    common.prepare(docs.sparkSession)

    def inside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = None, None
        for batch in batches:
            out, ends = [], []
            ids, parts = batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()
            for doc_id, here, text in zip(ids, parts, common.plain_texts(batch.column("text"))):
                found = (doc_id, text, *split_counts(text))
                if before is None:
                    part = here
                    ends.append(("first", part, doc_id, text))
                else:
                    out.append(with_next(*before, text, found[2]))
                before = found
            yield table(out, ends)
        if before is not None:
            yield table([], [("last", part, before[0], before[1])])

    def table(rows: list[tuple], ends: list[tuple]) -> pa.RecordBatch:
        blank = (None,) * (len(_NAMES) - 1)
        full = [(*r, "row", None, None) for r in rows] + [(d, *blank, k, p, t) for k, p, d, t in ends]
        columns = list(zip(*full)) or [()] * len(types)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=[*_NAMES, "kind", "part", "text"]
        )

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    own = [kinds[c.split()[1]] for c in RESULT.split(",")]
    types = [*own, pa.string(), pa.int64(), pa.string()]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    numbered = dealt.select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))
    found = common.stored(numbered.mapInArrow(inside, f"{RESULT}, kind string, part long, text string"), "digests")
    rows = found.filter("kind = 'row'").select(*_NAMES)

    first = found.filter("kind = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    last = found.filter("kind = 'last'").select("doc_id", "part", "text")
    # one number per range; the texts are joined by it
    in_order = Window.orderBy("part")
    after = first.select(F.col("next_part").alias("part")).select(
        "part", F.lead("part").over(in_order).alias("after"), F.min("part").over(in_order).alias("least")
    )
    pairs = (
        last.join(after, "part")
        .withColumn("next_part", F.coalesce("after", "least"))
        .join(first, "next_part")
        .select("doc_id", "text", "next_text")
    )

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (common.plain_texts(batch.column(c)) for c in ("text", "next_text"))
            columns = batch.column("doc_id").to_pylist(), *texts
            out = [with_next(i, t, *split_counts(t), n, digest(n)) for i, t, n in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * len(own), own)], names=_NAMES
            )

    return rows.unionByName(pairs.mapInArrow(across, RESULT))
