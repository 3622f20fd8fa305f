"""Packing of documents into windows of several lengths.

A document's ids fill whole long windows first. What is left of it is routed to the tier
of the shortest window that holds it. Windows of a tier are opened by that tier's rests,
longest tier first, and their gaps are filled from shorter ones: by the longest rest that
fits, again and again, and at the end by a cut of the shortest that does not. A window is
left unfilled only when a group has no rests any more, so all windows are exactly as long
as their tier but for one of a group.

Rests are dealt to groups of about ``GROUP_ROWS`` documents by a hash of the id and the
place of the row, so that repeated ids do not meet in one group. Windows of a tier are
dealt to steps of ``STEP_TOKENS`` ids in snake order of their attention cost, so that the
steps of a group cost about the same.

Defined results: a null text counts as empty and packs as its end id alone; repeated rows
are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import common, token_ids

#: Windows, longest first.
TIERS = (2048, 1024, 512, 256)
GROUP_ROWS = 4096
STEP_TOKENS = 8 * 2048
RESULT = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long,
    sequence_id long, offset long, tier long, step_group long"""
_NAMES = [c.split()[0] for c in RESULT.split(",")]


class Rests:
    """Rests by length; the set of lengths is a bitfield."""

    def __init__(self) -> None:
        self.of: dict[int, list] = {}
        self.lengths = 0
        self.left = 0

    def add(self, length: int, rest: tuple) -> None:
        self.of.setdefault(length, []).append(rest)
        self.lengths |= 1 << length
        self.left += 1

    def _take(self, length: int) -> tuple[int, tuple]:
        stack = self.of[length]
        rest = stack.pop()
        if not stack:
            self.lengths &= ~(1 << length)
        self.left -= 1
        return length, rest

    def longest_up_to(self, length: int) -> tuple[int, tuple] | None:
        fitting = self.lengths & ((1 << (length + 1)) - 1)
        return self._take(fitting.bit_length() - 1) if fitting else None

    def shortest_above(self, length: int) -> tuple[int, tuple] | None:
        longer = self.lengths >> (length + 1)
        return self._take((longer & -longer).bit_length() + length) if longer else None


def pack(
    rests: Iterable[tuple[int, int]], tiers: tuple[int, ...] = TIERS
) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows (tier, pieces) of rests (name, length); a piece is (name, from, length).

    Every length is below the longest tier.
    """
    pool = Rests()
    for name, length in sorted(rests, key=lambda r: (r[1], r[0]), reverse=True):
        if length:
            pool.add(length, (name, 0))
    windows = []
    for tier, shorter in zip(tiers, (*tiers[1:], 0)):
        while pool.left:
            opening = pool.longest_up_to(tier)
            if opening is None or opening[0] <= shorter:
                if opening is not None:
                    pool.add(opening[0], opening[1])
                break
            pieces, gap = [], tier
            taken = opening
            while taken is not None:
                length, (name, start) = taken
                pieces.append((name, start, length))
                gap -= length
                taken = pool.longest_up_to(gap) if gap else None
            if gap and (cut := pool.shortest_above(gap)) is not None:
                length, (name, start) = cut
                pieces.append((name, start, gap))
                pool.add(length - gap, (name, start + gap))
            windows.append((tier, pieces))
    return windows


def steps(windows: list[tuple[int, list[tuple[int, int, int]]]]) -> list[int]:
    """A step for each window: windows of a tier in snake order of their cost."""
    out = [0] * len(windows)
    first = 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        mine = [i for i, (t, _) in enumerate(windows) if t == tier]
        mine.sort(key=lambda i: (-sum(n * n for _, _, n in windows[i][1]), i))
        count = -(-len(mine) * tier // STEP_TOKENS)
        for rank, i in enumerate(mine):
            lap, place = divmod(rank, count)
            out[i] = first + (place if lap % 2 == 0 else count - 1 - place)
        first += count
    return out


def token_rests(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Rows (group, doc_id, start, doc_tokens, crc, ids): whole windows with their checksum, rests with ids."""
    longest = TIERS[0]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = token_ids.encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            found = coder.encode(common.plain_texts(batch.column("text")))
            for group, doc_id, ids in zip(batch.column("group").to_pylist(), batch.column("doc_id").to_pylist(), found):
                ids += end
                n = len(ids) // 4
                for start in range(0, n - longest + 1, longest):
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + longest)])
                    rows.append((group, doc_id, start, n, crc, None))
                if n % longest:
                    rows.append((group, doc_id, n - n % longest, n, None, ids[4 * (n - n % longest) :]))
            kinds = [pa.int64()] * 5 + [pa.binary()]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["group", "doc_id", "start", "doc_tokens", "crc", "ids"],
            )

    groups = max(1, -(-docs.count() // GROUP_ROWS))
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)).alias("group"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )
    return dealt.mapInArrow(run, "group long, doc_id long, start long, doc_tokens long, crc long, ids binary")


def packed_group(table: pa.Table) -> list[tuple]:
    """The result rows of one group."""
    group = table.column("group")[0].as_py()
    rows = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "crc", "ids"))))
    whole = [(TIERS[0], [(i, 0, TIERS[0])]) for i, r in enumerate(rows) if r[4] is None]
    windows = whole + pack((i, len(r[4]) // 4) for i, r in enumerate(rows) if r[4] is not None)
    out = []
    for number, ((tier, pieces), step) in enumerate(zip(windows, steps(windows))):
        offset = 0
        for name, at, length in pieces:
            doc_id, start, doc_tokens, crc, ids = rows[name]
            if ids is not None:
                crc = zlib.crc32(ids[4 * at : 4 * (at + length)])
            names = (group << 32) + number, offset, tier, (group << 32) + step
            out.append((doc_id, start + at, length, crc, doc_tokens, *names))
            offset += length
    return out


def packed(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """One row per piece; see ``RESULT``. ``step_group`` names the step that a window is trained in."""
    common.prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.runs(batches, 1):
            columns = list(zip(*packed_group(table)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)

    rows = token_rests(docs, path, end_id).repartition("group").sortWithinPartitions("group", "doc_id", "start")
    return rows.mapInArrow(run, RESULT)
