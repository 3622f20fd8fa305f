"""Repeated passages of whole texts, found by suffix order and longest previous factors.

A window is a string of ``size`` bytes; one that starts at two places is a repeat. Sorting
every suffix of a corpus would move each text many times over, so suffixes are sorted in
groups that cannot miss a repeat. The least hash of the half-size strings in a window is
its anchor: equal windows have equal anchors at equal places. Neighbouring windows with one
anchor form a run, and only runs with equal anchors can hold equal windows.

1. Runs are read from all texts. Those whose anchor occurs once are dropped by a count.
2. Equal runs are counted: all their windows are repeats, whatever the number of copies.
3. Different runs with one anchor are put in suffix order. For every window, the previous
   and the next smaller position in that order give its longest earlier match (its longest
   previous factor, cut at ``size``). Windows with a match of full length repeat an earlier
   one, and the windows they match are repeated later.

An anchor with too many different runs for one task is split: its windows are cut by their
place to the anchor into ranges, and those that share all bytes common to a range form
smaller groups. At a range of one window they are equal, so splitting always ends.

``keep="first"`` removes what repeats an earlier window, in the order of id, text hash and
place; rows equal in id and text count as one there. ``keep="none"`` removes every copy.

Defined results: a null text counts as empty; null ids are kept and come first; a text
shorter than ``size`` has nothing to remove; repeated rows are copies of each other under
``keep="none"``; no rows give no rows. Further columns are kept. Memory in a task is bounded
by ``AT_ONCE`` bytes at a time, besides the longest text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import common

#: Bytes hashed or sorted at once.
AT_ONCE = 1 << 20
#: Different runs of an anchor that one task may sort.
GROUP = 4000
#: Ranges that a crowded anchor is split into.
FAN = 8
_LOW = np.uint64((1 << 21) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and their inverses."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from every place on, the same wherever they stand."""
    powers, inverses = _powers(AT_ONCE)
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[: len(text)], out=sums[1:])
    hashed = (sums[gram:] - sums[:-gram]) * inverses[: len(text) - gram + 1]
    hashed ^= hashed >> np.uint64(32)
    hashed *= np.uint64(0xD6E8FEB86659FD93)
    return hashed ^ (hashed >> np.uint64(32))


def anchors(hashed: np.ndarray, wide: int) -> np.ndarray:
    """The place of the least hash among ``wide`` neighbours, the last one if equal."""
    n = len(hashed)
    key = (hashed & ~_LOW) | (_LOW - np.arange(n, dtype=np.uint64))
    padded = np.full(-(-n // wide) * wide, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = key
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    least = np.minimum(ahead[: n - wide + 1], behind[wide - 1 : n])
    return (_LOW - (least & _LOW)).astype(np.int64)


def _pieces(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """Texts side by side, at most ``AT_ONCE`` bytes together; longer texts in overlapping cuts.

    Gives the bytes and a list of (unit, id, place of the cut in its text, bytes).
    """
    held: list[tuple] = []
    total = 0
    for batch in batches:
        units, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for unit, doc_id, text in zip(units, ids, common.raw_texts(batch.column(2))):
            for at in range(0, max(len(text) - size + 1, 0), AT_ONCE - size + 1):
                cut = text[at : at + AT_ONCE]
                if total + len(cut) > AT_ONCE and held:
                    yield held
                    held, total = [], 0
                held.append((unit, doc_id, at, cut))
                total += len(cut)
    if held:
        yield held


RUN = "unit binary, doc_id long, place long, n int, back int, gram long, span binary"


def _runs(batches: Iterable[pa.RecordBatch], size: int, gram: int) -> Iterator[pa.RecordBatch]:
    for held in _pieces(batches, size):
        text = b"".join(cut for *_, cut in held)
        hashed = gram_hashes(np.frombuffer(text, dtype=np.uint8), gram)
        at = anchors(hashed, size - gram + 1)
        ends = np.cumsum([len(cut) for *_, cut in held])
        starts = ends - [len(cut) for *_, cut in held]
        inside = np.zeros(len(at) + 1, dtype=np.int8)
        np.add.at(inside, starts, 1)
        np.add.at(inside, ends - size + 1, -1)
        inside = np.cumsum(inside[:-1]) > 0
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
        first = np.flatnonzero(inside & new)
        last = np.ones(len(at), dtype=bool)
        last[:-1] = new[1:] | ~inside[1:]
        last = np.flatnonzero(inside & last)
        owner = np.searchsorted(starts, first, side="right") - 1
        offset = np.array([c[2] for c in held])[owner] - starts[owner]
        digest = xxhash.xxh3_128_digest
        spans = [digest(text[a : b + size]) for a, b in zip(first.tolist(), last.tolist())]
        owners = owner.tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([held[o][0] for o in owners], pa.binary()),
                pa.array([held[o][1] for o in owners], pa.int64()),
                pa.array(first + offset, pa.int64()),
                pa.array(last - first + 1, pa.int32()),
                pa.array(at[first] - first, pa.int32()),
                pa.array(hashed[at[first]].view(np.int64), pa.int64()),
                pa.array(spans, pa.binary()),
            ],
            names=[c.split()[0] for c in RUN.split(", ")],
        )


# --- suffix order of a group ---------------------------------------------------------------


def _ranked(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


def suffix_order(text: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in the order of the ``size`` bytes there, and common bytes with the one before.

    Ranks of 8 bytes are doubled to 16, 32 and so on. Common lengths are right for full
    ``size`` and otherwise rounded down to multiples of 8. ``size`` must be 8 or more.
    """
    padded = np.zeros(len(text) + 2 * size, dtype=np.uint8)
    padded[: len(text)] = text
    n = len(text) + size
    eight = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        eight = (eight << np.uint64(8)) | padded[i : i + n]
    levels = [(8, _ranked(eight))]
    while levels[-1][0] * 2 <= size:
        length, rank = levels[-1]
        ahead = np.zeros(n, dtype=np.uint64)
        ahead[:-length] = rank[length:]
        levels.append((2 * length, _ranked(rank * np.uint64(n + 1) + ahead)))
    length, rank = levels[-1]
    whole = rank[starts] * np.uint64(n + 1) + rank[starts + size - length]
    order = np.argsort(whole, kind="stable")
    placed, whole = starts[order], whole[order]
    common_bytes = np.zeros(len(placed), dtype=np.int64)
    a, b = placed[:-1], placed[1:]
    reach = np.zeros(len(a), dtype=np.int64)
    for length, rank in reversed(levels):
        for _ in range(2):  # the longest level may fit twice
            fits = reach + length <= size
            same = fits & (rank[np.where(fits, a + reach, 0)] == rank[np.where(fits, b + reach, 0)])
            reach += np.where(same, length, 0)
    common_bytes[1:] = np.where(whole[1:] == whole[:-1], size, np.minimum(reach, size - 1))
    return order, common_bytes


def previous_factors(
    positions: list[int], shared: list[int], size: int
) -> tuple[list[int], list[bool]]:
    """For elements in suffix order: the longest earlier match, and who is matched in full.

    ``shared[i]`` is what element i shares with the one before it in the order. Walking
    along the order, a stack holds the elements whose next smaller position is still ahead;
    below each lies its previous smaller position. The longer of both matches is the
    longest previous factor. An element matched by a later one in at least ``size`` is marked.
    """
    longest, matched = [0] * len(positions), [False] * len(positions)
    stack: list[tuple[int, int]] = []  # element, what it shares with the one below
    for i in range(len(positions) + 1):
        here = shared[i] if i < len(positions) else 0
        while stack and (i == len(positions) or positions[stack[-1][0]] > positions[i]):
            top, below = stack.pop()
            longest[top] = max(below, here)
            if below >= size:
                matched[stack[-1][0]] = True
            if here >= size:
                matched[i] = True
            here = min(here, below)
        if i < len(positions):
            stack.append((i, here if stack else 0))
    return longest, matched


def _ranges(places: np.ndarray) -> list[dict]:
    """Neighbouring places as ranges."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > 1) + 1
    return [{"lo": int(p[0]), "hi": int(p[-1])} for p in np.split(places, cuts)]


def repeats_of(texts: list[bytes], orders: list, size: int) -> tuple[list, list]:
    """Ranges of windows of each text that repeat an earlier window, and that repeat any.

    Texts come in any order; ``orders`` says which are earlier.
    """
    text = np.frombuffer(b"".join(texts), dtype=np.uint8)
    counts = np.array([len(t) - size + 1 for t in texts])
    begin = np.cumsum([0, *(len(t) for t in texts[:-1])])
    owner = np.repeat(np.arange(len(texts)), counts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    order, shared = suffix_order(text, begin[owner] + inner, size)
    # only neighbours that share a whole window can end up with a full match
    near = shared >= size
    near[:-1] |= near[1:]
    order, shared = order[near], shared[near]
    shared[:1] = 0
    rank = np.empty(len(texts), dtype=np.int64)
    rank[sorted(range(len(texts)), key=lambda i: orders[i])] = np.arange(len(texts))
    positions = rank[owner[order]] * (1 + int(counts.max())) + inner[order]
    longest, matched = previous_factors(positions.tolist(), shared.tolist(), size)
    later = np.array(longest, dtype=np.int64) >= size
    either = later | np.array(matched, dtype=bool)
    out = ([], [])
    for flags, found in zip((later, either), out):
        chosen = order[flags]
        by_text = np.sort(chosen)
        bounds = np.searchsorted(by_text, np.cumsum([0, *counts]))
        for i in range(len(texts)):
            found.append(_ranges(inner[by_text[bounds[i] : bounds[i + 1]]]))
    return out


# --- groups --------------------------------------------------------------------------------

#: A distinct run of a group; ``low`` and ``n`` name its windows by their place to the anchor.
_MEMBER = "node binary, span binary, copies long, first struct<doc_id:long, unit:binary, place:long>"
_RANGES = "array<struct<lo:int, hi:int>>"
_FOUND = f"{_MEMBER}, later {_RANGES}, either {_RANGES}"


def _order(first: dict) -> tuple:
    known = first["doc_id"] is not None
    return (known, first["doc_id"] if known else 0, first["unit"], first["place"])


def _sorted_groups(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Longest previous factors of every group; small groups are sorted side by side."""
    schema = None
    waiting: list[dict] = []
    total = 0

    def found(rows: list[dict]) -> pa.RecordBatch:
        texts = [r["text"] for r in rows]
        later, either = repeats_of(texts, [_order(r["first"]) for r in rows], size)
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        columns = [pa.array([r[f.name] for r in rows], f.type) for f in schema]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(later, kind), pa.array(either, kind)],
            names=[*schema.names, "later", "either"],
        )

    for group in common.runs(batches, 1):
        rows = group.to_pylist()
        if schema is None:
            names = ["node", "span", "copies", "first"]
            schema = pa.schema([group.schema.field(c) for c in names])
        if waiting and total + group.nbytes > AT_ONCE:
            yield found(waiting)
            waiting, total = [], 0
        waiting += rows
        total += group.nbytes
    if waiting:
        yield found(waiting)


_CHILD = f"""up binary, over binary, node binary, span binary,
    first struct<doc_id:long, unit:binary, place:long>, shift int, low int, n int, text binary"""


def _children(batches: Iterable[pa.RecordBatch], size: int, gram: int, wide: int) -> Iterator:
    """The runs of crowded groups, cut into ranges of ``wide`` windows by place to the anchor.

    ``low`` is the distance of a run's last window to its anchor. A range is named by the
    bytes that all its windows have, so windows that are equal come to groups of one name.
    """
    digest = xxhash.xxh3_128_digest
    names = [c.split()[0] for c in _CHILD.replace("struct<doc_id:long, unit:binary, place:long>", "s").split(",")]
    for batch in batches:
        out: dict[str, list] = {c: [] for c in names}
        for r in batch.to_pylist():
            text, high = r["text"], r["low"] + r["n"] - 1
            for k in range(r["low"] // wide, high // wide + 1):
                near, far = k * wide, min(k * wide + wide - 1, size - gram)
                lo, hi = max(r["low"], near), min(high, far)
                shared = text[high - near : high - far + size]
                cut = text[high - hi : high - lo + size]
                first = {**r["first"], "place": r["first"]["place"] + high - hi}
                name = digest(r["node"] + struct.pack("<ii", k, wide) + shared)
                values = (r["node"], r["span"], name, digest(cut), first, high - hi, lo, hi - lo + 1, cut)
                for column, value in zip(out.values(), values):
                    column.append(value)
        kinds = [pa.binary()] * 4 + [batch.schema.field("first").type] + [pa.int32()] * 3 + [pa.binary()]
        columns = [pa.array(v, t) for v, t in zip(out.values(), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _whole() -> Column:
    return F.array(F.struct(F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi")))


def _decided(found: DataFrame) -> tuple[Column, Column]:
    """Ranges of a member of a group: what repeats an earlier window, and what repeats any."""
    none = F.array().cast(_RANGES)
    alone = F.col("copies") == 1
    either = F.when(alone, F.coalesce("either", none)).otherwise(_whole())
    later = F.when(F.col("is_first"), F.coalesce("later", none)).otherwise(_whole())
    return later, either


def _in_groups(level: DataFrame, size: int, gram: int, wide: int) -> DataFrame:
    """node, span, later and either for groups of different runs.

    ``level`` has node, span, copies, first, low, n, text and kinds, the runs of its group.
    Groups of over ``GROUP`` runs are split into ranges of ``wide`` windows.
    """
    small = (
        level.filter(F.col("kinds") <= GROUP)
        .select("node", "span", "copies", "first", "text")
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(lambda batches: _sorted_groups(batches, size), _FOUND)
        .select("node", "span", "later", "either")
    )
    crowded = level.filter(F.col("kinds") > GROUP)
    if crowded.isEmpty():
        return small
    children = common.stored(
        crowded.select("node", "span", "first", "low", "n", "text").mapInArrow(
            lambda batches: _children(batches, size, gram, wide), _CHILD
        ),
        "repeats",
    )
    kinds = children.groupBy("node", "span").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min("first").alias("first"),
        *(F.first(c).alias(c) for c in ("low", "n", "text")),
    )
    kinds = common.stored(kinds, "repeats")
    sizes = kinds.groupBy("node").agg(F.count(F.lit(1)).alias("kinds"))
    below = _in_groups(
        common.stored(kinds.join(sizes.filter("kinds > 1"), "node"), "repeats"),
        size,
        gram,
        max(1, -(-wide // FAN)),
    )
    found = kinds.select("node", "span", "copies", F.col("first").alias("_first")).join(
        below, ["node", "span"], "left"
    )
    members = children.select("up", "over", "node", "span", "first", "shift", "n").join(
        found.filter("copies > 1 OR size(either) > 0"), ["node", "span"]
    )
    later, either = _decided(members)
    moved = members.withColumn("is_first", F.col("first").eqNullSafe(F.col("_first"))).select(
        F.col("up").alias("node"),
        F.col("over").alias("span"),
        *(_shifted(ranges, "shift").alias(c) for c, ranges in (("later", later), ("either", either))),
    )
    merged = moved.groupBy("node", "span").agg(
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("later", "either"))
    )
    return small.unionByName(merged)


def _shifted(ranges: Column, by: str) -> Column:
    return F.transform(
        ranges,
        lambda r: F.struct((r["lo"] + F.col(by)).alias("lo"), (r["hi"] + F.col(by)).alias("hi")),
    )


def _unit(doc_id: str, text: str) -> Column:
    """A name for a row: 16 bytes of a hash of its id and text."""
    named = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), common.empty_as(text))
    return F.unhex(F.substring(F.sha2(named, 256), 1, 32))


def _spans(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted runs of each text."""
    for batch in batches:
        texts = common.raw_texts(batch.column(0))
        rows, found = [], []
        for text, wanted in zip(texts, batch.column(1).to_pylist()):
            for r in wanted:
                at = r["first"]["place"]
                rows.append(r)
                found.append(text[at : at + r["n"] + size - 1])
        kind = batch.schema.field(1).type.value_type
        columns = {f.name: pa.array([r[f.name] for r in rows], f.type) for f in kind}
        columns["text"] = pa.array(found, pa.binary())
        yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])


def repeated_ranges(docs: DataFrame, size: int, keep: str) -> DataFrame:
    """Ranges of windows to remove, by unit: rows (unit, ranges of first and last place).

    ``docs`` has the columns unit, doc_id and text.
    """
    gram = size // 2
    runs = docs.select("unit", "doc_id", "text").mapInArrow(
        lambda batches: _runs(batches, size, gram), RUN
    )
    # stored, because a join whose side ends in an aggregate is not split where a key is hot
    often = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("gram")
    often = common.stored(often, "repeats")
    repeated = common.stored(runs.join(often, "gram", "left_semi"), "repeats")
    kinds = common.stored(
        repeated.groupBy("gram", "span").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "unit", "place")).alias("first"),
            F.first("n").alias("n"),
            F.first(F.col("back") - F.col("n") + 1).alias("low"),
        ),
        "repeats",
    )
    sizes = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    sizes = common.stored(sizes, "repeats")
    node = F.unhex(F.lpad(F.hex("gram"), 16, "0"))
    wanted = (
        kinds.join(sizes, "gram")
        .select(node.alias("node"), "span", "copies", "first", "low", "n", "kinds")
        .groupBy(F.col("first.unit").alias("unit"))
        .agg(F.collect_list(F.struct("node", "span", "copies", "first", "low", "n", "kinds")).alias("wanted"))
    )
    schema = f"{_MEMBER}, low int, n int, kinds long, text binary"
    level = (
        docs.select("unit", "text")
        .join(wanted, "unit")
        .select("text", "wanted")
        .mapInArrow(lambda batches: _spans(batches, size), schema)
        .dropDuplicates(["node", "span"])
    )
    wide = -(-(size - gram + 1) // FAN)
    found = _in_groups(common.stored(level, "repeats"), size, gram, wide)
    decided = (
        kinds.select("gram", "span", "copies", F.col("first").alias("_first"), node.alias("node"))
        .join(found, ["node", "span"], "left")
        .filter("copies > 1 OR size(either) > 0")
    )
    members = repeated.join(decided.drop("node"), ["gram", "span"])
    same = F.struct("doc_id", "unit", "place").eqNullSafe(F.col("_first"))
    later, either = _decided(members)
    chosen = later if keep == "first" else either
    return (
        members.withColumn("is_first", same)
        .select("unit", _shifted(chosen, "place").alias("ranges"))
        .filter(F.size("ranges") > 0)
        .groupBy("unit")
        .agg(F.flatten(F.collect_set("ranges")).alias("ranges"))
    )


def _removed(ranges: list | None, size: int) -> list[tuple[int, int]]:
    """The bytes of all windows in the ranges, as maximal stretches."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges or ()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi + size))
        else:
            out.append((lo, hi + size))
    return out


ADDED = "kept binary, removed array<struct<start:long, length:long>>"


def _cut_out(batches: Iterable[pa.RecordBatch], text: str, size: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    for batch in batches:
        place = batch.schema.get_field_index(text)
        kept, removed = [], []
        for data, ranges in zip(common.raw_texts(batch.column(place)), batch.column(batch.num_columns - 1).to_pylist()):
            spans = _removed(ranges, size)
            edges = [0, *(e for span in spans for e in span), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            removed.append([{"start": a, "length": b - a} for a, b in spans])
        own = batch.select(batch.schema.names[:-1])
        yield common.appended(own, {"kept": pa.array(kept, pa.binary()), "removed": pa.array(removed, kind)})


def without_repeats(
    df: DataFrame,
    size: int = 400,
    keep: str = "first",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``df`` with the bytes that stay and the stretches that go: kept, removed.

    A cut may fall inside a character, so what stays is binary. Columns named kept or
    removed are replaced.
    """
    if keep not in ("first", "none") or size < 16:
        raise ValueError("keep must be first or none, and windows have 16 bytes or more")
    common.prepare(df.sparkSession)
    df = df.drop("kept", "removed")
    unit, ranges = common.fresh(df, "unit", "ranges")
    named = df.withColumn(unit, _unit(doc_id, text))
    docs = named.select(
        F.col(unit).alias("unit"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    found = repeated_ranges(docs, size, keep)
    joined = named.join(
        found.select(F.col("unit").alias(unit), F.col("ranges").alias(ranges)), unit, "left"
    ).select(*df.columns, ranges)
    return joined.mapInArrow(
        lambda batches: _cut_out(batches, text, size), common.with_fields(df, ADDED)
    )


def repeat_report(df: DataFrame, size: int = 400) -> DataFrame:
    """Every copy removed: doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document."""
    cut = without_repeats(df.select("doc_id", "text"), size, keep="none")
    n_bytes = F.octet_length(common.empty_as("text")).cast("long")
    return cut.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def sql(size: int = 400) -> str:
    """The same as DuckDB SQL: every window of every text, counted."""
    return f"""WITH d AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    w AS MATERIALIZED (
      SELECT r, p, md5_number(substr(x, 2 * p + 1, {2 * size})) AS m
      FROM (SELECT r, x, unnest(range(0, len(x) // 2 - {size} + 1)) AS p FROM d WHERE len(x) >= {2 * size})),
    hit AS MATERIALIZED (
      SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before
      FROM w JOIN (SELECT m FROM w GROUP BY m HAVING count(*) > 1) USING (m)),
    span AS MATERIALIZED (
      SELECT r, k, min(p) AS a, max(p) + {size} AS b FROM (
        SELECT r, p, sum(CASE WHEN before IS NULL OR p > before + {size} THEN 1 ELSE 0 END)
          OVER (PARTITION BY r ORDER BY p) AS k FROM hit)
      GROUP BY r, k),
    edge AS (
      SELECT r, k, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS left_end,
        row_number() OVER (PARTITION BY r ORDER BY a DESC) AS back FROM span),
    cut AS (
      SELECT r, count(*) AS n, sum(b - a) AS gone,
        string_agg(substr(x, 2 * left_end + 1, 2 * (a - left_end)), '' ORDER BY a)
          || any_value(substr(x, 2 * (SELECT max(b) FROM span s WHERE s.r = edge.r) + 1)) AS kept
      FROM edge JOIN d USING (r) GROUP BY r)
    SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
      CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
    FROM d LEFT JOIN cut USING (r)"""
