"""Phrases that occur together more often than their parts: dynamic itemset counting.

Documents are dealt to shards, which are scanned in a cycle. Single words are counted from
the first scan on. As soon as both phrases that a longer phrase is made of (all words but
the last, all but the first) have been counted often enough, the longer one becomes active
with the next scan, while shorter ones are still being counted. Every phrase is counted in
each shard exactly once, over the full cycle that begins when it becomes active. Scanning
ends when a whole cycle has made nothing active.

A scan keeps the phrases that were often enough in bit fields of hashes, one per length: at
most 2^27 bits each, whatever the size of the corpus. They only save work. A phrase let in
by a colliding hash is counted like the others and does not reach the threshold, and a
bit is never cleared, so none that belongs is left out. To count once, a scan leaves out
what the bit fields of one cycle ago let in: that has seen this shard already.

Counts are kept per language and phrase text and combined before they are shuffled. What
reaches the threshold over all shards has at least its share of it in one shard. Only
phrases with such a share are added up from scan to scan; the many others stay in the
tables of their scans and are looked up there if a later scan of their cycle finds the share.

Defined results: a null text counts as empty, a null language as ``und``; the empty language
is one of its own; repeated rows count each; ids are not used, so null ones do no harm; no
words give no rows. Pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are runs of other bytes than
space and tab; A-Z are lowered. A text is handled in stretches of whole pieces, so memory
is bounded by ``AT_ONCE`` bytes or the longest piece.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm import common
from headway.session import scratch_path

NO_LANGUAGE = "und"
LONGEST = 5
#: Bytes of text whose phrases are counted at once.
AT_ONCE = 1 << 20
#: Bits of a field per phrase that it holds, and its least and largest size as powers of two.
SPARE, LEAST_BITS, MOST_BITS = 64, 20, 27
#: Phrases of some 30 bytes that may be broadcast.
MOST_BROADCAST = 300_000

_BLANK, _END = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(b" \t")] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _END
_ENDS = bytes(np.flatnonzero(_KIND == _END).tolist())
_LOWER = bytes(range(256)).lower()
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Field:
    """Which hashes may belong to a phrase that occurs often enough."""

    words: np.ndarray

    def has(self, hashed: np.ndarray) -> np.ndarray:
        place = hashed & np.uint64(64 * len(self.words) - 1)
        word = self.words[(place >> np.uint64(6)).astype(np.int64)]
        return (word >> (place & np.uint64(63))) & np.uint64(1) != 0


NOTHING = Field(np.zeros(1, dtype=np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and their inverses."""
    out = []
    for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _hashes(text: np.ndarray, lang: str):
    """A function that hashes stretches of ``text``, the same wherever a stretch stands."""
    powers, inverses = _powers(1 << len(text).bit_length())
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[: len(text)], out=sums[1:])
    seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    return lambda begin, end: _mixed(((sums[end] - sums[begin]) * inverses[begin]) ^ seed)


@dataclass
class Words:
    """Words of a text in the normal form: single spaces between them, one byte over."""

    text: bytes
    begin: np.ndarray
    end: np.ndarray
    piece: np.ndarray


def words_of(text: bytes) -> Words:
    lowered = np.frombuffer(text.translate(_LOWER), dtype=np.uint8)
    kind = _KIND[lowered]
    inside = np.concatenate(([False], kind == 0, [False]))
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = turns[::2], turns[1::2]
    piece = np.cumsum(kind == _END)[begin] if len(begin) else begin
    lengths = end - begin + 1
    close = np.cumsum(lengths)
    # a word's bytes move back by what was between the words before it
    normal = np.full(int(close[-1]) if len(close) else 0, ord(" "), dtype=np.uint8)
    keep = np.repeat(begin - (close - lengths), lengths - 1)
    target = np.arange(len(normal))
    is_space = np.zeros(len(normal), dtype=bool)
    is_space[close - 1] = True
    target = target[~is_space]
    normal[target] = lowered[target + keep]
    return Words(normal.tobytes(), close - lengths, close - 1, piece)


COUNTED = "lang string, size int, phrase binary, n long"


def counted(
    lang: str, text: bytes, sizes: list[int], now: list[Field], then: list[Field] | None
) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Counts of the active phrases of a text, by number of words; size 0 counts all words.

    A phrase counts if ``now`` has both phrases it is made of and ``then`` has not.
    """
    words = words_of(text)
    if not len(words.begin):
        return
    hashed = _hashes(np.frombuffer(words.text, dtype=np.uint8), lang)
    if 1 in sizes:
        yield 0, [b""], np.array([len(words.begin)])
    last = None  # hashes of the phrases one word shorter, by first word
    for size in range(1, LONGEST + 1):
        n = len(words.begin) - size + 1
        if n <= 0:
            return
        if size not in sizes and size + 1 not in sizes:
            continue
        here = hashed(words.begin[:n], words.end[size - 1 :])
        if size in sizes:
            if size == 1:
                chosen = np.arange(n)
            else:
                active = words.piece[:n] == words.piece[size - 1 :]
                front, rear = last[:n], last[1 : n + 1]
                active &= now[size - 1].has(front) & now[size - 1].has(rear)
                if then is not None:
                    active &= ~(then[size - 1].has(front) & then[size - 1].has(rear))
                chosen = np.flatnonzero(active)
            if len(chosen):
                _, at, counts = np.unique(here[chosen], return_index=True, return_counts=True)
                at = chosen[at]
                ends = words.end[at + size - 1].tolist()
                yield size, [words.text[a:b] for a, b in zip(words.begin[at].tolist(), ends)], counts
        last = here


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """Texts by language, about ``AT_ONCE`` bytes at a time; long texts are cut between pieces."""
    held: dict[str, list[bytes]] = {}
    total = 0
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang, text in zip(langs, common.raw_texts(batch.column(1))):
            at = 0
            while at < len(text):
                stop = at + AT_ONCE
                if stop < len(text):
                    cut = max(text.rfind(e, at, stop) for e in _ENDS)
                    if cut < 0:  # a piece longer than a stretch stays whole
                        cut = min((c for c in (text.find(e, stop) for e in _ENDS) if c >= 0), default=len(text))
                    stop = cut + 1
                held.setdefault(lang, []).append(text[at:stop])
                total += min(stop, len(text)) - at
                at = stop
                if total >= AT_ONCE:
                    yield held
                    held, total = {}, 0
    if held:
        yield held


def _scan(shard: DataFrame, sizes: list[int], now: list[Field], then: list[Field] | None) -> DataFrame:
    """Counts of the active phrases of a shard: rows (lang, size, phrase, n) to be added up."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _stretches(batches):
            for lang, texts in held.items():
                for size, phrases, counts in counted(lang, b"\n".join(texts), sizes, now, then):
                    n = len(phrases)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * n, pa.string()),
                            pa.array([size] * n, pa.int32()),
                            pa.array(phrases, pa.binary()),
                            pa.array(counts, pa.int64()),
                        ],
                        names=["lang", "size", "phrase", "n"],
                    )

    return shard.select("lang", "text").mapInArrow(run, COUNTED)


def _fields(often: DataFrame) -> list[Field]:
    """The bit field of each length, from the phrases that occur often enough so far.

    The bits are collected as 64-bit words: at most 2^(MOST_BITS - 6) rows for each length.
    """
    held = dict(often.groupBy("size").agg(F.count(F.lit(1))).collect())
    bits = {
        size: min(max(LEAST_BITS, (SPARE * n).bit_length()), MOST_BITS) for size, n in held.items()
    }

    def marks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).to_pylist()
            places = []
            for size, lang, phrase in zip(sizes, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text = np.frombuffer(phrase, dtype=np.uint8)
                value = _hashes(text, lang)(np.array([0]), np.array([len(text)]))[0]
                places.append(int(value) & ((1 << bits[size]) - 1))
            place = np.array(places, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sizes, pa.int32()),
                    pa.array(place >> 6, pa.int64()),
                    pa.array((np.uint64(1) << (place & 63).astype(np.uint64)).view(np.int64), pa.int64()),
                ],
                names=["size", "word", "bits"],
            )

    rows = (
        often.select("size", "lang", "phrase")
        .mapInArrow(marks, "size int, word long, bits long")
        .groupBy("size", "word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    sizes, word, value = (rows.column(c).to_numpy() for c in ("size", "word", "bits"))
    out = [NOTHING] * (LONGEST + 1)
    for size, n in bits.items():
        field = np.zeros(1 << (n - 6), dtype=np.uint64)
        own = sizes == size
        field[word[own]] = value[own].astype(np.int64).view(np.uint64)
        out[size] = Field(field)
    return out


def _merged(old: list[Field], new: list[Field]) -> list[Field]:
    """What either has. A field that has grown repeats the old one, so nothing is lost."""
    out = []
    for a, b in zip(old, new):
        n = max(len(a.words), len(b.words))
        out.append(Field(np.tile(a.words, n // len(a.words)) | np.tile(b.words, n // len(b.words))))
    return out


def phrase_counts(docs: DataFrame, least: int, shards: int) -> DataFrame:
    """Every phrase of 1 to 5 words with a count of ``least`` or more, and all words as size 0.

    ``docs`` has the columns lang, without nulls, and text. The result has lang, size,
    phrase, n and is stored.
    """
    spark = docs.sparkSession
    place = F.pmod(F.xxhash64("lang", "text", F.spark_partition_id()), F.lit(shards)).alias("shard")
    folder = scratch_path(spark, "shards")
    docs.select("lang", "text", place).write.partitionBy("shard").parquet(folder)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(folder)

    # a phrase with `least` in all shards has a share of it in one of them at least
    share = -(-least // shards)
    state = spark.createDataFrame([], COUNTED)
    scans: dict[int, DataFrame] = {}
    history: deque[list[Field]] = deque(maxlen=shards + 1)
    now = [NOTHING] * (LONGEST + 1)
    step = idle = held = 0
    while idle < shards:
        history.append(now)
        then = history[0] if step >= shards else None
        sizes = [1] if step < shards else []
        for size in range(2, LONGEST + 1):
            before = NOTHING if then is None else then[size - 1]
            if not np.array_equal(now[size - 1].words, before.words):
                sizes.append(size)
        if sizes:
            shard = dealt.filter(F.col("shard") == step % shards)
            scans[step] = common.stored(_added(_scan(shard, sizes, now, then)), "scans")
            heavy = scans[step].filter((F.col("n") >= share) | (F.col("size") == 0)).select(*_KEY)
            new = common.stored(heavy.join(state, _KEY, "left_anti"), "phrases")
            # counts of a phrase that is heavy now for the first time are in the scans of its cycle
            found = new.count()
            held += found
            rows = [_only(scan, new, found) for s, scan in scans.items() if s < step and found]
            rows.append(_only(scans[step], state.select(*_KEY).unionByName(new), held))
            for part in rows:
                state = state.unionByName(part)
            state = common.stored(_added(state), "phrases")
            often = state.filter((F.col("n") >= least) & F.col("size").between(1, LONGEST - 1))
            now = _merged(now, _fields(often))
        scans.pop(step - shards + 1, None)
        idle = idle + 1 if not sizes else 0
        step += 1
    return state.filter((F.col("n") >= least) | (F.col("size") == 0))


_KEY = ["lang", "size", "phrase"]


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_KEY).agg(F.sum("n").alias("n"))


def _only(rows: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """The rows of the phrases in ``keys``, which are broadcast if these are few enough."""
    return rows.join(F.broadcast(keys) if n <= MOST_BROADCAST else keys, _KEY, "left_semi")


def _phrase(words: str, start, length):
    return F.concat_ws(" ", F.slice(words, start, length))


def scored(counts: DataFrame, factor: int) -> DataFrame:
    """Phrases of two words and more with their lowest-scoring cut: a, l, r, n and score."""
    totals = counts.filter("size = 0").select("lang", F.col("n").alias("total"))
    parts = counts.filter(F.col("size") > 0).select("lang", "phrase", "n")
    phrases = counts.filter(F.col("size") > 1).select(
        "lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("words")
    )
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        _phrase("words", F.lit(1), F.col("k")).alias("first"),
        _phrase("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    score = f"""(CAST(a AS DECIMAL(18,0)) * CAST(total AS DECIMAL(18,0)) * CAST({factor} AS DECIMAL(10,0)))
        DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"""
    joined = (
        cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
        .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
        .select("lang", "phrase", "a", "k", "l", "r", "total", F.expr(score).alias("score"))
    )
    lowest = F.min(F.struct("score", "k", "l", "r", F.col("total").alias("n"))).alias("cut")
    return (
        joined.groupBy("lang", "phrase", "a")
        .agg(lowest)
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    )


def covered_by_longer(counts: DataFrame) -> DataFrame:
    """The count of the most frequent longer phrase that contains a phrase."""
    longer = counts.filter(F.col("size") > 2).withColumn("words", F.split("phrase", " "))
    inner = longer.withColumn(
        "length", F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    ).withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    return (
        inner.select("lang", _phrase("words", F.col("start"), F.col("length")).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longest"))
    )


def collocations(
    df: DataFrame,
    least: int = 100,
    top: int = 2000,
    factor: int = 1000,
    covered_percent: int = 100,
    shards: int = 3,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if a longer one that contains it has ``covered_percent`` of its count.
    """
    common.prepare(df.sparkSession)
    docs = df.select(
        F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), common.empty_as(text).alias("text")
    )
    counts = common.stored(
        phrase_counts(docs, least, shards).withColumn("phrase", F.col("phrase").cast("string")), "phrases"
    )
    alone = scored(counts, factor).join(covered_by_longer(counts), ["lang", "phrase"], "left")
    kept = alone.filter(
        F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * covered_percent)
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def sql(least: int = 100, top: int = 2000, factor: int = 1000, covered_percent: int = 100) -> str:
    """The same as DuckDB SQL: every phrase of 1 to 5 words, counted."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH p AS (
      SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    w AS MATERIALIZED (
      SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[ \\x09]+') IF x <> ''] AS w FROM p),
    g AS (
      SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase FROM (
        SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS size))),
    f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= {least}),
    total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    cut AS (
      SELECT c.lang, c.phrase, c.n AS a, k, l.n AS l, r.n AS r, total.n AS n,
        CAST(CAST({factor} AS HUGEINT) * c.n * total.n // (CAST(l.n AS HUGEINT) * r.n) AS BIGINT) AS score
      FROM (SELECT *, string_split(phrase, ' ') AS v, unnest(range(1, size)) AS k FROM f WHERE size > 1) c
      JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(v[1 : k], ' ')
      JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(v[k + 1 :], ' ')
      JOIN total ON total.lang = c.lang),
    best AS (
      SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    sub AS (
      SELECT lang, array_to_string(v[i : i + m - 1], ' ') AS phrase, max(n) AS longest FROM (
        SELECT lang, n, v, m, unnest(range(1, size - m + 2)) AS i FROM (
          SELECT *, string_split(phrase, ' ') AS v, unnest(range(2, size)) AS m FROM f WHERE size > 2))
      GROUP BY ALL)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
      phrase, a, l, r, n, score
    FROM best LEFT JOIN sub USING (lang, phrase)
    WHERE longest IS NULL OR longest * 100 < a * {covered_percent}
    QUALIFY rank <= {top}"""
