"""Quality rules whose thresholds follow each language and source.

Every text gets counts of words, symbols, repeated lines and repeated word windows, and
rates derived from them. For each language and source the rates are summarised in
quantile sketches: counts by logarithmic bucket with a bounded relative error. Sketches
merge by adding counts, so those of a language and of the whole table come from those of
the sources, and the result does not depend on how rows are split. A rate is an outlier if
it lies further beyond the quartiles than ``REACH`` times the distance between them.

Defined results: a null text counts as empty and fails the base rule; null languages and
sources are groups of their own; a group with fewer than ``LEAST_ROWS`` rows takes the
thresholds of its language, and a language with fewer those of all rows; an empty table
gives no rows. Rows are judged one by one, so repeated rows get equal results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import common

SYMBOLS = b"#*$%&|<>"
#: Relative width of a sketch's buckets, and the least value that is told from zero.
ACCURACY, LEAST_VALUE = 0.02, 1e-4
#: A group's own quartiles are used from so many rows on.
LEAST_ROWS = 200
#: Distance between quartiles beyond which a value is an outlier, in such distances.
REACH = 4.0
#: Rates, and the distance between quartiles that is assumed at least.
RATES = {
    "symbol_rate": 0.01,
    "capital_rate": 0.04,
    "repeat_rate": 0.10,
    "dup_line_rate": 0.10,
    "word_length": 1.0,
}
#: Rates for which low values are outliers too.
TWO_SIDED = {"word_length"}
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FEATURES = f"{BASE}, n_lines long, n_capitals long"


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice, the first time included."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    _, pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
    windows = pairs[:-1].astype(np.int64) * len(known) + ids[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[place] > 1)
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[twice + shift] = True
    return int(inside.sum())


def counts(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``FEATURES``."""
    words = text.split()
    in_words = sum(map(len, words))
    points = len(text.translate(None, _CONTINUES))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        points - (len(text) - in_words),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(text) - len(text.translate(None, _CAPITALS)),
    )


#: Bytes of UTF-8 that continue a code point.
_CONTINUES = bytes(range(0x80, 0xC0))
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def with_counts(docs: DataFrame, text: str, names: list[str]) -> DataFrame:
    """``docs`` with the columns of ``FEATURES`` under ``names``."""
    place = docs.columns.index(text)

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = [counts(t) for t in common.raw_texts(batch.column(place))]
        columns = zip(*found) if found else [()] * len(names)
        return {n: pa.array(c, pa.int64()) for n, c in zip(names, columns)}

    return common.add_columns(docs, ", ".join(f"`{n}` long" for n in names), work)


def feature_names() -> list[str]:
    return [f.split()[0] for f in FEATURES.split(", ")]


def base_failed(c: dict[str, Column]) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def rates(c: dict[str, Column]) -> dict[str, Column]:
    words, chars = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["word_chars"], F.lit(1))
    return {
        "symbol_rate": c["n_symbols"] / chars,
        "capital_rate": c["n_capitals"] / chars,
        "repeat_rate": c["n_repeat_words"] / words,
        "dup_line_rate": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)),
        "word_length": chars / words,
    }


_STEP = math.log((1 + ACCURACY) / (1 - ACCURACY))


def _bucket(value: Column) -> Column:
    least = F.lit(LEAST_VALUE)
    return F.when(value < least, F.lit(0)).otherwise(
        F.ceil(F.log(F.greatest(value, least) / least) / _STEP).cast("int") + 1
    )


def _value(bucket: Column) -> Column:
    middle = LEAST_VALUE * 2 / (1 + math.exp(_STEP))
    return F.when(bucket == 0, F.lit(0.0)).otherwise(F.exp((bucket - 1) * _STEP) * middle)


def sketches(rows: DataFrame, lang: str, source: str, c: dict[str, Column]) -> DataFrame:
    """Counts by language, source, rate and bucket, over the rows that pass the base rule."""
    each = F.array(
        *(
            F.struct(F.lit(i).alias("rate"), _bucket(r).alias("bucket"))
            for i, r in enumerate(rates(c).values())
        )
    )
    return (
        rows.filter(~base_failed(c))
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(each).alias("e"))
        .groupBy("lang", "source", "e.rate", "e.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))


def quartiles(parts: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, rate, rows, low, high): the quartiles of each merged sketch.

    A sketch has a bounded number of buckets, so each is folded inside one row.
    """
    ordered = parts.groupBy(*keys, "rate").agg(
        F.sum("n").alias("rows"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("b")
    )

    def at(share: float) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).alias("at"))

        def step(state: Column, item: Column) -> Column:
            seen = state["seen"] + item["n"]
            reached = (state["at"] < 0) & (seen >= F.ceil(F.col("rows") * share))
            return F.struct(
                seen.alias("seen"), F.when(reached, item["bucket"]).otherwise(state["at"]).alias("at")
            )

        return _value(F.aggregate("b", start, step, lambda s: s["at"]))

    return ordered.select(*keys, "rate", "rows", at(0.25).alias("low"), at(0.75).alias("high"))


def thresholds(parts: DataFrame) -> DataFrame:
    """Rows (lang, source, bounds): an array of (low, high) in the order of ``RATES``."""
    by_lang = merged(parts, "lang")
    levels = [
        quartiles(parts, "lang", "source").alias("g"),
        quartiles(by_lang, "lang").alias("l"),
        quartiles(merged(by_lang)).alias("a"),
    ]
    same = (F.col("g.rate") == F.col("l.rate")) & F.col("g.lang").eqNullSafe(F.col("l.lang"))
    joined = levels[0].join(levels[1], same, "left").join(
        levels[2], F.col("g.rate") == F.col("a.rate"), "left"
    )

    def pick(name: str) -> Column:
        return (
            F.when(F.col("g.rows") >= LEAST_ROWS, F.col(f"g.{name}"))
            .when(F.col("l.rows") >= LEAST_ROWS, F.col(f"l.{name}"))
            .otherwise(F.col(f"a.{name}"))
        )

    floor = F.element_at(F.array(*map(F.lit, RATES.values())), F.col("rate") + 1)
    two_sided = F.array(*(F.lit(r in TWO_SIDED) for r in RATES))
    spread = REACH * F.greatest(F.col("high") - F.col("low"), floor)
    return (
        joined.select("g.lang", "g.source", "g.rate", pick("low").alias("low"), pick("high").alias("high"))
        .groupBy("lang", "source")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "rate",
                        F.when(F.element_at(two_sided, F.col("rate") + 1), F.col("low") - spread)
                        .otherwise(F.lit(float("-inf")))
                        .alias("low"),
                        (F.col("high") + spread).alias("high"),
                    )
                )
            ).alias("bounds")
        )
    )


def judged(rows: DataFrame, lang: str, source: str, c: dict[str, Column], keep: list[Column]) -> DataFrame:
    """Rows with ``keep`` and, behind them, base_failed, reasons and kept.

    ``c`` names the count columns of ``rows``. The thresholds are stored first: as a small
    table they reach every task, and as a large one they are joined by key.
    """
    bounds = common.stored(thresholds(sketches(rows, lang, source, c)), "thresholds")
    joined = rows.alias("d").join(
        bounds.alias("t"),
        F.col(f"d.`{lang}`").eqNullSafe(F.col("t.lang"))
        & F.col(f"d.`{source}`").eqNullSafe(F.col("t.source")),
        "left",
    )
    outliers = [
        F.when(
            (value < F.col("t.bounds")[i]["low"]) | (value > F.col("t.bounds")[i]["high"]), F.lit(name)
        )
        for i, (name, value) in enumerate(rates(c).items())
    ]
    failed = base_failed(c)
    reasons = F.filter(
        F.concat(F.array(F.when(failed, F.lit("base"))), F.array(*outliers)), lambda r: r.isNotNull()
    )
    return joined.select(
        *keep, failed.alias("base_failed"), reasons.alias("reasons"), (F.size(reasons) == 0).alias("kept")
    )


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, reasons and kept."""
    common.prepare(docs.sparkSession)
    names = feature_names()
    rows = common.stored(
        with_counts(docs.select("doc_id", "lang", "source", "text"), "text", names).drop("text"), "counts"
    )
    c = {n: F.col(f"d.{n}") for n in names}
    return judged(rows.alias("d"), "lang", "source", c, [F.col("d.doc_id"), *c.values()])


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    common.prepare(docs.sparkSession)
    names = common.fresh(docs, *feature_names())
    rows = common.stored(with_counts(docs, "text", names), "counted").alias("d")
    c = {n: F.col(f"d.`{m}`") for n, m in zip(feature_names(), names)}
    verdict = judged(rows, "lang", "source", c, [F.struct("d.*").alias("_row")])
    return verdict.filter("kept").select("_row.*").select(*(f"`{n}`" for n in docs.columns))
