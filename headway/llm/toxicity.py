"""Toxic passages by maximum-scoring segments of token log-odds.

Learning: labelled texts give counts of tokens in toxic and other texts. The share of toxic
occurrences of a token has a Dirichlet prior around the share of its longest shorter
prefix, and so on to the share of all tokens; rare tokens stay close to their prior. The
score of a token is the log-odds of its share against that of all tokens, less a drift
that makes the expected score negative.

Scoring: a scan that is linear in the tokens finds every maximal segment of a text. The
best segment of a harmless text follows an extreme-value (Gumbel) law that shifts with the
logarithm of the length; it gives each segment a p-value. A text's evidence is that of its
significant segments, and a logistic curve turns it into a score from 0 to 1.

Counts for the calibration come from the other half of the labelled texts, so that no text
is judged by counts that it is part of. Labels, languages, sources and ids are no input of
a score.

Defined results: null and empty texts have no tokens and get the score of no evidence;
labels that are null are left out, and of repeated labels the largest counts; repeated
documents get equal scores; without labels of both kinds every score is 0.5; an empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import common

#: Labelled rows that are learned from at most, and those of them that calibrate. The rows
#: with the least hashes are taken, so that they are the same in every run.
LEARN_ROWS, CALIBRATE_ROWS = 60_000, 20_000
#: Buckets for counts. Tokens and prefixes that share one add up.
BUCKETS = 1 << 18
#: Lengths of the prefixes a token's prior comes from.
PREFIXES = (3, 5, 7)
#: Strength of a prior, in tokens.
PRIOR = 40.0
#: Taken off every log-odds.
DRIFT = 0.5
#: Segments are significant at this p-value.
SIGNIFICANT = 0.05
#: Tokens whose scores a worker remembers.
REMEMBERED = 400_000
#: A document is toxic from this score on.
TOXIC_FROM = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def parts(word: bytes) -> list[int]:
    """Buckets of a word's prefixes, shortest first, and of the word."""
    token = _EDGES.sub("", word.decode("utf-8", "replace").lower())
    if not token:
        return []
    shorter = [token[:n] for n in PREFIXES if len(token) > n]
    return [zlib.crc32(p.encode()) % BUCKETS for p in [*shorter, token + "$"]]


@dataclass
class Model:
    """Counts of tokens by bucket, in toxic and in all learned texts."""

    toxic: np.ndarray
    total: np.ndarray
    base: float

    def token(self, word: bytes) -> float:
        share = self.base
        for bucket in parts(word):
            share = (self.toxic[bucket] + PRIOR * share) / (self.total[bucket] + PRIOR)
        return float(_logit(share) - _logit(self.base)) - DRIFT


class Scores(dict):
    """Scores by word, worked out when a word is first met."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        score = self[word] = self.model.token(word)
        return score


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """Every maximal scoring segment (start, end, score), left to right, in linear time.

    Each positive score opens a candidate. A candidate looks for the last earlier one that
    starts from a lower running sum: if that one also ends lower, both and all between
    are joined, and the joined candidate looks on.
    """
    sums = np.concatenate([[0.0], np.cumsum(np.asarray(scores, dtype=np.float64))])
    positive = np.flatnonzero(sums[1:] > sums[:-1])
    found: list[tuple[int, int, float, float, int]] = []
    for start, low, high in zip(positive.tolist(), sums[positive].tolist(), sums[positive + 1].tolist()):
        end = start + 1
        at = len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= low:
                at = found[at][4]
            if at < 0 or found[at][3] >= high:
                found.append((start, end, low, high, at))
                break
            start, low, behind = found[at][0], found[at][2], found[at][4]
            del found[at:]
            at = behind
    return [(s, e, high - low) for s, e, low, high, _ in found]


@dataclass
class Calibration:
    """The extreme-value law of harmless texts, and the curve from evidence to score."""

    shift: float
    slope: float
    scale: float
    weights: np.ndarray

    def surprise(self, score: float, tokens: int) -> float:
        """Minus the logarithm of the p-value of a segment in a text of so many tokens."""
        z = (score - self.shift - self.slope * math.log(tokens + 1)) / self.scale
        return z if z > 30 else -math.log(max(-math.expm1(-math.exp(-z)), 1e-300))

    def evidence(self, found: list[tuple[int, int, float]], tokens: int) -> list[float]:
        least = -math.log(SIGNIFICANT)
        each = [self.surprise(s, tokens) for _, _, s in found]
        strong = [x for x in each if x >= least]
        return [1.0, min(max(each, default=0.0), 60.0), math.log1p(sum(strong)), math.log1p(len(strong))]

    def score(self, evidence: list[float]) -> float:
        return float(1 / (1 + math.exp(-float(np.clip(self.weights @ evidence, -30, 30)))))


def learning_rows(labels: DataFrame) -> DataFrame:
    """At most ``LEARN_ROWS`` labelled ids outside the held-out third: (doc_id, toxic, place)."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    each = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return common.sampled(each, LEARN_ROWS, "doc_id").select(
        "doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), F.xxhash64("doc_id").alias("place")
    )


def token_counts(learning: DataFrame) -> DataFrame:
    """Counts (half, toxic, bucket, n) over texts (text, toxic, half)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, BUCKETS + 1), dtype=np.int64)
        for batch in batches:
            seen: list[dict[bytes, int]] = [{}, {}, {}, {}]
            kinds = zip(batch.column("half").to_pylist(), batch.column("toxic").to_pylist())
            for (half, toxic), text in zip(kinds, common.raw_texts(batch.column("text"))):
                have = seen[2 * half + toxic]
                for word in text.split():
                    have[word] = have.get(word, 0) + 1
            for kind, have in enumerate(seen):
                for word, n in have.items():
                    places = parts(word)
                    sums[kind, places] += n
                    sums[kind, BUCKETS] += n * bool(places)
        kinds, buckets = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (kinds // 2, kinds % 2, buckets, sums[kinds, buckets])],
            names=["half", "toxic", "bucket", "n"],
        )

    schema = "half long, toxic long, bucket long, n long"
    counted = learning.select("half", "toxic", "text").mapInArrow(count, schema)
    return counted.groupBy("half", "toxic", "bucket").agg(F.sum("n").alias("n"))


def models(counted: DataFrame) -> list[Model] | None:
    """Models of the first half, the second half and both; None without both kinds of text.

    At most four counts for each of ``BUCKETS`` buckets reach the driver.
    """
    rows = counted.select(*(F.col(c).cast("int") for c in ("half", "toxic", "bucket")), "n").toArrow()
    sums = np.zeros((2, 2, BUCKETS + 1), dtype=np.float32)
    sums[tuple(rows.column(c).to_numpy() for c in ("half", "toxic", "bucket"))] = rows.column("n").to_numpy()
    out = []
    for pick in (sums[0], sums[1], sums.sum(axis=0)):
        total = pick.sum(axis=0)
        if not 0 < pick[1, BUCKETS] < total[BUCKETS]:
            return None
        base = pick[1, BUCKETS] / total[BUCKETS]
        out.append(Model(pick[1], total, float(base)))
    return out


def extreme_law(best: np.ndarray, tokens: np.ndarray, toxic: np.ndarray) -> Calibration:
    """The law of the best segments of harmless texts, without a curve yet."""
    size = np.log(tokens + 1)
    calm = toxic == 0
    slope, shift = np.polyfit(size[calm], best[calm], 1) if np.ptp(size[calm]) > 0 else (0.0, best[calm].mean())
    slope = max(float(slope), 0.0)
    rest = best[calm] - slope * size[calm]
    scale = max(float(rest.std()) * math.sqrt(6) / math.pi, 0.1)
    return Calibration(float(rest.mean()) - 0.5772156649 * scale, slope, scale, np.zeros(4))


def calibrated(law: Calibration, x: np.ndarray, toxic: np.ndarray) -> Calibration:
    """The law with a curve from the evidence ``x`` to the labels."""
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.array([1e-6, 1e-2, 1e-2, 1e-2])
        grad = x.T @ (p - toxic) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Calibration(law.shift, law.slope, law.scale, w)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, Calibration] | None:
    spark = docs.sparkSession
    rows = common.stored(learning_rows(labels), "labelled")
    known = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
    learning = known.withColumn("half", F.pmod("place", F.lit(2)).cast("int"))
    fitted = models(token_counts(learning))
    if fitted is None:
        return None
    shared = spark.sparkContext.broadcast(fitted[:2])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_half = [Scores(shared.value[1]), Scores(shared.value[0])]
        for batch in batches:
            sizes, found = [], []
            halves, texts = batch.column("half").to_pylist(), common.raw_texts(batch.column("text"))
            for half, text in zip(halves, texts):
                words = text.split()
                sizes.append(len(words))
                found.append([s for _, _, s in segments([by_half[half][w] for w in words])])
            columns = [batch.column("toxic"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "tokens", "scores"])

    chosen = rows.orderBy("place", "doc_id").limit(CALIBRATE_ROWS)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # one text of each id, however often the id repeats
    sample = sample.groupBy("doc_id").agg(
        F.min_by(F.struct("text", "toxic", (F.pmod("place", F.lit(2)).cast("int")).alias("half")), F.xxhash64("text")).alias("r")
    )
    seen = common.stored(
        sample.select("r.half", "r.toxic", "r.text").mapInArrow(scan, "toxic int, tokens long, scores array<double>"),
        "segments",
    )
    got = seen.select("toxic", "tokens", F.coalesce(F.array_max("scores"), F.lit(0.0)).alias("best")).toArrow()
    best, tokens, toxic = (got.column(c).to_numpy().astype(float) for c in ("best", "tokens", "toxic"))
    if not 0 < toxic.sum() < len(toxic):
        return None
    law = extreme_law(best, tokens, toxic)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("scores").to_pylist(), batch.column("tokens").to_pylist())
            each = [law.evidence([(0, 0, s) for s in scores], n) for scores, n in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(each, pa.list_(pa.float64()))], names=["toxic", "evidence"]
            )

    # four numbers for each of CALIBRATE_ROWS texts at most
    told = seen.mapInArrow(weigh, "toxic int, evidence array<double>").toArrow()
    x = np.array(told.column("evidence").to_pylist())
    return fitted[2], calibrated(law, x, told.column("toxic").to_numpy().astype(float))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def scored(docs: DataFrame, fitted: tuple[Model, Calibration] | None, text: str, names: list[str]) -> DataFrame:
    """``docs`` with a score and the significant segments under ``names``.

    A segment is (start, length) in UTF-8 bytes of the text, score and p_value.
    """
    place = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    fields = {"start": pa.int64(), "length": pa.int64(), "score": pa.float64(), "p_value": pa.float64()}
    kind = pa.list_(pa.struct(list(fields.items())))

    def judge(scores: Scores, law: Calibration, raw: bytes) -> tuple[float, list[dict]]:
        words = raw.split()
        found = segments([scores[w] for w in words])
        strong = [
            (s, e, x, surprise)
            for s, e, x in found
            if (surprise := law.surprise(x, len(words))) >= -math.log(SIGNIFICANT)
        ]
        spans = []
        if strong:
            at = [m.span() for m in _WORD.finditer(raw)]
            spans = [
                {"start": at[s][0], "length": at[e - 1][1] - at[s][0], "score": x, "p_value": math.exp(-p)}
                for s, e, x, p in strong
            ]
        return law.score(law.evidence(found, len(words))), spans

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = Scores(model[0]) if model else None
        for batch in batches:
            texts = common.raw_texts(batch.column(place))
            out = [judge(scores, model[1], t) if model else (0.5, []) for t in texts]
            yield common.appended(
                batch,
                {names[0]: pa.array([s for s, _ in out], pa.float64()), names[1]: pa.array([p for _, p in out], kind)},
            )

    segment = "struct<start: long, length: long, score: double, p_value: double>"
    added = f"`{names[0]}` double, `{names[1]}` array<{segment}>"
    return docs.mapInArrow(run, common.with_fields(docs, added))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and the toxic segments."""
    common.prepare(docs.sparkSession)
    rows = scored(docs.select("doc_id", "text"), fit(docs, labels), "text", ["score", "segments"])
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "segments",
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with the columns of ``docs``."""
    common.prepare(docs.sparkSession)
    names = common.fresh(docs, "score", "segments")
    rows = scored(docs, fit(docs, labels), "text", names)
    return rows.filter(F.col(f"`{names[0]}`") < TOXIC_FROM).drop(*names)
