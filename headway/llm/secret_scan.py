"""Secrets in texts: candidates by pattern, false alarms removed by a random forest.

A candidate is a run of characters that keys are written in, the whole value behind a key
name and an assignment, the password in the user part of a URL, or a whole private-key block.
A name and the sign behind it are never part of it. Its features are length and
kinds of characters, how usual its character transitions are in the corpus, how much of it
is common words of the corpus, whether it looks like a path, host, number or placeholder,
and which words and signs stand next to it. Transitions and word counts cover all texts; a
forest is trained on labelled findings.

Labelled findings may be given. Without them two sources are used: candidates of a sample
of documents that strict rules confirm or rule out, and findings made up from a seed, so
that forms and contexts that the corpus lacks are known too. Candidates on which the rules
are silent are left to the forest.

Defined results: a null text counts as empty and has no candidates; repeated rows get equal
results; an empty table gives no rows, and a forest trained on made-up findings alone.
"""

from __future__ import annotations

import math
import random
import re
import string
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import common
from headway.session import scratch_path

#: Runs of 16 characters or more; "=" is part of one as padding at its end only.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-.~]{16,}(?:={1,2}(?![A-Za-z0-9+/=_\-.~]))?")
#: Characters before and behind a candidate that its features look at.
REACH = 64
#: Documents sampled for findings, about, and findings learned from, at most.
SAMPLE_DOCUMENTS, LEARN_FINDINGS = 20_000, 20_000
#: Made-up findings, half of them secrets, and their seed.
MADE_UP, SEED = 4_000, 7
WORD_BUCKETS = 1 << 18
TREES, DEPTH = 40, 8
#: A candidate is a secret from this share of trees on.
SECRET_FROM = 0.5
MARK = "[SECRET]"

#: Names that keys are kept under, words that announce other hashes, and
#: values that stand in for keys.
KEY_NAMES = re.compile(
    r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer|client[_-]?key|signature)"
)
OTHER_NAMES = re.compile(r"(?i)(commit|sha\d*|md5|checksum|digest|version|uuid|guid|\bid\b|etag|build|revision|blob|tree)")
STAND_INS = re.compile(r"(?i)(example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test[_-]?key|1234567|abcdef0?123)")
KNOWN_FORMS = re.compile(
    r"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,}"
)
#: Values from 8 characters on behind a key name and an assignment: quoted, or up to white
#: space, a quote or the next name of a list.
NAMED_VALUE = re.compile(
    r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth(?!or)|credential|bearer|client[_-]?key|signature)"
    r"[\w-]{0,32}[\"'`]?[ \t]{0,8}(?::=|=>|[=:])[ \t]{0,8}"
    r"(?:\"([^\"\n]{8,})\"|'([^'\n]{8,})'|`([^`\n]{8,})`|[\"'`]?((?:(?![&;,][\w.-]+[=:])[^\s\"'`]){8,}))"
)
#: The marks around a private-key block, and what may stand between them.
BLOCK_MARK = re.compile(r"-----(BEGIN|END) (?:[A-Z0-9]+ ){0,4}PRIVATE KEY(?: BLOCK)?-----")
BLOCK_BODY = re.compile(r"[A-Za-z0-9+/=\s\\:,.-]{32,}")
#: A password of 6 characters or more in the user part of a URL, and what stands before it.
URL_PASSWORD = re.compile(r"://[^\s/:@\"'<>]*:([^\s/@\"'<>]{6,})@")
USER_PART = re.compile(r"://[^\s/:@\"'<>]*:$")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
HOST = re.compile(r"(?i)([a-z0-9-]+\.)+(com|org|net|io|dev|edu|gov|html?|js|py|md|txt|json|jpe?g|png|pdf)\b")
ASSIGNED = re.compile(r"[=:]>?[^\w\s\"']{0,3}\s*[\"'`]?$")
QUOTED = re.compile(r"[\"'`]$")

FEATURES = """length entropy digits uppers lowers others hex changes transitions coverage
    longest_word pathlike hostlike at_sign uuid stand_in known_form assigned quoted named other_named
    word_before distinct names_value user_part""".split()


def candidates(text: str) -> list[tuple[int, int]]:
    """The spans (start, end) of the candidates of a text, in order, none over another.

    A run inside a named value is part of it, but a quoted value with white space gives way
    to the runs in it.
    """
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    named = []
    for m in NAMED_VALUE.finditer(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 4:
            end = start + len(m[4].rstrip(".,;:)]}>&"))
        spaced = any(c.isspace() for c in text[start:end])
        if end - start >= 8 and not (spaced and any(s < end and start < e for s, e in _about(runs, start, end))):
            named.append((start, end))
    named += [m.span(1) for m in URL_PASSWORD.finditer(text)]
    named += _blocks(text)
    if not named:
        return runs
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs + named):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(text: str) -> list[tuple[int, int]]:
    """The spans of whole private-key blocks, marks included."""
    if "PRIVATE KEY" not in text:
        return []
    marks = list(BLOCK_MARK.finditer(text))
    return [
        (a.start(), b.end())
        for a, b in zip(marks, marks[1:])
        if (a[1], b[1]) == ("BEGIN", "END") and BLOCK_BODY.fullmatch(text, a.end(), b.start())
    ]


def _about(runs: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """The runs that may meet the span from ``start`` to ``end``."""
    return runs[max(bisect_left(runs, (start, start)) - 1, 0) : bisect_left(runs, (end, end))]


@dataclass
class Corpus:
    """Logarithms of transition shares, and which word buckets hold common words."""

    transitions: np.ndarray
    common: np.ndarray


def corpus(docs: DataFrame) -> Corpus:
    """Statistics over all texts; two arrays of fixed size reach the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(65536 + WORD_BUCKETS, dtype=np.int64)
        for batch in batches:
            words: Counter = Counter()
            for text in common.raw_texts(batch.column("text")):
                text = text.lower()
                raw = np.frombuffer(text, dtype=np.uint8).astype(np.int64)
                sums[:65536] += np.bincount(raw[:-1] * 256 + raw[1:], minlength=65536)
                words.update(text.split())
            for word, n in words.items():
                word = word.strip(b".,;:!?\"'()|#*$%&")
                if len(word) > 2:
                    sums[65536 + zlib.crc32(word) % WORD_BUCKETS] += n
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])], names=["place", "n"])

    rows = (
        docs.select("text").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    )
    sums = np.zeros(65536 + WORD_BUCKETS)
    sums[rows.column("place").to_numpy()] = rows.column("n").to_numpy()
    pairs = sums[:65536].reshape(256, 256) + 0.5
    words = sums[65536:]
    return Corpus(
        np.log2(pairs / pairs.sum(axis=1, keepdims=True)).astype(np.float32), words > 8 * max(words.mean(), 1.0)
    )


_RUN = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}")


def features(text: str, start: int, end: int, known: Corpus) -> list[float]:
    """The features of the candidate text[start:end], in the order of ``FEATURES``."""
    value = text[start:end]
    before, behind = text[max(start - REACH, 0) : start], text[end : end + 8]
    n = len(value)
    counts = Counter(value)
    raw = value.lower().encode("utf-8", "replace")
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in value]
    steps = [float(known.transitions[a, b]) for a, b in zip(raw, raw[1:])]
    runs = _RUN.findall(value)
    covered = sum(len(r) for r in runs if known.common[zlib.crc32(r.lower().encode()) % WORD_BUCKETS])
    near = before[-40:]
    words = re.findall(r"[^\W\d_]{2,}", before)
    last = words[-1].lower() if words else ""
    user_part = behind[:1] == "@" and bool(USER_PART.search(before))
    return [
        float(n),
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        kinds.count(0) / n,
        kinds.count(1) / n,
        kinds.count(2) / n,
        kinds.count(3) / n,
        sum(c in string.hexdigits for c in value) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        sum(steps) / len(steps),
        covered / n,
        max(map(len, runs), default=0) / n,
        float(value.count("/") >= 2 or before[-1:] in ("/", "\\")),
        float(bool(HOST.search(value))),
        float((before[-1:] == "@" or behind[:1] == "@") and not user_part),
        float(bool(UUID.search(value))),
        float(bool(STAND_INS.search(value))),
        float(bool(KNOWN_FORMS.search(value))),
        float(bool(ASSIGNED.search(before))),
        float(bool(QUOTED.search(before))),
        float(bool(KEY_NAMES.search(near))),
        float(bool(OTHER_NAMES.search(near))),
        zlib.crc32(last.encode()) % 64 / 64,
        len(counts) / n,
        float(behind[:1] == "="),
        float(user_part),
    ]


_AT = {name: i for i, name in enumerate(FEATURES)}


def by_rule(f: list[float]) -> int | None:
    """1 if strict rules confirm a candidate, 0 if they rule it out, None if they are silent."""
    get = lambda name: f[_AT[name]]
    if get("user_part"):
        return 0 if get("stand_in") or get("coverage") > 0.6 or get("entropy") < 2.5 else 1
    if get("stand_in") or get("hostlike") or get("uuid") or get("at_sign"):
        return 0
    if get("coverage") > 0.6 or get("entropy") < 2.5:
        return 0
    held = get("assigned") and get("named")
    # letters in words' cases and bare numbers may still be keys behind a key name
    plain = get("digits") == 1.0 or (get("digits") == 0.0 and get("changes") < 0.2)
    if plain:
        return None if held and not get("names_value") else 0
    if get("known_form"):
        return 1
    if held and not get("pathlike") and get("length") >= 20 and get("entropy") >= 3:
        return 1
    return 0 if get("other_named") and not get("named") else None


def made_up(n: int = MADE_UP, seed: int = SEED) -> list[tuple[str, int, int, int]]:
    """Findings (text, start, end, secret) of common forms in common contexts, with the spans of a scan.

    About ``n`` findings: values that a scan would not see give none.
    """
    rng = random.Random(seed)
    letters = string.ascii_letters + string.digits

    def some(alphabet: str, size: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(size))

    def word() -> str:
        return "".join(rng.choice("bcdfghlmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))

    keys = [
        lambda: some("0123456789abcdef", rng.choice([32, 40, 64])),
        lambda: some("0123456789ABCDEF", rng.choice([32, 40, 64])),
        lambda: some(letters, rng.randint(20, 64)),
        lambda: some(letters + "+/", rng.choice([40, 44, 64])) + rng.choice(["", "="]),
        lambda: some(string.ascii_letters, rng.randint(20, 48)),
        lambda: some(rng.choice([string.ascii_lowercase, string.ascii_uppercase]), rng.randint(20, 40)),
        lambda: some(letters + "!@#$%^*", rng.randint(8, 24)),
        lambda: "AKIA" + some(string.ascii_uppercase + string.digits, 16),
        lambda: "ghp_" + some(letters, 36),
        lambda: "sk_live_" + some(letters, 24),
        lambda: f"eyJ{some(letters, 20)}.{some(letters, 40)}.{some(letters, 40)}",
    ]
    line = lambda: some(letters + "+/", 64)
    bare = keys[-4:] + [
        lambda: f"xoxb-{some(string.digits, 11)}-{some(letters, 24)}",
        lambda: rng.choice(["gho_", "ghs_", "ghu_"]) + some(letters, 36),
        lambda: "-----BEGIN {0}PRIVATE KEY-----\n{1}\n-----END {0}PRIVATE KEY-----".format(
            rng.choice(["", "RSA ", "EC ", "OPENSSH "]), "\n".join(line() for _ in range(rng.randint(2, 26)))
        ),
    ]
    bare_holders = ["{1}", "'{1}'", "({1})", "{1},", "see {1}.", "{1};"]
    user_holders = ["postgres://admin:{1}@db.internal/app", "https://bot:{1}@host.example.net/x", "amqp://{0}:{1}@mq:5672"]
    names = ["token", "TOKEN", "api_key", "secret", "password", "Authorization: Bearer", "access-key", "auth"]
    names += ["SERVICE_AUTH_TOKEN", "aws_secret_access_key", "DATABASE_PASSWORD"]
    holders = ['{0} = "{1}"', "{0}={1}", "{0}: {1}", '"{0}": "{1}"', "{0} '{1}'", '{0}###  =%%% "{1}"$$$', "?{0}={1}&"]
    harmless = [
        (lambda: some("0123456789abcdef", 40), ["commit", "blob", "tree", "revision"]),
        (lambda: some("0123456789abcdef", 64), ["sha256", "checksum", "digest"]),
        (lambda: "-".join(some("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)), ["id", "uuid", "token", "guid"]),
        (lambda: some(string.digits, rng.randint(16, 24)), ["number", "card", "", "token"]),
        (lambda: "".join(word() for _ in range(rng.randint(6, 9)))[:40].ljust(16, "a"), ["", "the", "of"]),
        (lambda: "/" + "/".join(word() for _ in range(rng.randint(4, 7))) + "/index.html", ["see", "in", ""]),
        (lambda: ".".join(word() for _ in range(3)) + ".example.com", ["at", "host", "auth"]),
        (lambda: rng.choice(["xxxxxxxxxxxxxxxxxxxx", "your_api_key_goes_here", "changeme_changeme_1", "example-token-0001"]), names),
        (lambda: "_".join(word() for _ in range(rng.randint(4, 8))).ljust(16, "a"), ["def", "let", "token", "import"]),
        (lambda: "=" * rng.randint(16, 40), ["", "title"]),
        (lambda: "".join(word() for _ in range(4))[:14].ljust(8, "a"), names),
        (lambda: rng.choice(".|_|->|::".split("|")).join(word() for _ in range(3)) + rng.choice(["", "()"]), names),
        (lambda: " ".join(word() for _ in range(rng.randint(3, 6))), names),
    ]
    out = []
    for i in range(n):
        secret, holder = i % 2, rng.choice(holders)
        if secret:
            value, name = rng.choice(keys)(), rng.choice(names)
            place = rng.random()  # a third of the secrets stand without a name
            if place < 0.25:
                value, holder = rng.choice(bare)(), rng.choice(bare_holders)
            elif place < 0.33:
                value, name, holder = some(letters + "!$%^*", rng.randint(8, 24)), "user", rng.choice(user_holders)
        else:
            form, befores = rng.choice(harmless)
            value, name = form(), rng.choice(befores)
            if rng.random() < 0.2:  # neither a name nor its lack decides
                holder = rng.choice(bare_holders)
        lead = " ".join(word() for _ in range(rng.randint(0, 6)))
        text = f"{lead} {holder.format(name, value)} {word()} {word()}"
        start = text.index(value, len(lead) + 1)
        for s, e in candidates(text):
            out.append((text, s, e, int(secret and s < start + len(value) and start < e)))
    return out


@dataclass
class Forest:
    """Trees as arrays: feature (or -1), threshold, children and share of secrets, for each node."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def share(self, rows: np.ndarray) -> np.ndarray:
        """The mean over trees of the share of secrets in the leaf of each row."""
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH + 1):
                inner = feature[at] >= 0
                lower = rows[each, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(lower, left[at], right[at]), at)
            total += share[at]
        return total / max(len(self.trees), 1)


def grown(findings: DataFrame) -> Forest:
    """A forest from findings (features, secret); its nodes are read from its stored form."""
    spark = findings.sparkSession
    rows = findings.select(array_to_vector("features").alias("features"), F.col("secret").cast("double").alias("label"))
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=3).fit(rows)
    path = scratch_path(spark, "forest")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    trees: dict[int, list] = {}
    for r in stored.collect():  # at most TREES * 2^(DEPTH + 1) nodes
        trees.setdefault(r.treeID, []).append(r)
    out = []
    for nodes in (trees[k] for k in sorted(trees)):
        nodes = sorted(nodes, key=lambda r: r.id)
        inner = [r.split.featureIndex if r.leftChild >= 0 else -1 for r in nodes]
        cuts = [r.split.leftCategoriesOrThreshold[0] if r.leftChild >= 0 else 0.0 for r in nodes]
        shares = [r.impurityStats[1] / sum(r.impurityStats) for r in nodes]
        children = [np.array([r[c] for r in nodes]) for c in ("leftChild", "rightChild")]
        out.append((np.array(inner), np.array(cuts), *children, np.array(shares)))
    return Forest(out)


def sampled_upto(rows: int) -> int:
    """The greatest signed 64-bit hash of the sample, of so many rows."""
    return min(SAMPLE_DOCUMENTS * 2**64 // max(rows, 1), 2**64) - 2**63 - 1


def rule_findings(docs: DataFrame, known: Corpus) -> DataFrame:
    """Findings (features, secret) of a sample of documents on which the rules speak.

    Documents are chosen by a hash of id and text, so about ``SAMPLE_DOCUMENTS`` come at any size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in common.plain_texts(batch.column("text")):
                for span in candidates(text):
                    found = features(text, *span, shared.value)
                    if (secret := by_rule(found)) is not None:
                        rows.append((found, secret))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in rows], pa.list_(pa.float64())), pa.array([s for _, s in rows], pa.int32())],
                names=["features", "secret"],
            )

    sample = docs.filter(F.xxhash64("doc_id", "text") <= F.lit(sampled_upto(docs.count())))
    return (
        sample.select("text")
        .mapInArrow(label, "features array<double>, secret int")
        .orderBy(F.xxhash64("features"))
        .limit(LEARN_FINDINGS)
    )


def fit(docs: DataFrame, findings: DataFrame | None = None) -> tuple[Corpus, Forest]:
    """Corpus statistics and a forest. ``findings`` has text, start, end and secret."""
    spark = docs.sparkSession
    known = corpus(docs)
    given = made_up()
    if findings is not None:
        taken = common.sampled(findings.select("text", "start", "end", "secret"), LEARN_FINDINGS, "text", "start", "end")
        given += [tuple(r) for r in taken.collect()]
    rows = [(features(t, s, e, known), int(secret)) for t, s, e, secret in given]
    learned = spark.createDataFrame(rows, "features array<double>, secret int").coalesce(1)
    if findings is None:
        learned = learned.unionByName(common.stored(rule_findings(docs, known), "findings"))
    return known, grown(learned)


def findings(texts: list[str], known: Corpus, forest: Forest) -> list[list[tuple[int, int, float]]]:
    """For each text its candidates (start, length, share of trees that call it a secret)."""
    spans = [candidates(t) for t in texts]
    rows = [features(t, s, e, known) for t, found in zip(texts, spans) for s, e in found]
    shares = forest.share(np.array(rows)).tolist() if rows else []
    out, at = [], 0
    for found in spans:
        out.append([(s, e - s, p) for (s, e), p in zip(found, shares[at : at + len(found)])])
        at += len(found)
    return out


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_candidates, n_secrets and the findings.

    Starts and lengths count characters of the text.
    """
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    kind = pa.list_(
        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64()), ("secret", pa.bool_())])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = findings(common.plain_texts(batch.column("text")), *shared.value)
            spans = [
                [{"start": s, "length": n, "score": p, "secret": p >= SECRET_FROM} for s, n, p in found] for found in each
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(f) for f in each], pa.int64()),
                    pa.array([sum(x["secret"] for x in f) for f in spans], pa.int64()),
                    pa.array(spans, kind),
                ],
                names=["doc_id", "n_candidates", "n_secrets", "findings"],
            )

    schema = """doc_id long, n_candidates long, n_secrets long,
        findings array<struct<start: long, length: long, score: double, secret: boolean>>"""
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by ``MARK``; n_chars, if there, follows the text."""
    common.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    place = docs.columns.index("text")
    sizes = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def without(text: str, found: list[tuple[int, int, float]]) -> str:
        for start, length, share in reversed(found):
            if share >= SECRET_FROM:
                text = text[:start] + MARK + text[start + length :]
        return text

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = common.plain_texts(columns[place])
            after = [without(t, f) for t, f in zip(texts, findings(texts, *shared.value))]
            was = columns[place].is_valid().to_pylist()
            changed = [a != b for a, b in zip(texts, after)]
            columns[place] = pa.array([a if v else None for a, v in zip(after, was)], columns[place].type)
            if sizes is not None:
                old = columns[sizes].to_pylist()
                columns[sizes] = pa.array(
                    [len(a) if c else o for a, c, o in zip(after, changed, old)], columns[sizes].type
                )
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
