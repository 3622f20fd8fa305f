"""Vector codes: a codebook per part of the vectors, fitted in whole numbers only.

Components become whole numbers. Distances need products of whole numbers, which BLAS has
for float64 only, so whole numbers are split into limbs: few bits each, so that every sum
of products of two limbs stays within 2^53 and float64 holds it exactly. The products of
limbs are shifted and added in int64. Nothing is rounded, so ties are real ties, and the
first of the nearest entries is taken on every machine alike.

A round reads the vectors once. A task returns sums and counts per entry, which are added
up by Spark; only codebooks, whose size is fixed, pass through the driver.

Defined results: a null vector, and one with a null or non-finite component, is left out;
a null id sorts last and repeated ids are rows of their own; with fewer vectors than entries
every vector is an entry; no vectors give no rows. Vectors of different lengths, lengths
that do not divide into the parts, and components whose distances exceed a long raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import common

#: Float64 holds whole numbers up to 2^53 exactly.
EXACT_BITS = 53


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 arrays whose sum, shifted by multiples of ``bits``, is ``values``.

    The last limb has the sign, all others are from 0 to 2^bits - 1.
    """
    most = int(max(values.max(initial=0), -1 - values.min(initial=0)))
    n = max(1, -(-most.bit_length() // bits))
    low = [(values >> (bits * i)) & ((1 << bits) - 1) for i in range(n - 1)]
    return [a.astype(np.float64) for a in (*low, values >> (bits * (n - 1)))]


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of two int64 matrices, exactly, if the result fits int64."""
    bits = (EXACT_BITS - max(a.shape[1] - 1, 1).bit_length()) // 2
    out = np.zeros((a.shape[0], b.shape[0]), dtype=np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of the first nearest entry of each row, and the squared distance to it."""
    reach = int(np.abs(x).max(initial=0)) + int(np.abs(entries).max(initial=0))
    if x.shape[1] * reach * reach >= 1 << 63:
        raise OverflowError("squared distances of these components do not fit a long")
    sizes = np.einsum("ij,ij->i", entries, entries)
    apart = sizes[None, :] - 2 * exact_product(x, entries)
    best = apart.argmin(axis=1)
    return best, np.einsum("ij,ij->i", x, x) + apart[np.arange(len(x)), best]


def entry_sums(x: np.ndarray, best: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the rows that chose each of ``n`` entries."""
    chosen = (best[None, :] == np.arange(n)[:, None]).astype(np.int64)
    return exact_product(chosen, np.ascontiguousarray(x.T)), chosen.sum(axis=1)


def whole_numbers(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: str) -> Column:
    """True for a vector whose components are all finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite, F.lit(False))


def _matrices(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple]:
    for batch in batches:
        if batch.num_rows:
            column = batch.column(batch.schema.get_field_index("vector"))
            flat = column.flatten().to_numpy(zero_copy_only=False)
            yield batch, flat.astype(np.int64, copy=False).reshape(batch.num_rows, width)


def _cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(x, parts, axis=1)]


def _round(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round over all vectors."""
    parts, (n, wide) = len(books), books[0].shape

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, n, wide), dtype=np.int64)
        counts = np.zeros((parts, n), dtype=np.int64)
        for _, x in _matrices(batches, parts * wide):
            for p, (part, book) in enumerate(zip(_cut(x, parts), books)):
                added, chosen = entry_sums(part, nearest(part, book)[0], n)
                totals[p] += added
                counts[p] += chosen
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part, wide), pa.int32()),
                pa.array(np.repeat(entry, wide), pa.int32()),
                pa.array(np.tile(np.arange(wide), len(part)), pa.int32()),
                pa.array(totals[part, entry].ravel(), pa.int64()),
                pa.array(np.repeat(counts[part, entry], wide), pa.int64()),
            ],
            names=["part", "entry", "place", "total", "n"],
        )

    schema = "part int, entry int, place int, total long, n long"
    added = (
        rows.select("vector")
        .mapInArrow(sums, schema)
        .groupBy("part", "entry", "place")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    )
    out = [book.copy() for book in books]
    for row in added.collect():  # one row per component of the codebooks
        out[row.part][row.entry, row.place] = int(row.total) // row.n
    return out


def _assigned(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    parts, (_, wide) = len(books), books[0].shape

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches, parts * wide):
            found = [nearest(p, book) for p, book in zip(_cut(x, parts), books)]
            text = np.stack([b for b, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            step = 2 * parts
            codes = [text[i : i + step] for i in range(0, len(text), step)]
            error = np.sum([e for _, e in found], axis=0, dtype=np.int64)
            kept = batch.select(["vec_id", "label"])
            yield common.appended(
                kept, {"code": pa.array(codes, pa.string()), "error": pa.array(error, pa.int64())}
            )

    schema = common.with_fields(rows.select("vec_id", "label"), "code string, error long")
    return rows.mapInArrow(assign, schema)


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal text, by part, entry and place."""
    numbers = ",".join(str(int(v)) for book in books for v in book.ravel())
    return hashlib.sha256(numbers.encode()).hexdigest()


def fitted(rows: DataFrame, parts: int, entries: int, rounds: int) -> list[np.ndarray] | None:
    """Codebooks from the first vectors by id, after ``rounds`` rounds; None without vectors."""
    sizes = rows.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if sizes[0] is None:
        return None
    if sizes[0] != sizes[1] or sizes[0] % parts:
        raise ValueError(f"vectors of {sizes[0]} to {sizes[1]} components, {parts} equal parts")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    start = np.array([r.vector for r in first], dtype=np.int64).reshape(len(first), sizes[0])
    books = _cut(start, parts)
    for _ in range(rounds):
        books = _round(rows, books)
    return books


def compressed(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    names: tuple[str, str, str] = ("vec_id", "embedding", "label"),
) -> DataFrame:
    """Codes of all usable vectors: vec_id, code, error, label_error, codebooks_sha256."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits per part: 1 to 256 entries")
    common.prepare(vectors.sparkSession)
    vec_id, vector, label = names
    rows = common.stored(
        vectors.filter(usable(vector)).select(
            F.col(vec_id).alias("vec_id"),
            F.col(label).alias("label"),
            whole_numbers(vector, scale).alias("vector"),
        ),
        "vectors",
    )
    books = fitted(rows, parts, entries, rounds)
    if books is None:
        empty = "code string, error long, label_error long, codebooks_sha256 string"
        schema = common.with_fields(rows.select("vec_id"), empty)
        return vectors.sparkSession.createDataFrame([], schema)
    coded = common.stored(_assigned(rows, books), "codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )


def sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same as DuckDB SQL, with every distance of every round written out."""
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"""near{i} AS MATERIALIZED (
              SELECT r, p, any_value(x) AS x, min(d * {entries} + e) AS best FROM (
                SELECT r, parts.p, x, e, coalesce(list_sum(
                  [CAST(z[1] - z[2] AS HUGEINT) * (z[1] - z[2]) FOR z IN list_zip(x, c)]), 0) AS d
                FROM parts JOIN book{i} USING (p))
              GROUP BY r, p)"""
        )
        if i < rounds:
            steps.append(
                f"""book{i + 1} AS MATERIALIZED (
                  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN (
                    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY k) AS c FROM (
                      SELECT p, best % {entries} AS e, k, sum(x[k]) AS s, count(*) AS n
                      FROM near{i}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS k)
                      GROUP BY p, best % {entries}, k)
                    GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""
            )
    return f"""WITH kept AS MATERIALIZED (
      SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
        [CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT) FOR x IN embedding] AS v
      FROM embeddings WHERE embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    parts AS MATERIALIZED (
      SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x
      FROM kept, (SELECT unnest(range({parts})) AS p)),
    book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {entries}),
    {", ".join(steps)},
    digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS d FROM book{rounds}),
    coded AS (
      SELECT r, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY p) AS code,
        CAST(sum(best // {entries}) AS BIGINT) AS error
      FROM near{rounds} GROUP BY r)
    SELECT vec_id, code, error,
      CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, d AS codebooks_sha256
    FROM coded JOIN kept USING (r), digest"""
