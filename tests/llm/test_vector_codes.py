"""Exact products, codebooks and codes against whole numbers in Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

import __spark_entry__ as registered
import check
from headway.llm import vector_codes


@pytest.mark.parametrize("reach", [1, 2**10, 2**27, 2**29])
def test_products_are_exact(reach):
    rng = np.random.default_rng(reach)
    a, b = rng.integers(-reach, reach + 1, (40, 9)), rng.integers(-reach, reach + 1, (7, 9))
    a[0], b[0] = -reach, reach
    wanted = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert vector_codes.exact_product(a, b).tolist() == wanted


def test_products_that_float64_would_round():
    a = np.array([[2**27 + 1, 2**27 + 1]])
    assert vector_codes.exact_product(a, a)[0, 0] == 2 * (2**27 + 1) ** 2 != int(float(2 * (2**27 + 1) ** 2))


def test_limbs_add_up():
    values = np.array([[-(2**40), -1, 0, 1, 2**40 - 1, 12345678901]])
    parts = vector_codes.limbs(values, 11)
    assert sum(p.astype(np.int64) << (11 * i) for i, p in enumerate(parts)).tolist() == values.tolist()
    assert all((np.abs(p) <= 2**11).all() for p in parts)


def test_first_of_equal_entries_wins():
    best, error = vector_codes.nearest(np.array([[0, 0], [3, 3]]), np.array([[1, 0], [0, 1], [1, 0], [3, 3]]))
    assert best.tolist() == [0, 3] and error.tolist() == [1, 0]


def test_distances_beyond_a_long_raise():
    with pytest.raises(OverflowError):
        vector_codes.nearest(np.array([[2**32, 0]]), np.array([[0, 0]]))


def brute_force(rows, parts, entries, rounds):
    kept = [(i, [floor_of(x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    wide = len(kept[0][1]) // parts
    cut = [[v[p * wide : (p + 1) * wide] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))
    books = [[cut[r][p] for r in order[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            chosen = {}
            for x in cut:
                chosen.setdefault(near(x[p], books[p])[1], []).append(x[p])
            for e, xs in chosen.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for (vec_id, _, label), x in zip(kept, cut):
        found = [near(x[p], books[p]) for p in range(parts)]
        out.append((vec_id, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    by_label = {}
    for row in out:
        by_label[row[3]] = by_label.get(row[3], 0) + row[2]
    digest = vector_codes.books_digest([np.array(b) for b in books])
    return [(i, code, error, by_label[label], digest) for i, code, error, label in out]


def floor_of(x):
    return math.floor(4096 * x)


def some_rows(n, seed=5):
    rng = random.Random(seed)
    rows = [(rng.choice([i, i, 3]), [rng.choice([rng.uniform(-2, 2), -0.5, 0.25]) for _ in range(12)], rng.choice([0, 1, None])) for i in range(n)]
    bad = [(900, None, 1), (901, [float("nan")] + [0.0] * 11, 1), (902, [float("-inf")] * 12, 0), (903, [None] * 12, 1)]
    return rows + bad + [rows[0], rows[0], (None, [0.125] * 12, None)]


@pytest.mark.parametrize("n", [5, 120])
def test_codes_equal_brute_force(spark, n):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in some_rows(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    df = df.selectExpr("*", "'x' AS code", "1 AS error", "0 AS vector")
    found = [tuple(r) for r in vector_codes.compressed(df, parts=4, entries=16, rounds=3).collect()]
    wanted = brute_force(rows, 4, 16, 3)
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_no_usable_vectors(spark):
    for rows in ([], [(1, None, 1)]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        found = vector_codes.compressed(df)
        assert found.count() == 0
        assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_lengths_must_fit(spark):
    df = spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError):
        vector_codes.compressed(df)


def test_query_equals_sql(spark, small):
    assert check.difference(spark, check.connection(small), "op13_limb_gemm", small) is None
    assert "op13_limb_gemm" in registered.oracle_sql()
