"""Repeated windows against brute force, in groups and over whole tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

import __spark_entry__ as registered
import check
from headway.llm import repeats


def windows(text, size):
    return [text[i : i + size] for i in range(len(text) - size + 1)]


def expected(texts, size, keep="none"):
    """Whether each byte goes, by text, judged on the input alone."""
    counts = Counter(w for t in texts for w in windows(t, size))
    seen, out = set(), []
    for text in texts:
        gone = [False] * len(text)
        for i, w in enumerate(windows(text, size)):
            if counts[w] > 1 if keep == "none" else w in seen:
                gone[i : i + size] = [True] * size
            seen.add(w)
        out.append(gone)
    return out


def mixture(seed, n=60):
    """Texts of shared passages, near copies, copies and monotonous stretches."""
    rng = random.Random(seed)

    def noise(k):
        return bytes(rng.choice(b"abcdefgh ") for _ in range(k))

    passages = [noise(rng.randint(20, 90)) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = [rng.choice((noise(rng.randint(0, 40)), rng.choice(passages))) for _ in range(rng.randint(0, 5))]
        texts.append(b"".join(parts))
    texts += [texts[3], texts[3], texts[5] + b"x", b"z" * 150, b"ab" * 60, passages[0] * 3]
    return texts


@pytest.mark.parametrize("size", [16, 33, 40])
def test_factors_of_a_group(size):
    texts = [t for t in mixture(size) if len(t) >= size]
    later, either = repeats.repeats_of(texts, list(range(len(texts))), size)
    for keep, found in (("first", later), ("none", either)):
        for ranges, gone in zip(found, expected(texts, size, keep)):
            mine = [False] * len(gone)
            for r in ranges:
                mine[r["lo"] : r["hi"] + size] = [True] * (r["hi"] - r["lo"] + size)
            assert mine == gone


def test_previous_factors_by_hand():
    text = b"abracadabra"
    suffixes = sorted(range(len(text)), key=lambda i: text[i:])

    def common(a, b):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        return n

    shared = [0] + [common(a, b) for a, b in zip(suffixes, suffixes[1:])]
    longest, matched = repeats.previous_factors(suffixes, shared, 4)
    by_place = dict(zip(suffixes, longest))
    assert [by_place[i] for i in range(len(text))] == [0, 0, 0, 1, 0, 1, 0, 4, 3, 2, 1]
    assert [p for p, m in zip(suffixes, matched) if m] == [0]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [4000, 3])
def test_table_equals_brute_force(spark, monkeypatch, keep, group):
    """With small groups, nearly every anchor is split over and over."""
    monkeypatch.setattr(repeats, "GROUP", group)
    texts = mixture(7)
    df = spark.createDataFrame(list(enumerate(t.decode() for t in texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in repeats.without_repeats(df, 32, keep).collect()}
    for doc_id, (text, gone) in enumerate(zip(texts, expected(texts, 32, keep))):
        assert bytes(found[doc_id].kept) == bytes(b for b, g in zip(text, gone) if not g)
        stretches = sum(g and not before for g, before in zip(gone, [False, *gone]))
        assert len(found[doc_id].removed) == stretches
        assert sum(s.length for s in found[doc_id].removed) == sum(gone)


def test_long_texts_are_cut_without_seams(spark):
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefghij \n", k=repeats.AT_ONCE + 5000))
    part = text[repeats.AT_ONCE - 700 : repeats.AT_ONCE + 800]  # lies over the first cut
    df = spark.createDataFrame([(1, text), (2, "before " + part + " after"), (3, part[:399])], "doc_id long, text string")
    rows = {r.doc_id: r for r in repeats.repeat_report(df).collect()}
    assert (rows[1].n_removed, rows[1].n_spans) == (1500, 1)
    assert rows[2].n_removed == 1500 and rows[3].n_removed == 0
    left = text.replace(part, "")
    assert rows[1].kept_sha256 == hashlib.sha256(left.encode()).hexdigest()


def test_odd_rows(edges, none):
    rows = repeats.without_repeats(edges, keep="none").collect()
    assert len(rows) == edges.count()
    assert all(r.kept == b"" and r.removed == [] for r in rows if not r.text)
    copies = [r for r in rows if r.doc_id in (1, 5)]
    assert len(copies) == 3 and all(len(r.kept) < 400 for r in copies)
    empty = repeats.without_repeats(none)
    assert empty.count() == 0 and empty.columns == [*none.drop("kept").columns, "kept", "removed"]
    assert repeats.repeat_report(none).count() == 0


def test_repeated_rows_are_copies(spark):
    text = "".join(random.Random(1).choices("abcdef", k=500))
    df = spark.createDataFrame([(1, text), (1, text), (None, text[:450])], "doc_id long, text string")
    assert [r.n_removed for r in repeats.repeat_report(df).orderBy("doc_id").collect()] == [450, 500, 500]
    kept = repeats.without_repeats(df, keep="first").collect()
    assert sorted(len(r.kept) for r in kept) == [50, 50, 450]  # the null id comes first


def test_query_equals_sql(spark, small):
    assert check.difference(spark, check.connection(small), "op12_previous_factors", small) is None
    assert "op12_previous_factors" in registered.oracle_sql()
