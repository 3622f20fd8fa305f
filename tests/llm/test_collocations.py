"""Phrase counts and scores against brute force and SQL."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest

import __spark_entry__ as registered
import check
from headway.llm import collocations


def brute_force(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    frequent = {k: n for k, n in counts.items() if n >= least}
    longest = Counter()
    for (lang, words), n in frequent.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = (lang, words[i : i + size])
                longest[key] = max(longest[key], n)
    out = {}
    for (lang, words), a in frequent.items():
        if len(words) < 2 or longest[lang, words] >= a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = frequent[lang, words[:k]], frequent[lang, words[k:]]
            cuts.append((floor(Fraction(1000 * a * totals[lang], left * right)), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def some_rows(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünder", "É", "of\x1cthe", "a b"]
    idioms = ["Once upon a time there", "as a matter of fact", "w1 w2  w3\tw4"]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary + idioms) for _ in range(rng.randint(0, 12))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0c"]) for w in words)
        rows.append((rng.choice(["en", "de", None, "und", ""]), rng.choice([text, text.upper()])))
    return rows + [("en", None), (None, "")] + [rows[0]] * 3


@pytest.mark.parametrize("shards, least, top, most", [(1, 5, 2000, 300_000), (3, 3, 7, 0)])
def test_phrases_equal_brute_force(spark, monkeypatch, shards, least, top, most):
    monkeypatch.setattr(collocations, "MOST_BROADCAST", most)
    rows = some_rows(least)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    found = collocations.collocations(df, least=least, top=top, shards=shards)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, least, top)


def test_counts_without_room_in_the_fields(spark, monkeypatch):
    """Bit fields that let nearly everything in cost work, not counts."""
    monkeypatch.setattr(collocations, "LEAST_BITS", 6)
    monkeypatch.setattr(collocations, "MOST_BITS", 7)
    rows = some_rows(9)
    df = spark.createDataFrame(rows, "lang string, text string")
    found = collocations.collocations(df, least=4, top=50)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, 4, 50)


def test_grown_fields_keep_what_smaller_ones_had():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    small = collocations.Field(np.zeros(2, dtype=np.uint64))
    for h in hashes[:10]:
        place = int(h) & 127
        small.words[place >> 6] |= np.uint64(1 << (place & 63))
    large = collocations.Field(np.zeros(16, dtype=np.uint64))
    merged = collocations._merged([small], [large])[0]
    assert (merged.has(hashes) == small.has(hashes)).all() and merged.has(hashes[:10]).all()


def test_words_in_normal_form():
    words = collocations.words_of("  A\tbC..d\nÉ e  ".encode())
    assert words.text == "a bc d É e ".encode()
    found = [words.text[a:b].decode() for a, b in zip(words.begin, words.end)]
    assert found == ["a", "bc", "d", "É", "e"] and words.piece.tolist() == [0, 0, 2, 3, 3]


def test_long_texts_are_cut_between_pieces(spark):
    line = "one two three, four five\n"
    text = line * (2 * collocations.AT_ONCE // len(line) + 10)
    piece = "six seven " * (collocations.AT_ONCE // 8)  # no end in sight
    df = spark.createDataFrame([("en", text), ("de", piece)], "lang string, text string")
    found = {(r.lang, r.phrase): r.a for r in collocations.collocations(df).collect()}
    n = text.count("\n")
    assert found["en", "one two three"] == n and found["en", "four five"] == n
    assert found["de", "six seven six seven six"] == piece.count("six") - 2


def test_odd_rows(edges, none):
    found = collocations.collocations(edges, least=5)
    assert {r.lang for r in found.collect()} == {"en"}
    empty = collocations.collocations(none)
    assert empty.columns == found.columns and empty.count() == 0


def test_query_equals_sql(spark, small):
    assert check.difference(spark, check.connection(small), "op11_dynamic_itemsets", small) is None
    assert "op11_dynamic_itemsets" in registered.oracle_sql()
