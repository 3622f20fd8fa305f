from __future__ import annotations

import re

from headway.llm import quality, queries


def plain(text):
    """The counts of a text, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(inside)


def test_query_against_plain_counts(spark, small, texts):
    for r in queries.op8_quality_rules(spark, small).collect():
        counts = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.reasons) and (not r.base_failed or not r.kept)


def test_junk_goes_and_prose_stays(spark, texts):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = queries.op8_quality_rules(spark, "/root/testdata/sf0.01").filter("NOT base_failed").collect()
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels]
    good = [k for q, k in judged if q == 1]
    bad = [k for q, k in judged if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_thresholds_follow_their_group(spark):
    """What is usual in one source is an outlier in another; small groups follow their language."""

    def calm(i):
        return [f"word{1000 + (37 * i + k) % 8999}" for k in range(80)]

    rows = [(i, " ".join(calm(i)), "en", "calm") for i in range(300)]
    rows += [(1000 + i, " # ".join(calm(i)), "en", "loud") for i in range(300)]
    rows += [(5000, " # ".join(calm(7)), "en", "calm"), (5001, " ".join(calm(7)), "xx", "tiny")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality(frame).collect()}
    assert got[1001].kept and got[5].kept and got[5001].kept
    assert not got[5000].kept and got[5000].reasons == ["symbol_rate"]


def test_sketches_merge_to_the_same_counts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one = quality.quality(docs.coalesce(1)).collect()
    many = quality.quality(docs.repartition(7)).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, many))
