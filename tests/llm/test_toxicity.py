from __future__ import annotations

import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import queries, toxicity


def plain_segments(scores):
    """Take the best segment (the shortest of equal ones, leftmost), then go on to both sides."""

    def best(lo, hi):
        found = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                key = (total, -(j - i), -i)
                if total > 0 and (found is None or key > found[0]):
                    found = key, i, j + 1
        return found

    def go(lo, hi):
        found = best(lo, hi)
        if found is None:
            return []
        _, i, j = found
        return go(lo, i) + [(i, j)] + go(j, hi)

    return go(0, len(scores))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-5, 5), max_size=25))
def test_scan_finds_maximal_segments(scores):
    found = toxicity.segments([float(s) for s in scores])
    assert [s for _, _, s in found] == [float(sum(scores[a:b])) for a, b, _ in found]
    wanted = plain_segments(scores)
    assert sum(sum(scores[a:b]) for a, b in wanted) == sum(s for _, _, s in found)
    assert sorted(sum(scores[a:b]) for a, b in wanted) == sorted(s for _, _, s in found)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op1_toxic_segments(spark, folder).collect()
    for r in rows[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    judged = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    bad = [s for t, s, _ in judged if t]
    fine = [s for t, s, _ in judged if not t]
    above = sum((b > f) + (b == f) / 2 for b in bad for f in fine) / (len(bad) * len(fine))
    assert above > 0.9
    assert sum(p for t, _, p in judged if not t) < 0.03 * len(fine)


def test_segments_point_at_the_text(spark):
    folder = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op1_toxic_segments(spark, folder).filter("score > 0.95").limit(40).collect()
    assert rows
    for r in rows:
        for s in r.segments:
            passage = texts[r.doc_id][s.start : s.start + s.length]
            assert passage and passage == passage.strip() and 0 <= s.p_value <= toxicity.SIGNIFICANT + 1e-9


def test_learning_leaves_the_held_out_third_alone(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    ids = [r.doc_id for r in toxicity.learning_rows(labels).collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)
