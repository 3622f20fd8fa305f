"""Every operator and stage on odd rows and on none."""

from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from headway.llm import digests, packing, pieces, quality, secret_scan, sharding, simhash, surrogates, token_files, toxicity
from headway.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

OPERATORS = {
    "toxicity": lambda d, labels: toxicity.toxicity(d, labels),
    "secrets": lambda d, labels: secret_scan.scanned(d),
    "token_files": lambda d, labels: token_files.round_trip(d, scratch_path(d.sparkSession, "t"), BYTES, 0),
    "simhash": lambda d, labels: simhash.near_dedup(d),
    "pieces": lambda d, labels: pieces.round_trip(d, PIECES),
    "sharding": lambda d, labels: sharding.sharded(d),
    "quality": lambda d, labels: quality.quality(d),
    "surrogates": lambda d, labels: surrogates.pseudonymised(d),
    "digests": lambda d, labels: digests.fingerprints(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(name, edges, none, edge_labels):
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in edges.collect())
    found = OPERATORS[name](edges, edge_labels)
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in found.collect()) == ids
    empty = OPERATORS[name](none, edge_labels)
    assert empty.schema.names == found.schema.names and empty.count() == 0


def test_packing_of_odd_rows(edges, none):
    rows = packing.packed(edges, WORDS, 1).collect()
    assert sum(r.length for r in rows if r.start == 0 and r.doc_id == 2) == 1  # null: the end id alone
    assert len([r for r in rows if r.doc_id == 4]) == 2
    assert sum(r.length for r in rows if r.doc_id == 9) == next(r.doc_tokens for r in rows if r.doc_id == 9)
    assert packing.packed(none, WORDS, 1).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns(spark, name, stage, edges, none, small):
    out = stage(spark, edges, small)
    assert out.columns == edges.columns and out.count() <= edges.count()
    empty = stage(spark, none, small)
    assert empty.columns == edges.columns and empty.count() == 0


def test_toxicity_without_labels_of_both_kinds(edges, edge_labels):
    rows = toxicity.toxicity(edges, edge_labels.filter("toxic = 0")).collect()
    assert {r.score for r in rows} == {0.5} and {r.predicted for r in rows} == {0}
