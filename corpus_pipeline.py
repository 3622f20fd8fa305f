"""A corpus from quality rules to packed sequences, one stage after another.

Each stage reads what the one before has kept; all but the last keep the columns of the
documents. Quality rules, toxicity and near-copies remove documents, the secret scan
changes their texts, and packing turns them into pieces of sequences. Near copies are those
of the SimHash operator: fingerprints of 3-word shingles that differ in at most 2 bits.

Defined results: null and empty texts fail the quality rules; rows with equal ids are judged
each by its own text; an empty table gives no rows; further columns stay until packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from headway.llm import common, packing, quality, secret_scan, simhash, toxicity


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def toxic_segments(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.kept_documents(docs, common.documents(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.kept_documents(docs, size=3, radius=2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.cleaned(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxic_segments", toxic_segments),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("packed_sequences", packed_sequences),
]

#: The stages learn models and compare fingerprints, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
