"""One query per operator, over whole tables, and the SQL to compare with where there is some."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from headway.llm import (
    collocations,
    common,
    digests,
    packing,
    pieces,
    quality,
    repeats,
    secret_scan,
    sharding,
    simhash,
    surrogates,
    token_files,
    toxicity,
    vector_codes,
)
from headway.session import scratch_path


def op1_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    labels = common.documents(spark, folder, "labels")
    return toxicity.toxicity(common.documents(spark, folder), labels)


def op2_tiered_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed(common.documents(spark, folder), path, end_id=1)


def op3_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scanned(common.documents(spark, folder))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = scratch_path(spark, "tokens")
    return token_files.round_trip(common.documents(spark, folder), out, path, end_id=0)


def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_dedup(common.documents(spark, folder), size=3, radius=2)


def op6_piece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.round_trip(common.documents(spark, folder), path)


def op7_bounded_ring(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(common.documents(spark, folder), shards=16)


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(common.documents(spark, folder))


def op9_keyed_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.pseudonymised(common.documents(spark, folder))


def op10_quartile_digests(spark: SparkSession, folder: str) -> DataFrame:
    return digests.fingerprints(common.documents(spark, folder))


def op11_dynamic_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(common.documents(spark, folder))


def op12_previous_factors(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_report(common.documents(spark, folder))


def op13_limb_gemm(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compressed(common.documents(spark, folder, "embeddings"))


QUERIES = {
    run.__name__: run
    for run in (
        op1_toxic_segments,
        op2_tiered_packing,
        op3_secret_forest,
        op4_token_files,
        op5_simhash_near_dedup,
        op6_piece_round_trip,
        op7_bounded_ring,
        op8_quality_rules,
        op9_keyed_surrogates,
        op10_quartile_digests,
        op11_dynamic_itemsets,
        op12_previous_factors,
        op13_limb_gemm,
    )
}
SQL: dict[str, str] = {
    "op11_dynamic_itemsets": collocations.sql(),
    "op12_previous_factors": repeats.sql(),
    "op13_limb_gemm": vector_codes.sql(),
}
