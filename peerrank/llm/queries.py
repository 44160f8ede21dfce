"""Registered queries of this subpackage, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from . import (
    convrepair, decontam, fuzzylines, licences, merkle, mixing, neardup, pii, sharding, tokenfile, toxicity, vptree, warczip,
)
from .common import read_table
from .sql import ORACLE_SQL


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_report(read_table(spark, sf_dir, "documents"))


def op2_vptree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return tokenfile.token_file_report(read_table(spark, sf_dir, "documents"), tokenizer, end_id=1)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("copies")


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_dup_report(read_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op8_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warczip.archive_report(read_table(spark, sf_dir, "pages"), least_bytes=0)


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzylines.line_report(read_table(spark, sf_dir, "documents"), similarity=0.9)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(read_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.repair_report(read_table(spark, sf_dir, "conversations"))


def op12_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed_in_shards(read_table(spark, sf_dir, "documents"), shards=24)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": op1_licence_scan,
    "op2_vptree_neighbours": op2_vptree_neighbours,
    "op3_toxicity": op3_toxicity,
    "op4_token_files": op4_token_files,
    "op5_source_mix": op5_source_mix,
    "op6_near_dups": op6_near_dups,
    "op7_decontaminate": op7_decontaminate,
    "op8_warc_packages": op8_warc_packages,
    "op9_fuzzy_lines": op9_fuzzy_lines,
    "op10_pii": op10_pii,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_jump_shards": op12_jump_shards,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
