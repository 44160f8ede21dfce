"""Corpus pipeline: documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept.  ``run`` writes each stage's rows to the shared folder and reads them
again, so a lost executor costs one stage at most.

* ``toxicity``: documents predicted toxic go.
* ``near_dedup``: one document of each near-duplicate group stays (five-word
  shingles, similarity 0.8).
* ``decontaminate``: documents that contain a benchmark item go.
* ``mix``: documents are repeated or left out so that sources meet their
  target shares.
* ``token_files``: the rest is written as token files and read back: one row
  per (repeated) document with its place.

Defined cases are those of the operators; an empty table stays empty through
all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from peerrank.llm import decontam, mixing, neardup, tokenfile, toxicity
from peerrank.llm.common import read_table, written

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_dups(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenfile.token_file_report(docs, public_tokenizers.path(TOKENIZER), end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_dups),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("token_files", write_tokens),
]

# Nearest-neighbour votes, MinHash, latent semantics and the cube method have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
