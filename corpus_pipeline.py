"""Training-data pipeline over ``documents``: five stages, each on all that the one before it kept.

1. toxicity: documents that the learned lexicon scores as toxic go.
2. near_duplicates: of documents with a Jaccard similarity of 0.8 or more over
   five-word shingles, directly or over others, one stays.
3. decontamination: documents with a passage of a benchmark item go.
4. mixing: sources get their weights; a document may go, stay, or stay twice.
5. sharding: every document gets its slot and shard, the only new columns.

Texts are not changed. Nulls, empty texts, repeated rows and other columns are
treated as each operator says; an empty table stays empty.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.llm import decontamination, mixing, ngram_join, sharding, toxicity  # noqa: E402
from tradewind.llm.shared import table, written  # noqa: E402

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def place_on_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs, sharding.shard_names())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", place_on_shards),
]

#: A learned score, a similarity join and hash draws: SQL can't express the stages (tests/llm checks them).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
