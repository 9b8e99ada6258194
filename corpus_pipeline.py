"""A training corpus from raw documents: five stages, each a written table that the next one reads.

Rules, near duplicates, benchmark leaks, mixture, token files. The first four return the columns of ``documents``; the
last writes the token files and returns what it reads back from them.

NULL and empty texts fail the rules; ties, repeated rows, rows without an id and very long texts are treated as the stages'
modules say; columns beyond those of ``documents`` pass through the first four; an empty table gives no token rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rowsmith.llm import decontaminate, mixing, ngramjoin, quality, tokens
from rowsmith.llm.common import space_word_count, text_of
from rowsmith.llm.queries import public_tokenizer
from rowsmith.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return ngramjoin.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them."""
    return mixing.repeat(mixing.mix(docs, space_word_count(text_of(docs))))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, in a new folder of the shared scratch folder, and their documents as read back."""
    return tokens.read(tokens.write(docs, public_tokenizer(), end_id=0))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixture),
    ("token-ID output", token_files),
]

# Tokens cannot be said in SQL; the stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for at, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
    return docs
