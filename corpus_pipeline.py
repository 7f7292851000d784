"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order; each stage's result is written as Parquet
into the cluster's shared folder and read again as the next stage's input.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tokenmill.llm.bbit_minhash import drop_near_duplicates
from tokenmill.llm.best_fit import pack_documents
from tokenmill.llm.common import bounded_batches, ensure_checkpoint_dir
from tokenmill.llm.line_windows import drop_repeated_lines
from tokenmill.llm.quality_rules import filter_quality
from tokenmill.llm.suffix_dedup import drop_repeats


#: A passage of over 50 words must go: 51 words hold a window of this length from 4.4
#: bytes a word on (the shortest 51-word run in the kept texts of sf0.1 has 230 bytes).
PASSAGE_BYTES = 225

#: Words of a generation that a worker remembers while it packs: it also holds what the
#: stages before have left in it, so this is less than the eighth operator allows itself.
PACKING_WORDS = 60_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that lose too much, or fail the base rule, go."""
    bounded_batches(spark)
    return filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go."""
    bounded_batches(spark)
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 one stays."""
    bounded_batches(spark)
    ensure_checkpoint_dir(spark)
    return drop_near_duplicates(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of ``PASSAGE_BYTES`` or more go."""
    bounded_batches(spark)
    ensure_checkpoint_dir(spark)
    return drop_repeats(docs, PASSAGE_BYTES)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces placed in sequences of 4096 tokens."""
    bounded_batches(spark)
    ensure_checkpoint_dir(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), remember=PACKING_WORDS)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("packing", packing)]

#: SQL cannot express the tokenizer or the suffix order; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data directory."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
