"""V6 on a stream: a vocabulary that grows with every chunk of documents.

Each micro-batch adds its word counts to those of all chunks before, and the
vocabulary is extended on the sum by at most ``merges_per_chunk`` merges:
earlier merges are applied first (:func:`train_bpe` with a base model).

State is one folder per batch, ``<folder>/batch-<id>/``: the word counts
(Parquet) and, published last, the tokenizer. A batch starts from the newest published
batch below its own id, so a batch that Spark runs again after a failure gives
the same result, and one that is already published is left as it is: every
chunk counts once. Only the newest two batches are kept.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenmill.operators.stats import word_freq
from tokenmill.operators.train import BpeModel, train_bpe
from tokenmill.session import ensure_checkpoint_dir
from tokenmill.sources.tokenizer_io import _hadoop_path, read_tokenizer, tokenizer_exists, write_tokenizer


def published_batches(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the batches whose tokenizer is published, ascending."""
    fs, p = _hadoop_path(spark, folder)
    if not fs.exists(p):
        return []
    ids = [int(m[1]) for s in fs.listStatus(p) if (m := re.fullmatch(r"batch-(\d+)", s.getPath().getName()))]
    return [i for i in sorted(ids) if tokenizer_exists(spark, f"{folder}/batch-{i}/tokenizer")]


def chunk_model(spark: SparkSession, folder: str) -> BpeModel | None:
    """The vocabulary after the newest published batch."""
    ids = published_batches(spark, folder.rstrip("/"))
    return read_tokenizer(spark, f"{folder.rstrip('/')}/batch-{ids[-1]}/tokenizer") if ids else None


def train_chunk(words: DataFrame, batch_id: int, folder: str, vocab_size: int, merges_per_chunk: int = 2000) -> BpeModel:
    """Add one chunk's word counts ``(word, n)`` and extend the vocabulary; returns it."""
    spark, folder = words.sparkSession, folder.rstrip("/")
    done = published_batches(spark, folder)
    own = f"{folder}/batch-{batch_id}"
    if batch_id in done:
        return read_tokenizer(spark, f"{own}/tokenizer")
    before = [i for i in done if i < batch_id]
    base = None
    if before:
        last = f"{folder}/batch-{before[-1]}"
        words = (spark.read.parquet(f"{last}/words").unionByName(words.select("word", F.col("n").cast("bigint").alias("n")))
                 .groupBy("word").agg(F.sum("n").alias("n")))
        base = read_tokenizer(spark, f"{last}/tokenizer")
    # a run that died may have left its counts; they are written anew
    words.write.mode("overwrite").parquet(f"{own}/words")
    words = spark.read.parquet(f"{own}/words")
    start = base or BpeModel()
    # specials and bytes are no merges; an id is never used twice
    size = min(vocab_size, start.vocab_size + merges_per_chunk)
    model = train_bpe(words, size, base_model=base)
    write_tokenizer(spark, model, f"{own}/tokenizer", f"chunks up to batch {batch_id}")
    fs, _ = _hadoop_path(spark, folder)
    for old in before[:-1]:
        fs.delete(_hadoop_path(spark, f"{folder}/batch-{old}")[1], True)
    return model


def start_chunk_training(docs: DataFrame, folder: str, checkpoint: str, vocab_size: int, merges_per_chunk: int = 2000,
                         text_col: str = "text", available_now: bool = False) -> StreamingQuery:
    """Train on a stream of documents; ``chunk_model(spark, folder)`` has the vocabulary so far."""
    def step(batch: DataFrame, batch_id: int) -> None:
        ensure_checkpoint_dir(batch.sparkSession)
        train_chunk(word_freq(batch, text_col), batch_id, folder, vocab_size, merges_per_chunk)

    writer = docs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
