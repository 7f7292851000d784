"""Running word counts over a stream of documents.

Cleaning and pre-tokenizing are narrow, stateless expressions, so the same
column functions run on a streaming DataFrame; the word count is a
streaming aggregation whose state is kept by Spark (checkpointed in the
query's checkpoint location, so it survives restarts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenmill.functions.text import pre_tokenize


def stream_documents(spark: SparkSession, path: str, schema: str = "doc_id bigint, text string",
                     fmt: str = "parquet", max_files_per_trigger: int | None = None,
                     glob: str | None = None) -> DataFrame:
    """Documents arriving as files in the folder ``path`` (optionally only
    file names matching ``glob``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def streaming_word_freq(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A1 on a stream: ``(word, n)`` updated as documents arrive."""
    words = docs.select(F.explode(pre_tokenize(F.col(text_col))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def start_word_counts(docs: DataFrame, checkpoint: str, table: str | None = None,
                      sink: str = "memory", query_name: str = "word_counts",
                      trigger_once: bool = False) -> StreamingQuery:
    """Start the running word count. ``sink='memory'`` (tests) keeps the
    result in a queryable in-memory table ``query_name``; any other sink
    name is passed to ``writeStream.format`` with ``complete`` output."""
    w = (streaming_word_freq(docs).writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint).queryName(query_name).format(sink))
    if table:
        w = w.option("path", table)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
