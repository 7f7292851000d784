"""V5: BPE on the flat byte stream of each document.

Each document (cleaned twice, digits isolated, all pre-tokens joined) is
one string of symbols (kept as compressed numbers), so merges may cross word boundaries. The best pair is
the most frequent; ties go to the pair seen first (earliest document,
then earliest position in the current stream). Rounds are those of
``operators.active_runs`` with places: distinct runs of active pairs keep where
they are first, which is all that ties need, so one pass over the documents gives
many merges. Documents are not collected anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.constants import BYTE_OFFSET, SPECIAL_TOKENS_19
from tokenmill.functions.text import TOKEN_MARK, clean_text, marked_tokens
from tokenmill.operators.active_runs import pack
from tokenmill.operators.train import BpeModel, round_conf, train_rounds
from tokenmill.session import bounded_batches, cut_lineage, session_conf


ACTIVE_PAIRS = 32           # active pairs of the first round: streams have longer runs than words
RUN_LIMIT = 30_000


def _byte_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """T8 of all texts of a batch at once: ``(doc_id, marked text)`` to ``(doc_id, syms, size)``, without the marks."""
    for b in batches:
        texts = b.column(1).cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        keep = raw != ord(TOKEN_MARK)
        ends = np.concatenate([[0], np.cumsum(keep)])[at - at[0]]
        ids = raw[keep].astype(np.int64) + BYTE_OFFSET
        yield pa.RecordBatch.from_arrays([b.column(0), pack(ids, ends), pa.array(np.diff(ends))], names=["doc_id", "syms", "size"])


def stream_symbols(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, syms, size)``: the pre-tokens of every document, one after the other, as byte symbols (packed)."""
    marked = docs.select(F.col(id_col).alias("doc_id"), marked_tokens(clean_text(F.col(text_col))).alias("t"))
    kind = marked.schema["doc_id"].dataType.simpleString()
    return bounded_batches(marked).mapInArrow(_byte_symbols, f"doc_id {kind}, syms binary, size bigint")


def train_bpe_stream(docs: DataFrame, vocab_size: int, text_col: str = "text", id_col: str = "doc_id",
                     active: int = ACTIVE_PAIRS, run_limit: int = RUN_LIMIT) -> BpeModel:
    """Merges of the documents' streams; ids are integers, and rows with a null id come first."""
    spark = docs.sparkSession
    work = stream_symbols(docs, text_col, id_col).select(
        "syms", "size", F.lit(1).cast("bigint").alias("n"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")).alias("doc"))
    work = cut_lineage(work)
    with session_conf(spark, round_conf(spark)):
        return train_rounds(work, BpeModel(specials=list(SPECIAL_TOKENS_19)), vocab_size, active, run_limit)
