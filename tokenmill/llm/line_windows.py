"""Line dedup (6): overlapping windows of three lines.

Lines are the ``\\n``-separated parts of a text that have a word, compared
without the white space around them. Every run of ``WINDOW`` consecutive
lines is a window, known by a 128-bit hash. A window that occurred before
(order: document id, then place) is a later occurrence; the lines that later
occurrences cover, merged, are removed. Blank lines stay.

Jobs: one narrow pass emits each document's distinct windows (a repetition
inside a document is settled there), a grouped count with primitive
aggregates finds windows of several documents, and a join brings back the
rows that are not in the window's first document. Windows of one document
are bounded by its length; a window that a third of all documents share is
pre-aggregated before the shuffle and its join can be split.

Defined cases: null and empty texts have no lines and stay as they are;
fewer lines than a window: nothing is removed; rows with a null id are only
cleaned of their own repetitions; rows that share an id are one document;
a very long text is one list of lines and hashes; equal windows of one document are
ranked by place; further columns are untouched, whatever their names; an empty
table gives an empty table.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import free_name, map_batches, spread, texts_as_bytes

WINDOW = 3


def line_windows(text: bytes, width: int = WINDOW) -> tuple[list[bytes], list[int], list[bytes]]:
    """All lines, the places of those with a word, and the hash of each window of them."""
    lines = text.split(b"\n")
    bare = [x.strip() for x in lines]
    at = [i for i, x in enumerate(bare) if x]
    full = [bare[i] for i in at]
    return lines, at, [xxhash.xxh3_128_digest(b"\n".join(full[i:i + width])) for i in range(len(full) - width + 1)]


def later_lines(windows: list[bytes], before: set[bytes], width: int = WINDOW) -> list[int]:
    """Places (among lines with a word) covered by windows that occurred before,
    in another document (``before``) or further up."""
    seen, out, upto = set(before), [], 0
    for i, w in enumerate(windows):
        if w in seen:
            out.extend(range(max(i, upto), i + width))
            upto = i + width
        seen.add(w)
    return out


def windows_before(docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, before ARRAY<BINARY>)``: the document's windows that a document with a smaller id has."""

    def run(b: pa.RecordBatch) -> dict:
        ids, found = [], []
        for d, t in zip(b.column(0).to_pylist(), texts_as_bytes(b.column(1))):
            w = list(dict.fromkeys(line_windows(t, width)[2]))
            ids.extend([d] * len(w))
            found.extend(w)
        return {"doc_id": pa.array(ids, pa.int64()), "w": pa.array(found, pa.binary())}

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = map_batches(spread(texts.filter("doc_id is not null")), run, "doc_id bigint, w binary")
    first = rows.groupBy("w").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    later = rows.join(first.select("w", "lo"), "w").filter("doc_id > lo")
    return later.groupBy("doc_id").agg(F.collect_set("w").alias("before"))


def _with_before(docs: DataFrame, width: int, id_col: str, text_col: str, columns: list) -> DataFrame:
    w = windows_before(docs, width, id_col, text_col)
    found = free_name(docs.columns, "before")
    w = w.select(F.col("doc_id").alias(free_name(docs.columns, "id")), F.col("before").alias(found))
    return docs.join(w, docs[id_col].cast("bigint") == w[w.columns[0]], "left").select(*columns, w[found])


def dedup_lines(docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_lines, n_removed, n_spans, clean_text)`` per row; lines with a
    word are counted, a span is a run of removed lines with no kept one between."""

    def run(b: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_lines", "n_removed", "n_spans", "clean_text")}
        for t, before in zip(texts_as_bytes(b.column(1)), b.column(2).to_pylist()):
            lines, at, windows = line_windows(t, width)
            gone = later_lines(windows, set(before or ()), width)
            drop = {at[i] for i in gone}
            out["n_lines"].append(len(at))
            out["n_removed"].append(len(gone))
            out["n_spans"].append(sum(1 for j, i in enumerate(gone) if j == 0 or gone[j - 1] != i - 1))
            out["clean_text"].append(b"\n".join(x for i, x in enumerate(lines) if i not in drop).decode())
        return {"doc_id": b.column(0)} | {k: pa.array(v, pa.string() if k == "clean_text" else pa.int64())
                                          for k, v in out.items()}

    columns = [docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text")]
    return map_batches(_with_before(docs, width, id_col, text_col, columns), run,
                       "doc_id bigint, n_lines bigint, n_removed bigint, n_spans bigint, clean_text string")


def drop_repeated_lines(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Pipeline form: all rows and columns, ``text`` without later line windows
    (``n_chars``, if there, follows the new text)."""
    names = docs.columns

    def run(b: pa.RecordBatch) -> dict:
        out = {n: b.column(i) for i, n in enumerate(names)}
        texts = []
        for t, known, before in zip(texts_as_bytes(out["text"]), out["text"].is_valid().to_pylist(),
                                    b.column(len(names)).to_pylist()):
            lines, at, windows = line_windows(t, width)
            drop = {at[i] for i in later_lines(windows, set(before or ()), width)}
            texts.append(b"\n".join(x for i, x in enumerate(lines) if i not in drop).decode() if known else None)
        out["text"] = pa.array(texts, pa.string())
        return out

    columns = [docs[f"`{n}`"] for n in names]
    out = map_batches(_with_before(docs, width, "doc_id", "text", columns), run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
