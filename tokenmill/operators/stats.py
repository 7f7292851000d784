"""Aggregations A1-A10: word and pair counts, corpus summary, top pairs,
compression, token counts, loss and metric roll-ups.

Every aggregation here is a built-in grouped aggregate, so Spark runs it
as partial (map-side) plus final aggregation: hot keys such as the
single-space word are combined inside each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.constants import BYTE_OFFSET, MIN_CLEAN_CHARS, MIN_RAW_CHARS, RATIO_DIGITS
from tokenmill.functions.text import (
    SYM_BASE, TOKEN_MARK, clean_text, col_of, compose_document, isolate_digits, marked_tokens, pre_tokenize, strip_ws,
    to_byte_symbols,
)
from tokenmill.operators.prefix import running_totals
from tokenmill.session import bounded_batches, cut_lineage


# ----------------------------------------------------------------------------- filters

def filter_min_chars(df: DataFrame, col: str = "text", n: int = MIN_RAW_CHARS) -> DataFrame:
    """Keep rows whose stripped text has at least ``n`` characters."""
    return df.filter(F.length(strip_ws(F.coalesce(F.col(col), F.lit("")))) >= n)


def filter_min_clean(df: DataFrame, col: str = "text", n: int = MIN_CLEAN_CHARS) -> DataFrame:
    """T4: keep rows whose cleaned text has at least ``n`` characters."""
    return df.filter(F.length(clean_text(F.col(col))) >= n)


def training_documents(docs: DataFrame, title_col: str | None = "title",
                       text_col: str = "text") -> DataFrame:
    """Compose (T1) and keep documents of >= 100 raw and >= 50 clean
    characters (T2, T4), the documents the dataset trainer learns from:
    ``(doc_id, text, clean)``; the cleaned text is computed once."""
    title = F.col(title_col) if title_col and title_col in docs.columns else F.lit(None).cast("string")
    out = docs.select("doc_id", compose_document(title, F.col(text_col)).alias("text"))
    # both parts of a composed document are already stripped, so its stripped
    # length is its length; short rows get no cleaned text and go with the
    # filter on it, which stays above the projection that cleans once
    long_enough = F.when(F.length("text") >= MIN_RAW_CHARS, clean_text(F.col("text")))
    out = out.select("doc_id", "text", F.explode(F.array(long_enough)).alias("clean"))
    return out.filter(F.length("clean") >= MIN_CLEAN_CHARS)


# ----------------------------------------------------------------------------- A1

def word_freq(docs: DataFrame, text_col: str = "text", clean: bool = True) -> DataFrame:
    """A1: ``(word, n)`` over all pre-tokens of all documents (``clean=False``:
    the text is cleaned already)."""
    words = docs.select(F.explode(pre_tokenize(F.col(text_col), clean)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_words(freq: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words; ties by word."""
    return freq.orderBy(F.desc("n"), F.asc("word")).limit(k)


# ----------------------------------------------------------------------------- A3 / A4

def symbol_pairs(syms) -> Column:
    """All overlapping adjacent symbol pairs of a symbol string, as 2-char strings.

    A symbol is two UTF-16 units; a look-ahead match must not begin at the second."""
    return F.regexp_extract_all(col_of(syms), F.lit("(?s)(?![\\x{dc00}-\\x{dfff}])(?=(..))"), F.lit(1))


def split_pair(pair_col: str = "pair") -> list[Column]:
    """``left``/``right`` ids of a 2-symbol string."""
    p = F.col(pair_col)
    return [(F.ascii(F.substring(p, 1, 1)) - F.lit(SYM_BASE)).alias("left"),
            (F.ascii(F.substring(p, 2, 1)) - F.lit(SYM_BASE)).alias("right")]


def pair_freq(words: DataFrame, word_col: str = "word", n_col: str = "n") -> DataFrame:
    """A3: adjacent byte-pair counts inside words, weighted by word count.

    Overlaps all count (``aaa`` gives ``(a, a)`` twice); no pair crosses a
    word. Output ``(left INT, right INT, freq BIGINT)``.
    """
    p = words.select(F.explode(symbol_pairs(to_byte_symbols(F.col(word_col)))).alias("pair"),
                     F.col(n_col).cast("bigint").alias("n"))
    agg = p.groupBy("pair").agg(F.sum("n").alias("freq"))
    return agg.select(*split_pair("pair"), "freq")


def first_seen_counts(pairs: DataFrame, by: list[str], doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """``(*by, freq, first_doc, first_pos)``. Counted per document first, with
    primitive aggregates that combine in hash maps; the least place is then
    taken over the much smaller table of keys per document. A row counts ``n`` times."""
    per_doc = pairs.groupBy(*by, doc).agg(F.sum("n").alias("n"), F.min(pos).alias("p"))
    agg = per_doc.groupBy(*by).agg(F.sum("n").alias("freq"), F.min(F.struct(F.col(doc).alias("d"), F.col("p"))).alias("first"))
    return agg.select(*by, "freq", F.col("first.d").alias("first_doc"), F.col("first.p").alias("first_pos"))


def _batch_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, text)`` to ``(doc_id, pos, left, right, n)``: every byte pair of a batch once, with its count
    and the first place of the batch's documents in id order."""
    for b in batches:
        b = b.take(pc.sort_indices(b.column(0), null_placement="at_start"))
        size = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        raw = np.frombuffer(b"".join(x or b"" for x in b.column(1).cast(pa.binary()).to_pylist()), np.uint8)
        if len(raw) < 2:
            continue
        inside = np.ones(len(raw), bool)
        inside[at[1:][size > 0] - 1] = False                   # the last byte of a text has no right one
        place = np.flatnonzero(inside)
        code = raw[place].astype(np.int64) << 8 | raw[np.minimum(place + 1, len(raw) - 1)]
        count, first = np.bincount(code, minlength=1 << 16), np.zeros(1 << 16, np.int64)
        first[code[::-1]] = place[::-1]                         # of equal codes the last one written stays
        found = np.flatnonzero(count)
        row = np.searchsorted(at, first[found], side="right") - 1
        yield pa.RecordBatch.from_arrays([
            b.column(0).take(pa.array(row)), pa.array(first[found] - at[row], pa.int32()), pa.array((found >> 8) + BYTE_OFFSET, pa.int32()),
            pa.array((found & 255) + BYTE_OFFSET, pa.int32()), pa.array(count[found], pa.int64())], names=["doc_id", "pos", "left", "right", "n"])


def stream_pair_freq(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     cross_docs: bool = False) -> DataFrame:
    """A4: byte-pair counts over each document's flat byte stream (pairs
    cross word boundaries, spaces included) with the first place a pair
    was seen: ``(left, right, freq, first_doc, first_pos)``.

    With ``cross_docs`` the documents, in id order, form one stream: the last
    symbol of a document also pairs with the first of the next that has any
    (place: the last position of the document before).
    """
    # pre-tokens leave no character out, so joined they are the text that was split
    stream = docs.select(F.col(id_col).alias("doc_id"), isolate_digits(clean_text(F.col(text_col))).alias("t"))
    kind = stream.schema["doc_id"].dataType.simpleString()
    p = bounded_batches(stream).mapInArrow(_batch_pairs, f"doc_id {kind}, pos int, left int, right int, n bigint")
    if cross_docs:
        raw = F.encode("t", "UTF-8")

        def byte_id(at: int) -> Column:
            return F.conv(F.hex(F.substring(raw, at, 1)), 16, 10).cast("int") + F.lit(BYTE_OFFSET)

        ends = stream.filter(F.length("t") > 0).select(
            "doc_id", byte_id(1).alias("head"), byte_id(-1).alias("tail"),
            (F.octet_length("t") - 1).alias("pos"), F.lit(1).cast("bigint").alias("one"))
        ends = running_totals(cut_lineage(ends), [], "doc_id", ["one"])
        after = ends.select((F.col("one_run") - 1).alias("one_run"), F.col("head").alias("right"))
        p = p.unionByName(ends.join(after, "one_run").select("doc_id", "pos", F.col("tail").alias("left"), "right", F.col("one").alias("n")))
    return first_seen_counts(p, ["left", "right"]).select("left", "right", "freq", "first_doc", "first_pos")


# ----------------------------------------------------------------------------- A5

def top_pairs(pairs: DataFrame, k: int = 1, min_freq: int = 2, tie: str = "smallest") -> DataFrame:
    """A5: best ``k`` pairs with ``freq >= min_freq``.

    ``tie='smallest'`` breaks ties by the smaller ``(left, right)``;
    ``tie='first_seen'`` by the first place in the stream (needs the
    columns of :func:`stream_pair_freq`).
    """
    order = [F.desc("freq")]
    order += ([F.asc("first_doc"), F.asc("first_pos")] if tie == "first_seen" else [])
    order += [F.asc("left"), F.asc("right")]
    return pairs.filter(F.col("freq") >= min_freq).orderBy(*order).limit(k)


# ----------------------------------------------------------------------------- A2

def corpus_stats(docs: DataFrame, kept: DataFrame, freq: DataFrame, pairs: DataFrame) -> DataFrame:
    """A2: one row: articles read, articles kept, distinct words, total
    pre-tokens, distinct pairs. Words and tokens come from one aggregate."""
    spark = docs.sparkSession
    words = freq.agg(F.struct(F.count(F.lit(1)).alias("d"), F.coalesce(F.sum("n"), F.lit(0)).alias("t")).alias("w")).scalar()
    return spark.range(1).select(
        docs.agg(F.count(F.lit(1))).scalar().alias("articles_read"),
        kept.agg(F.count(F.lit(1))).scalar().alias("articles_kept"),
        pairs.agg(F.count(F.lit(1))).scalar().alias("distinct_pairs"), words.alias("w"),
    ).select("articles_read", "articles_kept", F.col("w.d").alias("distinct_words"),
             F.col("w.t").cast("bigint").alias("total_tokens"), "distinct_pairs")


def _distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(part, marked text)`` to ``(part, pair)``: every byte pair inside a pre-token, once per part and batch."""
    for b in batches:
        b = b.take(pc.sort_indices(b.column(0)))
        part = b.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
        texts = b.column(1).cast(pa.binary()).to_pylist()
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else part
        rows, codes = [], []
        for x, z in zip(first.tolist(), [*first[1:].tolist(), len(part)]):
            # 255 is no byte of a text: it ends pre-tokens and texts, and the texts' own marks come back
            raw = b"\xff".join(t for t in texts[x:z] if t).replace(TOKEN_MARK.encode(), b"\xff")
            raw = np.frombuffer(raw.replace(b"\x01\x02", TOKEN_MARK.encode()).replace(b"\x01\x03", b"\x01"), np.uint8)
            seen = np.zeros((256, 256), bool)
            seen[raw[:-1], raw[1:]] = True
            seen[255], seen[:, 255] = False, False
            found = np.flatnonzero(seen)
            rows.append(np.full(len(found), x))
            codes.append(found)
        if rows:
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(rows))),
                                              pa.array(np.concatenate(codes), pa.int32())], names=["part", "pair"])


SKETCH_K = 14           # log2 of the sketch's buckets: standard error about 0.8 %


def corpus_stats_approx(docs: DataFrame, kept: DataFrame, by: str | None = None, text_col: str = "text",
                        clean: bool = True) -> DataFrame:
    """A2 without exact distinct counts: per ``by`` (or in all) one mergeable sketch of the
    words and one of the byte pairs, united over all groups for the total. No word is
    shuffled, only sketches of 2 ** SKETCH_K buckets. ``total_tokens`` and the article
    counts are exact; both estimates are within 3 % (over three standard errors)."""
    group = [F.col(by).alias("part")] if by else [F.lit(0).alias("part")]
    toks = kept.select(*group, pre_tokenize(F.col(text_col), clean).alias("toks"))
    words = toks.select("part", F.explode("toks").alias("word")).groupBy("part").agg(
        F.hll_sketch_agg("word", SKETCH_K).alias("w"), F.count(F.lit(1)).alias("n"))
    marked = kept.select(*group, marked_tokens(F.col(text_col), clean).alias("t"))
    kind = marked.schema["part"].dataType.simpleString()
    pairs = bounded_batches(marked).mapInArrow(_distinct_pairs, f"part {kind}, pair int").groupBy("part").agg(
        F.hll_sketch_agg("pair", SKETCH_K).alias("p"))
    w = words.agg(F.struct(F.hll_sketch_estimate(F.hll_union_agg("w")).alias("d"), F.sum("n").alias("t"))).scalar()
    p = pairs.agg(F.hll_sketch_estimate(F.hll_union_agg("p"))).scalar()
    return docs.sparkSession.range(1).select(
        docs.agg(F.count(F.lit(1))).scalar().alias("articles_read"),
        kept.agg(F.count(F.lit(1))).scalar().alias("articles_kept"), w.alias("w"),
        F.coalesce(p, F.lit(0)).cast("bigint").alias("distinct_pairs"),
    ).select("articles_read", "articles_kept", F.coalesce("w.d", F.lit(0)).cast("bigint").alias("distinct_words"),
             F.coalesce("w.t", F.lit(0)).cast("bigint").alias("total_tokens"), "distinct_pairs")


# ----------------------------------------------------------------------------- A6 / A7

def ratio_col(nbytes: Column, ntokens: Column, digits: int = RATIO_DIGITS) -> Column:
    """bytes / tokens rounded half-up on the exact quotient (0 when no tokens).

    Integer arithmetic, so the result does not depend on floating-point
    representation; it differs from half-even-on-binary only at exact ties.
    """
    scale = 10 ** digits
    b, t = nbytes.cast("bigint"), ntokens.cast("bigint")
    num = F.lit(2 * scale) * b + t
    q = F.when(t > 0, F.floor(num / (F.lit(2) * t)))   # exact: integers far below 2**52
    return F.when(t > 0, q.cast("double") / F.lit(float(scale))).otherwise(F.lit(0.0))


def compression_stats(df: DataFrame, text_col: str = "text", ids_col: str = "ids",
                      by: list[str] | None = None) -> DataFrame:
    """Bytes of the raw text, token count and bytes/token (rounded to 3, 0 when empty).

    Without ``by`` one row per input row; with ``by`` one row per group
    from the summed bytes and tokens.
    """
    nb = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint")
    nt = F.coalesce(F.size(F.col(ids_col)), F.lit(0)).cast("bigint")
    if not by:
        keep = [c for c in df.columns if c not in (text_col, ids_col)]
        base = df.select(*keep, nb.alias("original_bytes"), nt.alias("num_tokens"))
    else:
        base = (df.select(*by, nb.alias("b"), nt.alias("t")).groupBy(*by)
                .agg(F.sum("b").alias("original_bytes"), F.sum("t").alias("num_tokens")))
    r = ratio_col(F.col("original_bytes"), F.col("num_tokens"))
    return base.select("*", r.alias("compression_ratio"), r.alias("avg_bytes_per_token"))


def token_count(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Total tokens of an encoded corpus, and documents."""
    return df.agg(F.coalesce(F.sum(F.size(F.col(ids_col))), F.lit(0)).cast("bigint").alias("total_tokens"),
                  F.count(F.lit(1)).alias("documents"))


# ----------------------------------------------------------------------------- A8

def vocab_summary(vocab: DataFrame) -> DataFrame:
    """``vocab_size = max(id) + 1``, and counts of specials, bytes, merges."""
    return vocab.agg(
        (F.coalesce(F.max("id"), F.lit(-1)) + 1).cast("bigint").alias("vocab_size"),
        F.count_if(F.col("kind") == "special").alias("n_special"),
        F.count_if(F.col("kind") == "byte").alias("n_byte"),
        F.count_if(F.col("kind") == "merge").alias("n_merge"),
    )


# ----------------------------------------------------------------------------- A9

def logsumexp(arr: Column) -> Column:
    m = F.array_max(arr)
    return m + F.log(F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + F.exp(x - m)))


def token_loss(scores, target) -> Column:
    """Per-row next-token loss ``logsumexp(scores) - scores[target]`` (target is 0-based)."""
    s = F.transform(col_of(scores), lambda x: x.cast("double"))
    return logsumexp(s) - F.element_at(s, col_of(target).cast("int") + 1)


def cross_entropy(df: DataFrame, scores: str, target: str, by: list[str] | None = None) -> DataFrame:
    """Mean next-token loss and perplexity, overall or per group."""
    base = df.select(*(by or []), token_loss(scores, target).alias("loss"))
    g = base.groupBy(*by) if by else base
    return (g.agg(F.avg("loss").alias("loss"), F.count(F.lit(1)).alias("n"))
            .withColumn("perplexity", F.exp("loss")))


# ----------------------------------------------------------------------------- A10

def metric_rollup(df: DataFrame, epoch: str, step: str, value: str,
                  scale: int = 6) -> tuple[DataFrame, DataFrame]:
    """A10: ``(per-epoch mean, running mean by step within each epoch)``.

    Values are summed as ``DECIMAL(38, scale)`` so the sums do not depend
    on the order Spark adds them in; the mean is one division of the exact
    sum. The running mean is a two-phase prefix sum (see
    :func:`tokenmill.operators.prefix.running_totals`) so a large epoch is
    spread over many tasks instead of one window partition.
    """
    dec = f"decimal(38,{scale})"
    per_epoch = (df.groupBy(epoch)
                 .agg(F.sum(F.col(value).cast(dec)).alias("s"), F.count(F.lit(1)).alias("n"))
                 .select(epoch, (F.col("s").cast("double") / F.col("n")).alias("mean_value"), "n"))
    base = df.select(epoch, step, F.col(value).cast(dec).alias("v"), F.lit(1).cast("bigint").alias("c"))
    run = running_totals(base, [epoch], step, ["v", "c"])
    running = run.select(epoch, step, F.col("v").cast("double").alias("v"),
                         (F.col("v_run").cast("double") / F.col("c_run")).alias("running_mean"))
    return per_epoch, running
