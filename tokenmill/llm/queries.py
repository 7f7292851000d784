"""The registered queries of the ten operators and the pipeline. Each reads
its whole table and derives its digest columns from the operator's output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm import oracle
from tokenmill.llm.catalog import register
from tokenmill.llm.common import table


@register("op2_quality_rules", oracle.QUALITY_RULES)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.quality_rules import quality_report
    return quality_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words",
        "base_failed", "kept")


@register("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.byte_bpe import decode_documents, encode_documents
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return decode_documents(ids, path, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.best_fit import pack_documents
    # the digest needs no ids beyond their checksum, which the operator takes per piece
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                          with_ids=False)


@register("op10_url_filters", oracle.URL_FILTERS)
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.url_rules import judge_urls
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "pattern")


@register("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.license_scan import scan_licenses
    return scan_licenses(table(spark, sf_dir, "documents"))


@register("op3_bbit_minhash")
def op3_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.bbit_minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@register("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.token_counts import section_token_counts
    return section_token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN)


@register("op6_line_windows", oracle.LINE_WINDOWS)
def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.line_windows import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "n_spans", F.sha2("clean_text", 256).alias("clean_sha256"))


@register("op7_exact_topk", oracle.EXACT_TOPK)
def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.exact_topk import integer_vectors, top_k
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)


@register("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.suffix_dedup import remove_repeats
    out = remove_repeats(table(spark, sf_dir, "documents"), keep="none")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["t"] - x["f"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


@register("op12_lexical_search", oracle.LEXICAL_SEARCH)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.lexical_search import rank_documents
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


@register("op13_simhash_pivots")
def op13_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.simhash_pivots import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=3)


@register("op11_hard_negatives", oracle.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tokenmill.llm.hard_negatives import hard_negatives, labelled_vectors
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(labelled_vectors(rows.withColumn("label", label), 256), F.col("vec_id") % 100 == 0)
