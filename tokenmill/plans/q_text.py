"""Registered queries for sources and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.functions.text import (
    clean_text, compose_document, isolate_digits, pre_tokenize, split_lossless,
    to_byte_symbols, word_ids,
)
from tokenmill.operators.chat import render_chat
from tokenmill.operators.stats import filter_min_chars, filter_min_clean
from tokenmill.plans import sqlparts as Q
from tokenmill.plans.catalog import register
from tokenmill.sources.alphabet import byte_alphabet
from tokenmill.sources.corpus import read_corpus, read_table


def _docs(spark, sf):
    return read_table(spark, sf, "documents")


def _titled(spark, sf):
    """documents with a derived title (source for even ids, '' otherwise)."""
    d = _docs(spark, sf)
    return d.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(F.lit(""))
                    .alias("title"), "text")


@register("S1_read_corpus", """
select doc_id, cast(null as varchar) as title, text from documents
""")
def s1_read_corpus(spark, sf):
    return read_corpus(spark, f"{sf}/documents.parquet", text_col="text", id_col="doc_id")


@register("S1_first_n", """
select doc_id, text from documents order by doc_id limit 250
""")
def s1_first_n(spark, sf):
    """The first-N option of the source."""
    return read_corpus(spark, f"{sf}/documents.parquet", max_examples=250).select("doc_id", "text")


@register("S1_file_order", """
select count(*)::bigint as documents, min(page_id)::bigint as first_id, max(page_id)::bigint as last_id, true as dense
from pages
""")
def s1_file_order(spark, sf):
    """A source without an id column: documents are numbered densely in file order."""
    d = read_corpus(spark, f"{sf}/pages.parquet", text_col="html", id_col=None)
    return d.agg(F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
                 (F.count_distinct("doc_id") == F.count(F.lit(1))).alias("dense"))


@register("S1_file_order_rows", """
select row_number() over () - 1 as doc_id, sha256(html) as text_sha256 from pages
""")
def s1_file_order_rows(spark, sf):
    """Every document of a source without an id column, with its number in file order."""
    d = read_corpus(spark, f"{sf}/pages.parquet", text_col="html", id_col=None)
    return d.select("doc_id", F.sha2("text", 256).alias("text_sha256"))


@register("S5_byte_alphabet", """
with b as (select range::int as byte from range(256)),
k as (select byte, (byte between 33 and 126) or (byte between 161 and 172) or (byte between 174 and 255) as keep from b)
select byte, chr(case when keep then byte
  else 256 + (select count(*) from k k2 where not k2.keep and k2.byte < k.byte)::int end) as ch
from k
""")
def s5_byte_alphabet(spark, sf):
    return byte_alphabet(spark)


@register("T1_compose_document", f"""
select doc_id, {Q.compose(Q.title_of(), 'text')} as text from documents
""")
def t1_compose(spark, sf):
    d = _titled(spark, sf)
    return d.select("doc_id", compose_document("title", "text").alias("text"))


@register("T2_filter_min_chars", f"""
select doc_id from documents where length({Q.strip("coalesce(text, '')")}) >= 100
""")
def t2_min_chars(spark, sf):
    return filter_min_chars(_docs(spark, sf), "text", 100).select("doc_id")


@register("T3_clean_text", f"""
select doc_id, {Q.clean('text')} as clean from documents
""")
def t3_clean(spark, sf):
    return _docs(spark, sf).select("doc_id", clean_text("text").alias("clean"))


@register("T4_filter_min_clean", f"""
select doc_id from documents where length({Q.clean('text')}) >= 50
""")
def t4_min_clean(spark, sf):
    return filter_min_clean(_docs(spark, sf), "text", 50).select("doc_id")


@register("T5_isolate_digits", f"""
select doc_id, {Q.digits(Q.clean('text'))} as digits from documents
""")
def t5_digits(spark, sf):
    return _docs(spark, sf).select("doc_id", isolate_digits(clean_text("text")).alias("digits"))


@register("T6_pre_tokenize", f"""
select doc_id, (t.pos - 1)::int as pos, t.word as word
from (select doc_id, unnest({Q.pretokens('text')}) as word,
             generate_subscripts({Q.pretokens('text')}, 1) as pos from documents) t
""")
def t6_pre_tokenize(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.posexplode(pre_tokenize("text")).alias("pos", "word"))


@register("T7_split_lossless_roundtrip", """
select doc_id, text as rejoined from documents
""")
def t7_split_lossless(spark, sf):
    """Lossless split of the raw pages: joining the pieces gives the text back.

    The pieces themselves are compared in ``T7_split_lossless_pages``.
    """
    d = _docs(spark, sf)
    return d.select("doc_id", F.array_join(split_lossless("text"), "").alias("rejoined"))


@register("T7_split_lossless_pages", f"""
select page_id, (generate_subscripts(l, 1) - 1)::int as pos, unnest(l) as piece
from (select page_id, {Q.lossless('html')} as l from pages)
""")
def t7_split_pages(spark, sf):
    """T7 pieces of the symbol-heavy web pages, one row per piece."""
    p = read_table(spark, sf, "pages")
    return p.select("page_id", F.posexplode(split_lossless("html")).alias("pos", "piece"))


@register("T8_byte_symbols", f"""
with w as (select distinct unnest({Q.pretokens('text')}) as word from documents)
select word, array_to_string({Q.byte_ids('word')}, ' ') as ids from w
""")
def t8_byte_symbols(spark, sf):
    d = _docs(spark, sf)
    w = d.select(F.explode(pre_tokenize("text")).alias("word")).distinct()
    return w.select("word", F.array_join(word_ids("word"), " ").alias("ids"))


@register("T10_render_chat", """
select conv_id,
  string_agg('<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' order by turn)
  || '<|im_start|>assistant' || chr(10) as prompt,
  count(*)::bigint as turns
from conversations group by conv_id
""")
def t10_chat(spark, sf):
    c = read_table(spark, sf, "conversations")
    return render_chat(c, "conv_id", "turn", "role", "text", add_generation_prompt=True)
