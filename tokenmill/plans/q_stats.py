"""Registered queries for aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators.stats import (
    corpus_stats, corpus_stats_approx, cross_entropy, metric_rollup, pair_freq, stream_pair_freq,
    top_pairs, top_words, training_documents, word_freq,
)
from tokenmill.plans import sqlparts as Q
from tokenmill.plans.catalog import register
from tokenmill.session import cut_lineage
from tokenmill.sources.corpus import read_table

WORDS_SQL = f"""(select word, count(*)::bigint as n
  from (select unnest({Q.pretokens('text')}) as word from documents) group by word)"""

PAIRS_SQL = f"""(select l[i] as "left", l[i + 1] as "right", sum(n)::bigint as freq
  from (select n, {Q.byte_ids('word')} as l from {WORDS_SQL}) w, range(1, len(l)) r(i)
  group by 1, 2)"""

STREAM_SQL = f"""(select doc_id, {Q.byte_ids("array_to_string(" + Q.pretokens('text') + ", '')")} as l
  from documents)"""


def flagship(spark, sf):
    """Minimum slice: documents -> clean -> digits -> pre-tokens -> word counts -> top 20."""
    return top_words(word_freq(read_table(spark, sf, "documents")), 20)


FLAGSHIP_SQL = f"select word, n from {WORDS_SQL} order by n desc, word limit 20"

register("A1_top20_words", FLAGSHIP_SQL)(flagship)


@register("A1_word_freq", f"select word, n from {WORDS_SQL}")
def a1_word_freq(spark, sf):
    return word_freq(read_table(spark, sf, "documents"))


@register("A1_word_freq_training_docs", f"""
select word, count(*)::bigint as n
from (select unnest({Q.pretokens('text')}) as word from ({Q.TRAINING_DOCS})) group by word
""")
def a1_word_freq_training(spark, sf):
    docs = training_documents(read_table(spark, sf, "documents"), title_col=None)
    return word_freq(docs, "clean", clean=False)


@register("A2_corpus_stats", f"""
select (select count(*) from documents)::bigint as articles_read,
       (select count(*) from ({Q.TRAINING_DOCS}))::bigint as articles_kept,
       (select count(*) from {WORDS_SQL})::bigint as distinct_words,
       (select sum(n) from {WORDS_SQL})::bigint as total_tokens,
       (select count(*) from {PAIRS_SQL})::bigint as distinct_pairs
""")
def a2_corpus_stats(spark, sf):
    docs = read_table(spark, sf, "documents")
    kept = training_documents(docs, title_col=None)
    freq = word_freq(docs)
    return corpus_stats(docs, kept, freq, pair_freq(freq))


@register("A2_corpus_stats_approx", f"""
select (select count(*) from documents)::bigint as articles_read,
       (select sum(n) from {WORDS_SQL})::bigint as total_tokens, true as words_within, true as pairs_within
""")
def a2_corpus_stats_approx(spark, sf):
    """The summary from one sketch per source; both estimates held against the exact counts (3 %)."""
    docs = read_table(spark, sf, "documents")
    freq = cut_lineage(word_freq(docs))      # counted once for words and for pairs
    exact = corpus_stats(docs, docs, freq, pair_freq(freq)).select(
        F.col("distinct_words").alias("w"), F.col("distinct_pairs").alias("p"))
    near = corpus_stats_approx(docs, docs, by="source")
    return near.crossJoin(exact).select(       # one row each
        "articles_read", "total_tokens", (F.abs(F.col("distinct_words") - F.col("w")) * 100 <= 3 * F.col("w")).alias("words_within"),
        (F.abs(F.col("distinct_pairs") - F.col("p")) * 100 <= 3 * F.col("p")).alias("pairs_within"))


@register("A3_pair_freq", f'select "left", "right", freq from {PAIRS_SQL}')
def a3_pair_freq(spark, sf):
    return pair_freq(word_freq(read_table(spark, sf, "documents")))


@register("A4_stream_pair_freq", f"""
select l[i] as "left", l[i + 1] as "right", count(*)::bigint as freq, min(doc_id) as first_doc,
       arg_min(i, (doc_id, i)) - 1 as first_pos
from {STREAM_SQL} s, range(1, len(l)) r(i) group by 1, 2
""")
def a4_stream_pair_freq(spark, sf):
    return stream_pair_freq(read_table(spark, sf, "documents"))


@register("A4_stream_pair_freq_cross_docs", f"""
with s as materialized {STREAM_SQL},
inner_pairs as (select l[i] as "left", l[i + 1] as "right", doc_id, i - 1 as pos from s, range(1, len(l)) r(i)),
ends as (select l[-1] as "left", lead(l[1]) over (order by doc_id) as "right", doc_id, len(l) - 1 as pos from s where len(l) > 0),
p as (select * from inner_pairs union all select * from ends where "right" is not null)
select "left", "right", count(*)::bigint as freq, min(doc_id) as first_doc, arg_min(pos, (doc_id, pos)) as first_pos
from p group by 1, 2
""")
def a4_stream_pair_freq_cross(spark, sf):
    return stream_pair_freq(read_table(spark, sf, "documents"), cross_docs=True)


@register("A5_top_pairs", f"""
select "left", "right", freq from {PAIRS_SQL} where freq >= 2
order by freq desc, "left", "right" limit 10
""")
def a5_top_pairs(spark, sf):
    return top_pairs(pair_freq(word_freq(read_table(spark, sf, "documents"))), k=10)


@register("A5_top_stream_pairs_first_seen", f"""
with p as (select l[i] as "left", l[i + 1] as "right", doc_id, i as pos from {STREAM_SQL} s, range(1, len(l)) r(i)),
a as (select "left", "right", count(*)::bigint as freq, arg_min(pos, (doc_id, pos)) - 1 as first_pos,
             min(doc_id) as first_doc from p group by 1, 2)
select "left", "right", freq, first_doc, first_pos from a where freq >= 2
order by freq desc, first_doc, first_pos limit 10
""")
def a5_top_stream_pairs(spark, sf):
    p = stream_pair_freq(read_table(spark, sf, "documents"))
    return top_pairs(p, k=10, tie="first_seen").select("left", "right", "freq", "first_doc", "first_pos")


# scores = an embedding, target = label modulo its length.
_LOSS_SQL = """s as (select label, list_transform(embedding, lambda x: x::double) as sc, label % len(embedding) as tgt from embeddings),
l as (select label, list_max(sc) + ln(list_sum(list_transform(sc, lambda x: exp(x - list_max(sc))))) - sc[tgt + 1] as loss from s)"""


def _scores(spark, sf):
    return read_table(spark, sf, "embeddings").select("label", F.col("embedding").alias("scores"),
                                                      (F.col("label") % F.size("embedding")).alias("target"))


@register("A9_cross_entropy", f"""with {_LOSS_SQL}
select round(avg(loss), 6) as loss, count(*)::bigint as n, round(exp(avg(loss)), 6) as perplexity from l
""")
def a9_cross_entropy(spark, sf):
    r = cross_entropy(_scores(spark, sf), "scores", "target")
    return r.select(F.round("loss", 6).alias("loss"), "n", F.round("perplexity", 6).alias("perplexity"))


@register("A9_cross_entropy_by_label", f"""with {_LOSS_SQL}
select label, round(avg(loss), 6) as loss, count(*)::bigint as n, round(exp(avg(loss)), 6) as perplexity
from l group by label
""")
def a9_cross_entropy_by(spark, sf):
    r = cross_entropy(_scores(spark, sf), "scores", "target", by=["label"])
    return r.select("label", F.round("loss", 6).alias("loss"), "n", F.round("perplexity", 6).alias("perplexity"))


# A10: events as a metrics table: event_type = epoch, event_id = step, value = metric.
@register("A10_epoch_mean", """
select event_type, sum(value::decimal(38,6))::double / count(*) as mean_value, count(*)::bigint as n
from events group by event_type
""")
def a10_epoch_mean(spark, sf):
    per_epoch, _ = metric_rollup(read_table(spark, sf, "events"), "event_type", "event_id", "value")
    return per_epoch


@register("A10_running_mean", """
select event_type, event_id, value::decimal(38,6)::double as v,
       sum(value::decimal(38,6)) over w::double / count(*) over w as running_mean
from events
window w as (partition by event_type order by event_id rows between unbounded preceding and current row)
""")
def a10_running_mean(spark, sf):
    _, running = metric_rollup(read_table(spark, sf, "events"), "event_type", "event_id", "value")
    return running
