"""Registered queries for embedding-table jobs (M2-M6).

Fixtures: ``embeddings.vec_id`` is the token id; positions for the
rotary job are the places in the sequence; a conversation turn takes the
vector ``(conv_id * 31 + turn)`` modulo the number of vectors. Vectors are
compared one dimension per row, rounded to 6 decimals.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.functions.text import pre_tokenize, word_ids
from tokenmill.functions.vectors import rms_normalize, rotary, softmax
from tokenmill.operators.vectors import causal_history, embed_tokens, softmax_over
from tokenmill.plans import sqlparts as Q
from tokenmill.plans.catalog import register
from tokenmill.sources.corpus import read_table


def _per_dim(df, key_cols, arr):
    return df.select(*key_cols, F.posexplode(arr).alias("dim", "value")) \
        .select(*key_cols, "dim", F.round("value", 6).alias("value"))


_SEQUENCES_SQL = f"""
t as (select item_id, {Q.byte_ids("array_to_string(" + Q.pretokens('text') + ", '')")} as l from benchmark),
u as (select item_id, generate_subscripts(l, 1) - 1 as pos, unnest(l) as token_id from t)"""


M2_SQL = f"""with {_SEQUENCES_SQL}
select item_id, pos::int as pos, token_id::int as token_id,
       array_to_string(list_transform(e.embedding, lambda x: round(x::double * 1000000)::bigint), ' ') as vec
from u left join embeddings e on e.vec_id = u.token_id
"""


def _looked_up(spark, sf, **limit):
    e = embed_tokens(_sequences(spark, sf), _table(spark, sf), "ids", key="item_id", **limit)
    whole = F.transform("vec", lambda x: F.round(x.cast("double") * 1000000).cast("bigint"))
    return e.select("item_id", "pos", "token_id", F.array_join(whole, " ").alias("vec"))


@register("M2_embed_tokens", M2_SQL)
def m2_embed(spark, sf):
    """Byte-level ids of the benchmark texts looked up in the embedding table, whole vectors (in millionths)."""
    return _looked_up(spark, sf)


@register("M2_embed_hot_tokens", M2_SQL)
def m2_embed_hot(spark, sf):
    """The same where the table is not to be broadcast: frequent ids apart from the others."""
    return _looked_up(spark, sf, broadcast_bytes=0)


def _sequences(spark, sf):
    return read_table(spark, sf, "benchmark").select(
        "item_id", word_ids(F.array_join(pre_tokenize("text"), "")).alias("ids"))


def _table(spark, sf):
    return read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("token_id"), F.col("embedding").alias("vec"))


@register("M3_embed_rotary", f"""with {_SEQUENCES_SQL},
x as (select item_id, pos, embedding as v, len(embedding) as n, generate_subscripts(embedding, 1) - 1 as d,
             unnest(embedding)::double as x from u join embeddings e on e.vec_id = u.token_id),
y as (select item_id, pos, x * cos(pos * pow(10000.0, -2.0 * (d % (n // 2)) / n))
        + (case when d < n // 2 then -v[d + n // 2 + 1]::double else v[d - n // 2 + 1]::double end)
          * sin(pos * pow(10000.0, -2.0 * (d % (n // 2)) / n)) as value from x)
select item_id, pos::int as pos, round(sum(value), 6) as total, round(sum(value * value), 6) as square from y group by 1, 2
""")
def m3_embed_rotary(spark, sf):
    """Lookup, then rotary by the place in the sequence: sum and squared norm of every vector."""
    e = embed_tokens(_sequences(spark, sf), _table(spark, sf), "ids", key="item_id").filter(F.col("vec").isNotNull())
    r = e.select("item_id", "pos", rotary("vec", F.col("pos")).alias("v"))
    add = lambda f: F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + f(x)), 6)
    return r.select("item_id", "pos", add(lambda x: x).alias("total"), add(lambda x: x * x).alias("square"))


@register("M3_rotary", """
with e as (select vec_id, list_transform(embedding, lambda x: x::double) as v, (vec_id % 32)::double as p from embeddings),
x as (select vec_id, p, v, len(v) as n, generate_subscripts(v, 1) - 1 as d, unnest(v) as x from e)
select vec_id, d::int as dim,
  round(x * cos(p * pow(10000.0, -2.0 * (d % (n // 2)) / n))
        + (case when d < n // 2 then -v[d + n // 2 + 1] else v[d - n // 2 + 1] end)
          * sin(p * pow(10000.0, -2.0 * (d % (n // 2)) / n)), 6) as value
from x
""")
def m3_rotary(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return _per_dim(e, ["vec_id"], rotary("embedding", F.col("vec_id") % 32))


@register("M4_rms_normalize", """
with e as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings),
s as (select vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x)) / len(v) + 1e-6) as r from e)
select vec_id, (generate_subscripts(v, 1) - 1)::int as dim, round(unnest(v) / r, 6) as value from s
""")
def m4_rms(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return _per_dim(e, ["vec_id"], rms_normalize("embedding"))


@register("M5_softmax_array", """
with e as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings),
s as (select vec_id, list_transform(v, lambda x: exp(x - list_max(v))) as ex from e)
select vec_id, (generate_subscripts(ex, 1) - 1)::int as dim, round(unnest(ex) / list_sum(ex), 6) as value from s
""")
def m5_softmax_array(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return _per_dim(e, ["vec_id"], softmax("embedding"))


CONV_VECS_SQL = """select c.conv_id, c.turn, list_transform(e.embedding, lambda x: x::double) as v
  from conversations c join embeddings e on e.vec_id = (c.conv_id * 31 + c.turn) % (select count(*) from embeddings)"""


def _conv_vecs(spark, sf):
    e = read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("k"), F.col("embedding").alias("v"))
    n = e.agg(F.count(F.lit(1))).scalar()
    c = read_table(spark, sf, "conversations").select("conv_id", "turn",
                                                      F.pmod(F.col("conv_id") * 31 + F.col("turn"), n).alias("k"))
    return c.join(e, "k").select("conv_id", "turn", "v")


@register("M5_softmax_over_turns", f"""
with c as ({CONV_VECS_SQL}), s as (select conv_id, turn, v[1] as score from c),
x as (select conv_id, turn, exp(score - max(score) over (partition by conv_id)) as ex from s)
select conv_id, turn, round(ex / sum(ex) over (partition by conv_id), 6) as weight from x
""")
def m5_softmax_over(spark, sf):
    c = _conv_vecs(spark, sf).select("conv_id", "turn", F.element_at("v", 1).cast("double").alias("score"))
    w = softmax_over(c, ["conv_id"], "score")
    return w.select("conv_id", "turn", F.round("weight", 6).alias("weight"))


@register("M6_causal_history", f"""
with c as ({CONV_VECS_SQL}),
p as (select a.conv_id, a.turn, b.v as bv, list_dot_product(a.v, b.v) / sqrt(len(a.v)) as s
      from c a join c b on a.conv_id = b.conv_id and b.turn <= a.turn),
q as (select conv_id, turn, bv, exp(s - max(s) over w) as ew from p window w as (partition by conv_id, turn)),
z as (select conv_id, turn, ew / sum(ew) over (partition by conv_id, turn) as wt, bv from q),
u as (select conv_id, turn, wt, generate_subscripts(bv, 1) - 1 as d, unnest(bv) as x from z)
select conv_id, turn, d::int as dim, round(sum(wt * x), 6) as value from u group by 1, 2, 3
""")
def m6_causal(spark, sf):
    h = causal_history(_conv_vecs(spark, sf), "conv_id", "turn", "v")
    return _per_dim(h, ["conv_id", "turn"], F.col("out"))
