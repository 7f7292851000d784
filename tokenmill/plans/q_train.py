"""Registered queries for vocabulary training (V1-V8), saved tokenizers
(S3, S4) and the trained model other queries use.

The oracle for training is "SQL-k": DuckDB replays k rounds of
count-pairs / pick-best / replace on the same word table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tokenmill.constants import FIRST_MERGE_ID, SPECIAL_TOKENS_19, SPECIAL_TOKENS_25
from tokenmill.functions.text import pair_repr, split_lossless
from tokenmill.operators.stats import word_freq
from tokenmill.operators.train import BpeModel, base_vocab, corpus_alphabet, train_bpe, words_to_symbols
from tokenmill.plans import sqlparts as Q
from tokenmill.plans.catalog import register
from tokenmill.session import ensure_checkpoint_dir
from tokenmill.sources.corpus import read_table
from tokenmill.sources.tokenizer_io import TOKENIZER_SCHEMA, read_tokenizer, read_tokenizer_tables, tokenizer_exists, write_tokenizer

TRAIN_K = 64       # merges of the registered exact training
MODEL_K = 32       # merges of the model that encode, window and statistics queries use
SMALL_VOCAB = FIRST_MERGE_ID + MODEL_K
FIRST_ID_25 = len(SPECIAL_TOKENS_25) + 256


def merges_sql(words_sql: str, k: int, first_id: int | str = FIRST_MERGE_ID, preset_cte: str | None = None,
               preset_k: int = 0, prefix: str = "", offset: int = 19, alphabet_cte: str | None = None) -> tuple[str, str]:
    """CTE text for k training rounds over ``words_sql`` (columns word, n).

    Words are strings ``<id><id>...``; a merge is a ``replace`` of
    ``<a><b>`` by ``<n>``. The ``preset_k`` merges of the CTE ``preset_cte``
    (columns rank, left, right, new_id) are applied first, in rank order.
    The CTE ``alphabet_cte`` (a list ``bs`` of bytes) gives ids ``offset``, ... to its bytes
    and 0 to others; ``first_id`` can then be an SQL expression.
    Returns (ctes, name of the merges CTE); the words after all merges are in
    the CTE ``<prefix>done`` (columns word, n, s).
    """
    x = prefix
    ids, source = Q.byte_ids("word", offset), f"{x}w"
    if alphabet_cte:
        byte = "('0x' || x)::int"
        ids = (f"list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x: case when list_contains(bs, {byte}) "
               f"then {offset - 1} + list_position(bs, {byte}) else 0 end)")
        source += f", {alphabet_cte}"
    ctes = [f"{x}w as materialized ({words_sql})",
            f"{x}r0 as materialized (select word, n, '<' || array_to_string({ids}, '><') || '>' as s from {source})"]
    last = f"{x}r0"
    for j in range(preset_k):
        pat = f"(select '<' || \"left\" || '><' || \"right\" || '>' from {preset_cte} where rank = {j})"
        rep = f"(select '<' || new_id || '>' from {preset_cte} where rank = {j})"
        ctes.append(f"{x}pre{j} as materialized (select word, n, replace(s, {pat}, {rep}) as s from {last})")
        last = f"{x}pre{j}"
    sel = []
    for i in range(k):
        cur = last if i == 0 else f"{x}r{i}x"
        ctes.append(f"{x}e{i} as materialized (select n, string_split(s[2:-2], '><') as l from {cur})")
        ctes.append(
            f"{x}p{i} as materialized (select a::int as a, b::int as b, sum(n)::bigint as f from "
            f"(select n, unnest(l[1:-2]) as a, unnest(l[2:]) as b from {x}e{i} where len(l) > 1) "
            f"group by 1, 2 having sum(n) >= 2 order by f desc, a, b limit 1)")
        ctes.append(
            f"{x}r{i + 1}x as materialized (select word, n, replace(s, coalesce((select '<' || a || '><' || b || '>' "
            f"from {x}p{i}), '<none>'), '<' || ({first_id} + {i}) || '>') as s from {cur})")
        sel.append(f"select {preset_k + i} as rank, a as \"left\", b as \"right\", ({first_id} + {i})::int as new_id, "
                   f"f as freq, (select sum(n * (length(s) - length(replace(s, '<', ''))))::bigint "
                   f"from {x}r{i + 1}x) as tokens_after from {x}p{i}")
        last = f"{x}r{i + 1}x"
    if sel:
        ctes.append(f"{x}m as materialized (" + " union all ".join(sel) + ")")
    ctes.append(f"{x}done as (select word, n, s from {last})")
    return ",\n".join(ctes), f"{x}m"


WORDS_SQL = f"""select word, count(*)::bigint as n
  from (select unnest({Q.pretokens('text')}) as word from documents) group by word"""
MERGE_COLUMNS = "rank, \"left\", \"right\", new_id, freq, tokens_after"
_train_ctes, _train_m = merges_sql(WORDS_SQL, TRAIN_K)
TRAIN_SQL = f"with {_train_ctes}\nselect {MERGE_COLUMNS} from {_train_m}"
MODEL_CTES, MODEL_M = merges_sql(WORDS_SQL, MODEL_K)


def trained_model(spark, sf: str) -> BpeModel:
    """The exact model with ``MODEL_K`` merges of all documents. It is saved (S3)
    in the shared folder under a fingerprint of the documents and loaded (S4)
    by later queries of the same data, never kept in the process."""
    docs = read_table(spark, sf, "documents")
    n, mark = docs.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("doc_id", "text")), F.lit(0))).first()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokenizer-{MODEL_K}-{n}-{mark & (2 ** 64 - 1):016x}"
    if not tokenizer_exists(spark, path):
        write_tokenizer(spark, train_bpe(word_freq(docs), SMALL_VOCAB), path, trained_on="documents")
    return read_tokenizer(spark, path)


@register("V1_base_vocab", "with s as (select unnest(["
          + ", ".join("'" + t + "'" for t in SPECIAL_TOKENS_19)
          + "]) as t, generate_subscripts(["
          + ", ".join("'" + t + "'" for t in SPECIAL_TOKENS_19)
          + "], 1) - 1 as id)\n"
          "select id::int as id, hex(encode(t)) as hex, 'special' as kind from s\n"
          "union all select (19 + range)::int, lpad(upper(to_hex(range)), 2, '0'), 'byte' from range(256)")
def v1_base_vocab(spark, sf):
    v = base_vocab(spark)
    return v.select("id", F.hex("bytes").alias("hex"), "kind")


@register("V2_apply_merges", f"""with {MODEL_CTES}
select word, n, replace(s[2:-2], '><', ' ') as ids from done""")
def v2_apply_merges(spark, sf):
    """All merges of the model applied, in rank order, to every distinct word."""
    from tokenmill.functions.text import symbols_to_ids
    from tokenmill.operators.codec import replay_merges
    words = words_to_symbols(word_freq(read_table(spark, sf, "documents")), keep_word=True)
    return replay_merges(words, trained_model(spark, sf).merges).select(
        "word", "n", F.array_join(symbols_to_ids(F.col("syms")), " ").alias("ids"))


@register("V3_train_exact", TRAIN_SQL)
def v3_train(spark, sf):
    """Exact word-level BPE on all documents: the merge log."""
    return train_bpe(word_freq(read_table(spark, sf, "documents")), FIRST_MERGE_ID + TRAIN_K).merges_df(spark)


FULL_VOCAB = 15_000


@register("V3_train_vocab_15000")
def v3_train_full(spark, sf):
    """Exact word-level BPE to a vocabulary of 15,000 ids (too many rounds for SQL; the tests hold
    thousands of merges against plain Python)."""
    return train_bpe(word_freq(read_table(spark, sf, "documents")), FULL_VOCAB).merges_df(spark)


STALE_K = 32


def stale_drop_sql(words_sql: str, k: int) -> str:
    """Replay of the lazy heap: ``h`` holds its entries (l, r, f), ``c`` the current
    counts. The best entry is the first in order whose count is current; it and
    all before it leave; pairs whose count rose by the merge enter with it."""
    ctes = [f"w as materialized ({words_sql})",
            f"s0 as materialized (select n, '<' || array_to_string({Q.byte_ids('word')}, '><') || '>' as s from w)"]

    def count(i: int) -> str:
        return (f"c{i} as materialized (select a::int as l, b::int as r, sum(n)::bigint as f from "
                f"(select n, unnest(x[1:-2]) as a, unnest(x[2:]) as b from "
                f"(select n, string_split(s[2:-2], '><') as x from s{i}) where len(x) > 1) group by 1, 2)")

    ctes += [count(0), "h0 as materialized (select * from c0 where f >= 2)"]
    sel = []
    for i in range(k):
        new = FIRST_MERGE_ID + i
        ctes.append(f"b{i} as materialized (select h.* from h{i} h join c{i} c using (l, r, f) "
                    f"where f >= 2 order by f desc, l, r limit 1)")
        ctes.append(f"s{i + 1} as materialized (select n, replace(s, coalesce((select '<' || l || '><' || r || '>' "
                    f"from b{i}), '<none>'), '<{new}>') as s from s{i})")
        ctes.append(count(i + 1))
        ctes.append(f"h{i + 1} as materialized (select h.* from h{i} h, b{i} b where (-h.f, h.l, h.r) > (-b.f, b.l, b.r) "
                    f"union select a.* from c{i + 1} a left join c{i} o on a.l = o.l and a.r = o.r "
                    f"where a.f > coalesce(o.f, 0))")
        sel.append(f"select {i} as rank, l as \"left\", r as \"right\", {new} as new_id, f as freq, (select "
                   f"sum(n * (length(s) - length(replace(s, '<', ''))))::bigint from s{i + 1}) as tokens_after from b{i}")
    return "with " + ",\n".join(ctes) + "\n" + " union all ".join(sel)


@register("V4_train_stale_drop", stale_drop_sql(WORDS_SQL, STALE_K))
def v4_train_stale_drop(spark, sf):
    """The lazy-heap selection of the reference trainer; it parts from exact selection after six merges."""
    m = train_bpe(word_freq(read_table(spark, sf, "documents")), FIRST_MERGE_ID + STALE_K,
                  selection="stale_drop")
    return m.merges_df(spark)


@register("V8_merge_log_printable", f"""with recursive {_train_ctes},
parts(id, rest) as (select new_id, '<' || "left" || '><' || "right" || '>' from {_train_m}
  union all select p.id, replace(p.rest, '<' || m.new_id || '>', '<' || m."left" || '><' || m."right" || '>')
  from parts p join {_train_m} m on m.new_id = (select max(y::int) from unnest(string_split(p.rest[2:-2], '><')) u(y))),
leaf as (select id, rest from parts
  where list_max(list_transform(string_split(rest[2:-2], '><'), lambda x: x::int)) < {FIRST_MERGE_ID}),
bytes as (select id, array_to_string(list_transform(string_split(rest[2:-2], '><'),
            lambda x: lpad(to_hex(x::int - 19), 2, '0')), '') as h from leaf
          union all select 19 + range::int, lpad(to_hex(range), 2, '0') from range(256))
select {MERGE_COLUMNS}, upper(l.h) as left_hex, upper(r.h) as right_hex
from {_train_m} join bytes l on l.id = "left" join bytes r on r.id = "right" """)
def v8_merge_log(spark, sf):
    """Merge log with the bytes of each pair."""
    m = train_bpe(word_freq(read_table(spark, sf, "documents")), FIRST_MERGE_ID + TRAIN_K)
    return _with_bytes(spark, m).select("rank", "left", "right", "new_id", "freq", "tokens_after",
                                        F.hex("lb").alias("left_hex"), F.hex("rb").alias("right_hex"))


def printable_sql(hexes: str) -> str:
    """The printable form of bytes given as hex digits (see the fixed ranges in ``constants``)."""
    b = "('0x' || x)::int"
    return (f"array_to_string(list_transform(regexp_extract_all({hexes}, '..'), lambda x: chr(case when {b} < 33 then 256 + {b} "
            f"when {b} between 127 and 160 then 162 + {b} when {b} = 173 then 323 else {b} end)), '')")


_special_rows = " union all ".join(f"select {i} as id, '{t}' as form" for i, t in enumerate(SPECIAL_TOKENS_19))


@register("S3_tokenizer_file", f"""with recursive {MODEL_CTES},
parts(id, rest) as (select new_id, '<' || "left" || '><' || "right" || '>' from {MODEL_M}
  union all select p.id, replace(p.rest, '<' || m.new_id || '>', '<' || m."left" || '><' || m."right" || '>')
  from parts p join {MODEL_M} m on m.new_id = (select max(y::int) from unnest(string_split(p.rest[2:-2], '><')) u(y))),
bytes as (select id, array_to_string(list_transform(string_split(rest[2:-2], '><'),
            lambda x: lpad(to_hex(x::int - 19), 2, '0')), '') as h from parts
          where list_max(list_transform(string_split(rest[2:-2], '><'), lambda x: x::int)) < {FIRST_MERGE_ID}
          union all select 19 + range::int, lpad(to_hex(range), 2, '0') from range(256)),
forms as (select id, {printable_sql('h')} as form from bytes)
select 'vocab' as part, id::int as place, form as line from forms union all select 'vocab', id, form from ({_special_rows})
union all select 'merge', rank::int, l.form || ' ' || r.form from {MODEL_M} join forms l on l.id = "left" join forms r on r.id = "right"
""")
def s3_tokenizer_file(spark, sf):
    """Every vocabulary entry and merge line of the written tokenizer file itself."""
    path = _scratch(spark, "tokenizer")
    write_tokenizer(spark, train_bpe(word_freq(read_table(spark, sf, "documents")), SMALL_VOCAB), path, "documents")
    doc = spark.read.schema(TOKENIZER_SCHEMA).option("multiLine", "true").json(f"{path}/tokenizer.json")
    vocab = doc.select(F.explode("model.vocab").alias("line", "place")).select(F.lit("vocab").alias("part"), "place", "line")
    return vocab.unionByName(doc.select(F.posexplode("model.merges").alias("place", "line")).select(
        F.lit("merge").alias("part"), "place", "line"))


def _with_bytes(spark, m: BpeModel):
    vocab = m.vocab_df(spark).select("id", "bytes")
    lv = vocab.select(F.col("id").alias("left"), F.col("bytes").alias("lb"))
    rv = vocab.select(F.col("id").alias("right"), F.col("bytes").alias("rb"))
    # the vocabulary has at most vocab_size rows: a bounded broadcast side
    return m.merges_df(spark).join(F.broadcast(lv), "left").join(F.broadcast(rv), "right")


# One UTF-8 sequence in hex digits, or the longest part of one that can be replaced as a whole.
_ONE_CHAR = "[0-7].|(?:C[2-9A-F]|D.)[89AB].|E0[AB].[89AB].|(?:E[1-9A-CEF])[89AB].[89AB].|ED[89].[89AB].|" \
            "F0[9AB].[89AB].[89AB].|F[1-3][89AB].[89AB].[89AB].|F48.[89AB].[89AB]."
_CHAR_PARTS = _ONE_CHAR + "|E0[AB].|E[1-9A-CEF][89AB].|ED[89].|F0[9AB].[89AB].|F[1-3][89AB].[89AB].|F48.[89AB].|" \
                          "F0[9AB].|F[1-3][89AB].|F48.|.."


def _byte(k: int) -> str:
    return f"('0x' || substr(x, {2 * k + 1}, 2))::int"


def repr_sql(hexes: str) -> str:
    """T9 of bytes given as upper-case hex digits: lenient UTF-8, then the escapes of a Python string."""
    code = (f"case when not regexp_full_match(x, '{_ONE_CHAR}') then 65533 when len(x) = 2 then {_byte(0)} "
            f"when len(x) = 4 then ({_byte(0)} & 31) * 64 + ({_byte(1)} & 63) "
            f"when len(x) = 6 then (({_byte(0)} & 15) * 64 + ({_byte(1)} & 63)) * 64 + ({_byte(2)} & 63) "
            f"else ((({_byte(0)} & 7) * 64 + ({_byte(1)} & 63)) * 64 + ({_byte(2)} & 63)) * 64 + ({_byte(3)} & 63) end")
    codes = f"list_transform(regexp_extract_all({hexes}, '{_CHAR_PARTS}'), lambda x: {code})"
    both = f"(list_contains({codes}, 39) and list_contains({codes}, 34))"
    shown = (f"case when c = 92 then chr(92) || chr(92) when c = 10 then chr(92) || 'n' when c = 13 then chr(92) || 'r' "
             f"when c = 9 then chr(92) || 't' when c = 39 and {both} then chr(92) || chr(39) "
             f"when c = 32 or not (c < 32 or regexp_matches(chr(c), '[\\p{{Z}}\\p{{C}}]')) then chr(c) "
             f"when c < 256 then chr(92) || 'x' || lpad(to_hex(c), 2, '0') "
             f"when c < 65536 then chr(92) || 'u' || lpad(to_hex(c), 4, '0') "
             f"else chr(92) || 'U' || lpad(to_hex(c), 8, '0') end")
    shown = shown.replace("to_hex(c)", "lower(to_hex(c))")
    return f"array_to_string(list_transform({codes}, lambda c: {shown}), '')"


@register("T9_pair_repr", f"""with recursive {MODEL_CTES},
parts(id, rest) as (select new_id, '<' || "left" || '><' || "right" || '>' from {MODEL_M}
  union all select p.id, replace(p.rest, '<' || m.new_id || '>', '<' || m."left" || '><' || m."right" || '>')
  from parts p join {MODEL_M} m on m.new_id = (select max(y::int) from unnest(string_split(p.rest[2:-2], '><')) u(y))),
bytes as (select id, upper(array_to_string(list_transform(string_split(rest[2:-2], '><'),
            lambda x: lpad(to_hex(x::int - 19), 2, '0')), '')) as h from parts
          where list_max(list_transform(string_split(rest[2:-2], '><'), lambda x: x::int)) < {FIRST_MERGE_ID}
          union all select 19 + range::int, upper(lpad(to_hex(range), 2, '0')) from range(256))
select rank, '(' || {repr_sql('l.h')} || ' , ' || {repr_sql('r.h')} || ')' as pair
from {MODEL_M} join bytes l on l.id = "left" join bytes r on r.id = "right"
""")
def t9_pair_repr(spark, sf):
    """Printable form of the pair of every merge (held against Python's repr in the tests)."""
    return _with_bytes(spark, trained_model(spark, sf)).select("rank", pair_repr("lb", "rb").alias("pair"))


EXTEND_K = 64
_d, _dm = merges_sql(WORDS_SQL, EXTEND_K, prefix="d_")
BENCH_WORDS_SQL = f"""select word, count(*)::bigint as n
  from (select unnest({Q.pretokens('text')}) as word from benchmark) group by word"""
_b, _bm = merges_sql(BENCH_WORDS_SQL, EXTEND_K, first_id=FIRST_MERGE_ID + EXTEND_K,
                     preset_cte=_dm, preset_k=EXTEND_K, prefix="b_")
EXTEND_SQL = f"with {_d},\n{_b}\nselect {MERGE_COLUMNS} from {_dm} union all select {MERGE_COLUMNS} from {_bm}"


@register("V6_extend_vocab", EXTEND_SQL)
def v6_extend(spark, sf):
    """Learn merges on documents, then as many more on the benchmark texts
    (earlier merges applied to the new words first)."""
    first = train_bpe(word_freq(read_table(spark, sf, "documents")), FIRST_MERGE_ID + EXTEND_K)
    more = train_bpe(word_freq(read_table(spark, sf, "benchmark")), FIRST_MERGE_ID + 2 * EXTEND_K, base_model=first)
    return more.merges_df(spark)


CHUNK_K, CHUNKS = 16, ("de", "en", "es", "fr")


def chunks_sql(k: int, chunks: tuple[str, ...]) -> str:
    """Chunk after chunk: the words of all chunks so far, the merges so far, k more."""
    ctes, so_far = [], None
    for j in range(len(chunks)):
        langs = ", ".join(f"'{c}'" for c in chunks[:j + 1])
        words = WORDS_SQL.replace("from documents", f"from documents where lang in ({langs})")
        text, m = merges_sql(words, k, first_id=FIRST_MERGE_ID + j * k, preset_cte=so_far, preset_k=j * k, prefix=f"c{j}_")
        ctes += [text, f"so_far{j} as (" + (f"select * from {so_far} union all " if so_far else "") + f"select * from {m})"]
        so_far = f"so_far{j}"
    return "with " + ",\n".join(ctes) + f"\nselect rank, \"left\", \"right\", new_id from {so_far}"


@register("V6_train_chunks", chunks_sql(CHUNK_K, CHUNKS))
def v6_train_chunks(spark, sf):
    """The documents arrive language by language; every chunk adds its counts and 16 merges."""
    from tokenmill.streaming.train_chunks import train_chunk
    docs, folder, model = read_table(spark, sf, "documents"), _scratch(spark, "chunks"), None
    for i, lang in enumerate(CHUNKS):
        model = train_chunk(word_freq(docs.filter(F.col("lang") == lang)), i, folder, FULL_VOCAB, CHUNK_K)
    return model.merges_df(spark).select("rank", "left", "right", "new_id")


def _scratch(spark, name: str) -> str:
    """A fresh folder under the session's (shared) checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


@register("S4_tokenizer_roundtrip_merges", f"with {MODEL_CTES}\nselect rank, \"left\", \"right\", new_id from {MODEL_M}")
def s4_roundtrip(spark, sf):
    """Train, save (S3), load (S4): the merges survive."""
    path = _scratch(spark, "tokenizer")
    write_tokenizer(spark, train_bpe(word_freq(read_table(spark, sf, "documents")), SMALL_VOCAB), path, "documents")
    _vocab, merges = read_tokenizer_tables(spark, path)
    return merges.select(F.col("rank").cast("int").alias("rank"), "left", "right", "new_id")


@register("S4_tokenizer_roundtrip_vocab", f"""with {MODEL_CTES}
select (275 + count(*))::bigint as vocab_size, 19::bigint as n_special, (275 + count(*))::bigint as entries from {MODEL_M}""")
def s4_roundtrip_vocab(spark, sf):
    path = _scratch(spark, "tokenizer")
    write_tokenizer(spark, train_bpe(word_freq(read_table(spark, sf, "documents")), SMALL_VOCAB), path, "documents")
    vocab, _ = read_tokenizer_tables(spark, path)
    return vocab.agg((F.max("id") + 1).cast("bigint").alias("vocab_size"),
                     F.count_if(F.col("kind") == "special").cast("bigint").alias("n_special"),
                     F.count(F.lit(1)).cast("bigint").alias("entries"))


STREAM_K = 64


def _stream_sql(k: int) -> str:
    """SQL-k for V5: documents as ``<id>`` strings, ties by first place seen."""
    text = f"array_to_string({Q.pretokens(Q.clean('text'))}, '')"
    ctes = [f"s0 as materialized (select doc_id, '<' || array_to_string({Q.byte_ids(text)}, '><') || '>' as s from documents)"]
    sel = []
    for i in range(k):
        ctes.append(f"e{i} as materialized (select doc_id, string_split(s[2:-2], '><') as l from s{i})")
        ctes.append(
            f"p{i} as materialized (select a::int as a, b::int as b, count(*)::bigint as f, min(doc_id * 100000000 + pos) as first "
            f"from (select doc_id, unnest(l[1:-2]) as a, unnest(l[2:]) as b, generate_subscripts(l[1:-2], 1) as pos "
            f"from e{i} where len(l) > 1) group by 1, 2 having count(*) >= 2 order by f desc, first limit 1)")
        ctes.append(f"s{i + 1} as materialized (select doc_id, replace(s, coalesce((select '<' || a || '><' || b || '>' "
                    f"from p{i}), '<none>'), '<{FIRST_MERGE_ID + i}>') as s from s{i})")
        sel.append(f"select {i} as rank, a as \"left\", b as \"right\", {FIRST_MERGE_ID + i} as new_id, f as freq, "
                   f"(select sum(length(s) - length(replace(s, '<', '')))::bigint from s{i + 1}) as tokens_after from p{i}")
    return "with " + ",\n".join(ctes) + "\n" + " union all ".join(sel)


@register("V5_train_stream", _stream_sql(STREAM_K))
def v5_train_stream(spark, sf):
    """Flat-stream training (merges cross words), first-seen ties."""
    from tokenmill.operators.train_stream import train_bpe_stream
    m = train_bpe_stream(read_table(spark, sf, "documents"), FIRST_MERGE_ID + STREAM_K)
    return m.merges_df(spark)


LOSSLESS_WORDS_SQL = f"""select word, count(*)::bigint as n
  from (select unnest({Q.lossless('text')}) as word from documents) group by word"""
LOSSLESS_K = 64
LOSSLESS_CTES, LOSSLESS_M = merges_sql(LOSSLESS_WORDS_SQL, LOSSLESS_K, first_id=FIRST_ID_25, prefix="g_",
                                       offset=len(SPECIAL_TOKENS_25))


def train_lossless(spark, sf) -> BpeModel:
    words = lossless_words(read_table(spark, sf, "documents"))
    return train_bpe(words, FIRST_ID_25 + LOSSLESS_K, specials=list(SPECIAL_TOKENS_25))


@register("V7_train_lossless_split", f"with {LOSSLESS_CTES}\nselect {MERGE_COLUMNS} from {LOSSLESS_M}")
def v7_train_lossless(spark, sf):
    """Lossless-split words (T7, no cleaning), 25 specials, exact selection."""
    return train_lossless(spark, sf).merges_df(spark)


def alphabet_sql(words_sql: str, name: str) -> str:
    """A CTE with the list ``bs`` of the distinct bytes of all words."""
    return (f"{name} as materialized (select list(b order by b) as bs from (select distinct ('0x' || x)::int as b from "
            f"(select unnest(regexp_extract_all(hex(encode(word)), '..')) as x from ({words_sql}))))")


ALPHABET_FIRST = f"((select len(bs) from {{}}) + {len(SPECIAL_TOKENS_25)})"
_alpha_ctes, ALPHABET_M = merges_sql(LOSSLESS_WORDS_SQL, LOSSLESS_K, first_id=ALPHABET_FIRST.format("alpha"), prefix="a_",
                                     offset=len(SPECIAL_TOKENS_25), alphabet_cte="alpha")
ALPHABET_CTES = alphabet_sql(LOSSLESS_WORDS_SQL, "alpha") + ",\n" + _alpha_ctes


def lossless_words(docs):
    return docs.select(F.explode(split_lossless("text")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@register("V7_train_corpus_alphabet", f"with {ALPHABET_CTES}\nselect {MERGE_COLUMNS} from {ALPHABET_M}")
def v7_train_alphabet(spark, sf):
    """Lossless-split words, 25 specials, ids only for the bytes that the documents have."""
    words = lossless_words(read_table(spark, sf, "documents"))
    size = len(SPECIAL_TOKENS_25) + len(corpus_alphabet(words)) + LOSSLESS_K
    return train_bpe(words, size, specials=list(SPECIAL_TOKENS_25), alphabet="corpus").merges_df(spark)


ENGLISH_WORDS_SQL = LOSSLESS_WORDS_SQL.replace("from documents", "from documents where lang = 'en'")
_en_ctes, _en_m = merges_sql(ENGLISH_WORDS_SQL, MODEL_K, first_id=ALPHABET_FIRST.format("en"), prefix="e_",
                             offset=len(SPECIAL_TOKENS_25), alphabet_cte="en")
_all_ctes, _ = merges_sql(LOSSLESS_WORDS_SQL, 0, preset_cte=_en_m, preset_k=MODEL_K, prefix="u_",
                          offset=len(SPECIAL_TOKENS_25), alphabet_cte="en")


@register("V7_encode_unseen_bytes", f"""with {alphabet_sql(ENGLISH_WORDS_SQL, "en")},
{_en_ctes},
{_all_ctes},
t as (select doc_id, unnest({Q.lossless('text')}) as word, generate_subscripts({Q.lossless('text')}, 1) as pos from documents),
p as (select doc_id, string_agg(s[2:-2], '><' order by pos) as s from t join u_done using (word) group by doc_id)
select doc_id, coalesce(len(string_split(s, '><')), 0)::bigint as num_tokens,
       coalesce(len(list_filter(string_split(s, '><'), lambda x: x = '0')), 0)::bigint as n_unknown,
       coalesce(replace(s, '><', ' '), '') as ids
from documents left join p using (doc_id)""")
def v7_encode_unseen(spark, sf):
    """All documents by a tokenizer whose alphabet is that of the English ones, saved and
    loaded: bytes that these do not have are ``<unk>``."""
    from tokenmill.operators.codec import encode_corpus
    docs = read_table(spark, sf, "documents")
    words = lossless_words(docs.filter("lang = 'en'"))
    size = len(SPECIAL_TOKENS_25) + len(corpus_alphabet(words)) + MODEL_K
    path = _scratch(spark, "tokenizer")
    write_tokenizer(spark, train_bpe(words, size, specials=list(SPECIAL_TOKENS_25), alphabet="corpus"), path, "documents")
    enc = encode_corpus(docs, read_tokenizer(spark, path), mode="ranked", splitter="lossless")
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("num_tokens"),
                      F.size(F.filter("ids", lambda i: i == 0)).cast("bigint").alias("n_unknown"),
                      F.array_join("ids", " ").alias("ids"))


@register("S4_roundtrip_25_specials", f"""with {LOSSLESS_CTES}
select rank, "left", "right", new_id, 25 as byte_offset, 25 as n_special from {LOSSLESS_M}""")
def s4_roundtrip_25(spark, sf):
    """A tokenizer with 25 specials saved and loaded: merges, byte offset and specials survive."""
    path = _scratch(spark, "tokenizer")
    write_tokenizer(spark, train_lossless(spark, sf), path, "documents")
    m = read_tokenizer(spark, path)
    return m.merges_df(spark).select("rank", "left", "right", "new_id", F.lit(m.byte_offset).alias("byte_offset"),
                                     F.lit(len(m.specials)).alias("n_special"))
