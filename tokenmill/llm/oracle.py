"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

from tokenmill.llm import quality_rules as q
from tokenmill.llm import url_rules as u


def _str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(_str(x) for x in xs) + "]"


_WORD = r"'[^\x20\x09-\x0D]+'"


def quality_sql(source: str = "documents") -> str:
    w = _WORD
    line_words = f"regexp_extract_all(line, {w})"
    fails = f"""(
      (len(list_filter({line_words}, lambda x: list_contains({_list(q.SEPARATORS)}, x))) >= 2
       and 5 * len(list_filter({line_words}, lambda x: list_contains({_list(q.SEPARATORS)}, x))) >= len({line_words}))
      or (len({line_words}) >= {q.MIN_LINE_WORDS}
          and not list_contains({_list(q.TERMINAL)}, right({line_words}[-1], 1)))
      or 3 * len(list_filter({line_words}, lambda x: regexp_matches(x, {_str(q.NOISE)}))) > len({line_words})
      or regexp_matches(line, {_str('(?i)' + '|'.join(q.BOILERPLATE))}))"""
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from {source}),
words as (select r, regexp_extract_all(text, {w}) as ws from d),
windows as (select r, i, array_to_string(ws[i:i + {q.WINDOW - 1}], ' ') as win
            from (select r, ws, unnest(range(1, len(ws) - {q.WINDOW} + 2)) as i from words)),
again as (select r, i from (select r, i, count(*) over (partition by r, win) as c from windows) where c > 1),
covered as (select r, count(distinct i + j) as n from again, range({q.WINDOW}) t(j) group by r),
lines as (select r, k, ls[k] as line from (select r, ls, unnest(range(1, len(ls) + 1)) as k
          from (select r, string_split(text, chr(10)) as ls from d))),
judged as (select r, k, line, len({line_words}) as n, {fails} as fails from lines where len({line_words}) > 0),
by_line as (select r, count(*) - count(distinct line) as dup, coalesce(sum(n) filter (fails), 0) as lost
            from judged group by r),
counts as (select doc_id, len(ws) as n_words,
       length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) as word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
       coalesce(dup, 0) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words, coalesce(lost, 0) as n_lost_words
  from d join words using (r) left join covered c using (r) left join by_line using (r))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
       n_lost_words::bigint as n_lost_words,
       n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words as base_failed,
       not (n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words)
         and 100 * n_lost_words <= {q.MAX_LOST_PERCENT} * n_words as kept
from counts"""


def url_sql() -> str:
    rules = sorted(u.HOST_RULES, key=lambda r: -len(r[1] + r[2]))

    def fits(host, path):
        return f"((host = {_str(host)} or ends_with(host, {_str('.' + host)})) and starts_with(path, {_str(path)}))"

    rule = "case " + " ".join(f"when {fits(h, p)} then {_str(h + p)}" for _, h, p in rules) + " end"
    verdicts = "case rule " + " ".join(f"when {_str(h + p)} then {_str(v)}" for v, h, p in rules)
    spam = sorted(u.SPAM_WORDS, key=lambda x: (len(x), x), reverse=True)
    pattern = "case when rule is not null then null " + " ".join(
        f"when regexp_matches(lower(host || path), {_str('(^|[^a-z0-9])' + x + '($|[^a-z0-9])')}) then {_str(x)}"
        for x in spam) + " end"
    return f"""
with p as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
           from pages),
hp as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') as host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p),
r as (select *, {rule} as rule from hp),
s as (select *, {pattern} as pattern from r)
select page_id, host, path, rule, {verdicts} else case when pattern is not null then 'block' else 'allow' end end
       as verdict, pattern from s"""


QUALITY_RULES = quality_sql()
URL_FILTERS = url_sql()

LINE_WINDOWS = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select doc_id, k, ls[k] as line, regexp_replace(ls[k], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as bare
      from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as k from d)),
f as (select *, row_number() over (partition by doc_id order by k) as i from l where bare <> ''),
w as (select doc_id, i, bare || chr(10) || lead(bare) over s || chr(10) || lead(bare, 2) over s as win
      from f window s as (partition by doc_id order by i)),
later as (select doc_id, i from (select *, row_number() over (partition by win order by doc_id, i) as r
          from w where win is not null) where r > 1),
gone as (select distinct doc_id, i + j as i from later, range(3) t(j)),
runs as (select doc_id, count(*) as n_spans from (select doc_id, i, lag(i) over (partition by doc_id order by i) as p
         from gone) where p is null or p < i - 1 group by doc_id),
m as (select l.doc_id, l.k, l.line, f.i is not null as full_line, g.i is not null as drop_line
      from l left join f using (doc_id, k) left join gone g on g.doc_id = f.doc_id and g.i = f.i)
select doc_id, count(*) filter (full_line) as n_lines, count(*) filter (drop_line) as n_removed,
       coalesce(any_value(n_spans), 0) as n_spans,
       sha256(coalesce(string_agg(line, chr(10) order by k) filter (not drop_line), '')) as clean_sha256
from m left join runs using (doc_id) group by doc_id"""

EXACT_TOPK = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
           where embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
      from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20"""

HARD_NEGATIVES = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.v, c.v)::bigint as score
      from e a join e c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score
      from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as r from s where same)
      where r <= 5),
n as (select anchor_id, positive_id, s.vec_id as negative_id, positive_score, s.score as negative_score,
             row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id) as rank
      from p join s using (anchor_id)
      where not same and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 5"""


def lexical_sql() -> str:
    words = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
with d as (select row_number() over () as r, doc_id, {words} as ws from documents),
c as (select count(*) as n_docs, sum(len(ws))::bigint as n_terms from d where len(ws) > 0),
q as (select distinct item_id, term from (select item_id, unnest({words}) as term from benchmark)),
f as (select r, term, count(*) as tf from (select r, unnest(ws) as term from d) where term in (select term from q)
      group by r, term),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
      from f, c group by term, n_docs),
s as (select q.item_id, f.r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(d.ws) * n_docs) // n_terms))))
             ::bigint as score
      from q join f using (term) join w using (term) join d on d.r = f.r, c group by q.item_id, f.r)
select item_id, rank::int as rank, doc_id, score from (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank
  from s join d using (r) where score > 0 and doc_id is not null) where rank <= 50"""


LEXICAL_SEARCH = lexical_sql()
