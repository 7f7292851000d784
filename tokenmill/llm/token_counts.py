"""Token counts (4): offset-mapped attribution to sections.

Every document is put together from its fields, encoded once as a whole, and
the character spans of its tokens are joined with the character spans of its
sections. A token that crosses a section's edge is allocated by a rule:

``start``     the section that holds the token's first character;
``end``       the section that holds its last character;
``majority``  the section with most of its characters, the earlier on ties.

Tokens that the rule gives to no section (they start, end or mostly lie in
the characters between sections) are counted in the section ``between``, so
the counts of a document add up to its tokens.

A document is ``<source>\\n<lang>\\n\\n<text>``; its sections are ``source``,
``lang``, ``lead`` (the first line of the text) and ``body`` (what follows).
The job is one narrow map.

Defined cases: a null field is an empty section; a null or empty text still
has its other fields' tokens; null ids, repeated rows and empty tables go row
by row; a very long text is encoded whole, one document at a time; a token that two
sections share alike goes to the first of them; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.byte_bpe import _codec, load_rank_file
from tokenmill.llm.common import map_batches, spread

RULES = ("start", "end", "majority")
Section = tuple[str, int, int]


def compose(source: str | None, lang: str | None, text: str | None) -> tuple[str, list[Section]]:
    """The whole document and its sections ``(name, first character, end)``."""
    source, lang, text = source or "", lang or "", text or ""
    a = len(source) + 1
    t = a + len(lang) + 2
    cut = text.find("\n")
    lead = len(text) if cut < 0 else cut
    return f"{source}\n{lang}\n\n{text}", [
        ("source", 0, len(source)), ("lang", a, a + len(lang)), ("lead", t, t + lead),
        ("body", t + min(lead + 1, len(text)), t + len(text))]


def token_spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of every token, given the tokens' byte lengths.
    A token that holds only part of a character spans that character."""
    data = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((data & 0xC0) != 0x80) - 1    # character that each byte belongs to
    ends = np.cumsum(lengths)
    return char[ends - lengths], char[ends - 1]


def attribute(first: np.ndarray, last: np.ndarray, sections: list[Section], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross its edge; one more
    entry for those between sections. Sections are disjoint and ascending."""
    lo = np.array([s for _, s, _ in sections])
    hi = np.array([e for _, _, e in sections])
    n = len(sections)
    if rule == "majority":
        best, owner = np.zeros(len(first), np.int64), np.full(len(first), n)
        for i in range(n):                         # sections are few
            common = np.minimum(last + 1, hi[i]) - np.maximum(first, lo[i])
            better = common > best
            best[better], owner[better] = common[better], i
        owner[2 * best < last - first + 1] = n
    else:
        at = first if rule == "start" else last
        owner = np.searchsorted(lo, at, side="right") - 1
        # empty sections share their first character with the next one
        inside = (owner >= 0) & (at < hi[np.maximum(owner, 0)])
        owner = np.where(inside, owner, n)
    crossing = (owner < n) & ((first < np.append(lo, 0)[owner]) | (last >= np.append(hi, 0)[owner]))
    return np.bincount(owner, minlength=n + 1), np.bincount(owner[crossing], minlength=n + 1)


def section_token_counts(docs: DataFrame, rank_path: str, pattern: str, rule: str = "start",
                         fields: tuple[str, ...] = ("source", "lang", "text"),
                         layout: Callable[..., tuple[str, list[Section]]] = compose,
                         id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, section, char_start, char_end, n_tokens, n_crossing)``, a row per
    document and section; ``layout`` makes the whole text and its sections from the fields."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")
    bc = load_rank_file(docs.sparkSession, rank_path)

    def run(b: pa.RecordBatch) -> dict:
        codec = _codec(bc, pattern)
        out: dict[str, list] = {k: [] for k in ("doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing")}
        for d, *values in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
            text, sections = layout(*values)
            ids = np.array(codec.encode(text), np.int64)
            first, last = token_spans(text, codec.lengths[ids])
            n, crossing = attribute(first, last, sections, rule)
            for (name, s, e), c, x in zip([*sections, ("between", None, None)], n.tolist(), crossing.tolist()):
                for k, v in zip(out, (d, name, s, e, c, x)):
                    out[k].append(v)
        return {k: pa.array(v, pa.string() if k == "section" else pa.int64()) for k, v in out.items()}

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                    *[F.col(f).cast("string").alias(f"field{i}") for i, f in enumerate(fields)])
    return map_batches(spread(d), run, "doc_id bigint, section string, char_start bigint, char_end bigint, "
                                       "n_tokens bigint, n_crossing bigint")
