"""Quality rules (2): line-first cleaning.

Every line is judged by punctuation, navigation and boilerplate rules (in the
pipeline form hard-wrapped lines as one paragraph, see ``failing_lines``);
failing lines go, then a document that lost too large a share of its words
is rejected. Counts that whole-document rules need (symbols, repeated
lines, repeated 8-word windows) come from the same pass. The job is one
narrow map over whole texts: no shuffle, nothing kept between rows.

Defined cases: null or empty text has no words, fails the base rule and is
rejected; very long texts and lines are judged whole; of equal lines the first is no
repetition; null ids, repeated rows and further columns, whatever their names, pass
through (one result per input row); an empty table gives an empty table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import map_batches, spread, texts_as_bytes

WINDOW = 8                  # words in a window that must not repeat
MIN_WORDS = 20              # fewer words: base rule fails
MAX_REPEAT_PERCENT = 30     # more words in repeated windows: base rule fails
MAX_LOST_PERCENT = 50       # more words in failing lines: rejected
MIN_LINE_WORDS = 4          # shorter lines (headings) need no final punctuation

WHITESPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
SEPARATORS = ("|", "»", "›", "•", ">")
TERMINAL = ".!?…:;\"'”’»)]}"
BOILERPLATE = ("cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved",
               "enable javascript", "lorem ipsum", "click here", "read more", "sign up for", "log in to",
               "share this", "subscribe to our")
MIN_WRAP, MAX_WRAP = 40, 120     # characters in the longest line of hard-wrapped text
NOISE = r"!!|[%*#$&]{3}"

_SEP = frozenset(s.encode() for s in SEPARATORS)
_TERMINAL = tuple(c.encode() for c in TERMINAL)
_BOILER = re.compile("|".join(BOILERPLATE).encode())
_WHOLE_BOILER = re.compile(r"\b(?:" + "|".join(BOILERPLATE) + r")\b")
_SENTENCE = tuple(c.encode() for m in ".!?…" for c in (m, *(m + q for q in "\"'”’»)]}")))
_NOISE = re.compile(NOISE.encode())


def navigation(line: bytes, words: list[bytes]) -> bool:
    seps = sum(w in _SEP for w in words) if any(s in line for s in _SEP) else 0
    return seps >= 2 and 5 * seps >= len(words)


def noisy(line: bytes, words: list[bytes]) -> bool:
    return _NOISE.search(line) is not None and 3 * sum(_NOISE.search(w) is not None for w in words) > len(words)


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """Navigation: separators are a fifth of the words, two at least.
    Punctuation: a line of four words or more has no closing mark, or more
    than a third of its words carry doubled marks or symbol runs.
    Boilerplate: one of the fixed phrases, ASCII case ignored."""
    if navigation(line, words) or noisy(line, words):
        return True
    if len(words) >= MIN_LINE_WORDS and not words[-1].endswith(_TERMINAL):
        return True
    return _BOILER.search(line.lower()) is not None


def boilerplate_share(line: bytes, n: int) -> bool:
    """The phrases, as whole words, are at least a quarter of the line's words."""
    if not _BOILER.search(line.lower()):
        return False
    return 4 * sum(len(p.split()) for p in _WHOLE_BOILER.findall(line.decode().lower())) >= n


def unfinished(words: list[bytes]) -> bool:
    """No closing mark at the end, and no sentence that ends within closes half of the words."""
    n = len(words)
    if n < MIN_LINE_WORDS or words[-1].endswith(_TERMINAL):
        return False
    closed = next((i + 1 for i in range(n - 1, -1, -1) if words[i].endswith(_SENTENCE)), 0)
    return 2 * (n - closed) > n


def wrapped_paragraphs(lines: list[bytes], words: list[list[bytes]]) -> list[tuple[int, int]]:
    """Ranges of lines that are one hard-wrapped paragraph each; other lines are alone.
    In a block of lines without a blank one between, none longer than ``MAX_WRAP``,
    a line goes on in the next if it has no closing mark and the next one's first
    word would have made it longer than the longest line."""
    out, at = [], 0
    while at < len(lines):
        end = at + 1
        if words[at]:
            while end < len(lines) and words[end]:
                end += 1
            size = [len(x.decode().strip()) for x in lines[at:end]] if end - at > 1 else [0]
            width = max(size)
            first = at
            for i in range(at, end):
                if i + 1 < end and MIN_WRAP <= width <= MAX_WRAP and not words[i][-1].endswith(_TERMINAL) \
                        and size[i - at] + 1 + len(words[i + 1][0].decode()) > width:
                    continue
                out.append((first, i + 1))
                first = i + 1
        else:
            out.append((at, end))
        at = end
    return out


def failing_lines(lines: list[bytes], words: list[list[bytes]]) -> list[bool]:
    """Pipeline form of ``line_fails``, which must keep clean documents however long
    their lines are: marks and noise alike, but a closing mark is asked of a whole
    paragraph, and boilerplate must be a large share of its line."""
    fails = [bool(w) and (navigation(x, w) or noisy(x, w) or boilerplate_share(x, len(w)))
             for x, w in zip(lines, words)]
    for a, z in wrapped_paragraphs(lines, words):
        if unfinished([x for w in words[a:z] for x in w]):
            fails[a:z] = [True] * (z - a)
    return fails


def repeated_window_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside ``width``-word windows that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    key = np.zeros(n, np.uint64)
    for j in range(width):                       # equal windows have equal keys
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + n].astype(np.uint64) + np.uint64(1)
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = np.empty(n, bool)
    same[:-1] = key[order[1:]] == key[order[:-1]]
    same[-1] = False
    dup = same.copy()
    dup[1:] |= same[:-1]
    at = order[dup]
    if not len(at):
        return 0
    # windows whose keys meet are compared word by word
    rows = np.lib.stride_tricks.sliding_window_view(ids, width)[at]
    _, inv, cnt = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = at[cnt[inv.ravel()] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def judge(text: bytes, single: bool = False) -> tuple[int, int, int, int, int, int, bool, bool, bytes]:
    """Counts, verdicts and cleaned text of one document; ``single`` judges every
    line by itself (``line_fails``), as the query's SQL does."""
    words = text.split()                         # exactly runs of [^\x20\x09-\x0D]
    n_words = len(words)
    bare = text.translate(None, WHITESPACE)
    word_chars = len(bare) - sum(map(len, _CONT.findall(bare))) if not bare.isascii() else len(bare)
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    n_dup = lost = 0
    keep = []
    lines = text.split(b"\n")
    by_line = [x.split() for x in lines]
    fails = [bool(w) and line_fails(x, w) for x, w in zip(lines, by_line)] if single else failing_lines(lines, by_line)
    for line, lw, failed in zip(lines, by_line, fails):
        if lw:
            if line in seen:
                n_dup += 1
            seen.add(line)
            if failed:
                lost += len(lw)
                continue
        keep.append(line)
    n_repeat = repeated_window_words(words)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    kept = not base_failed and 100 * lost <= MAX_LOST_PERCENT * n_words
    return n_words, word_chars, n_symbols, n_dup, n_repeat, lost, base_failed, kept, b"\n".join(keep)


_CONT = re.compile(rb"[\x80-\xbf]+")             # UTF-8 continuation bytes

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words")
SCHEMA = (", ".join(f"{c} bigint" for c in _COUNTS) + ", base_failed boolean, kept boolean")


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts, ``base_failed``, ``kept`` and ``clean_text``
    (the text without its failing lines)."""
    names = ("doc_id", *_COUNTS, "base_failed", "kept", "clean_text")

    def run(b: pa.RecordBatch) -> dict:
        rows = [judge(t, single=True) for t in texts_as_bytes(b.column(1))]
        cols = list(zip(*rows))
        return {"doc_id": b.column(0)} | {n: list(c) for n, c in zip(names[1:-1], cols)} | {
            "clean_text": pa.array([x.decode() for x in cols[-1]], pa.string())}

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(spread(d), run, f"doc_id bigint, {SCHEMA}, clean_text string")


def filter_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Pipeline form: the kept documents with their failing lines removed, all
    other columns untouched (``n_chars``, if there, follows the new text)."""
    names = docs.columns

    def run(b: pa.RecordBatch) -> dict:
        rows = [judge(t) for t in texts_as_bytes(b.column(names.index(text_col)))]
        mask = pa.array([r[7] for r in rows], pa.bool_())
        out = {n: b.column(i).filter(mask) for i, n in enumerate(names)}
        out[text_col] = pa.array([r[8].decode() for r in rows if r[7]], pa.string())
        return out

    out = map_batches(spread(docs), run, docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
