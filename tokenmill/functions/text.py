"""Column functions for text: compose, clean, split, byte symbols.

All of them are built-in Spark expressions (regexp_replace,
regexp_extract_all, translate, ...), so they stay inside whole-stage
codegen and run on streaming DataFrames too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill.constants import (
    BYTE_OFFSET, CONTROL_CLASS, CONTROL_NOT_WS_CLASS, LOSSLESS_PATTERN, PRETOKEN_PATTERN,
    PRINTABLE_BYTE_RANGES, STRIP_CHARS, STRIP_CLASS, WS_CLASS,
)

# Token id i is stored inside Spark strings as the code point SYM_BASE + i, one
# supplementary character per id (Spark's string functions and Java's regular
# expressions step over code points). The layout ends with Unicode itself,
# above a million ids.
SYM_BASE = 0x10000
MAX_SYMBOL_ID = 0x10FFFF - SYM_BASE
# Marks the end of a word when pairs are listed (below SYM_BASE, never an id).
END_MARK = "\uffff"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sym(token_id: int) -> str:
    """The one-character symbol of a token id."""
    if not 0 <= token_id <= MAX_SYMBOL_ID:
        raise ValueError(f"token id {token_id} outside the supported range 0..{MAX_SYMBOL_ID}")
    return chr(SYM_BASE + token_id)


def sym_id(ch: str) -> int:
    return ord(ch) - SYM_BASE


_LATIN256 = "".join(chr(b) for b in range(256))


def byte_to_printable_map() -> dict[int, str]:
    """Byte -> printable character bijection used by the tokenizer files.

    Bytes inside PRINTABLE_BYTE_RANGES keep their own code point; the
    rest are numbered upward from U+0100 in byte order.
    """
    keep = {b for lo, hi in PRINTABLE_BYTE_RANGES for b in range(lo, hi + 1)}
    out, nxt = {}, 0x100
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(nxt)
            nxt += 1
    return out


_PRINTABLE256 = "".join(byte_to_printable_map()[b] for b in range(256))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: drop leading/trailing Unicode whitespace and U+001C..U+001F."""
    return F.btrim(col_of(c), F.lit(STRIP_CHARS))


def compose_document(title, text) -> Column:
    """``title + "\\n\\n" + text`` when the stripped title is non-empty, else the stripped text."""
    t = strip_ws(F.coalesce(col_of(title), F.lit("")))
    x = strip_ws(F.coalesce(col_of(text), F.lit("")))
    return F.when(t != "", F.concat(t, F.lit("\n\n"), x)).otherwise(x)


# One pass does line-end normalisation, per-line strip + join, whitespace
# collapse and control blanking: a whitespace/strip run that contains a line
# break, a plain whitespace run, or a single non-whitespace control
# character each become one space. Controls therefore never merge with
# neighbouring spaces ("a \0 b" keeps three), exactly as when they are
# blanked after the collapse. Every strip character is a space afterwards,
# so the final strip is a plain trim. A run is looked at once, from its start
# (the look-behind), so the pass is linear also in long runs. Letters, printable
# ASCII and a plain space before one of them stay as they are: the two tests in front
# pass over them (the replacement of such a space would be itself).
CLEAN_PATTERN = (r"(?=[^!-~\p{L}])(?! [!-~\p{L}])"
                 f"(?:(?<![{STRIP_CLASS}])(?=[{STRIP_CLASS}]*[\r\n])[{STRIP_CLASS}]+|[{WS_CLASS}]+"
                 f"|[{CONTROL_NOT_WS_CLASS}])")


def clean_text(c) -> Column:
    """Normalise line ends, strip every line, join by a space, collapse
    whitespace runs, blank out control characters, strip.

    Controls are replaced after the collapse (so ``"a \\0 b"`` keeps three
    spaces) — the function is intentionally not idempotent.
    """
    x = F.coalesce(col_of(c), F.lit(""))
    return F.trim(F.regexp_replace(x, F.lit(CLEAN_PATTERN), F.lit(" ")))


def clean_text_stepwise(c) -> Column:
    """T3 spelled out step by step (same result as :func:`clean_text`; kept for tests)."""
    x = F.coalesce(col_of(c), F.lit(""))
    x = F.regexp_replace(x, F.lit("\r\n|\r"), F.lit("\n"))
    x = F.regexp_replace(x, F.lit(f"[{STRIP_CLASS}]*\n[{STRIP_CLASS}]*"), F.lit(" "))
    x = F.regexp_replace(x, F.lit(f"[{WS_CLASS}]+"), F.lit(" "))
    x = F.regexp_replace(x, F.lit(f"[{CONTROL_CLASS}]"), F.lit(" "))
    return strip_ws(x)


def isolate_digits(c) -> Column:
    """T5: every Unicode decimal digit d becomes ``" d "``."""
    return F.regexp_replace(col_of(c), F.lit(r"(\p{Nd})"), F.lit(" $1 "))


def pre_tokenize(c, clean: bool = True) -> Column:
    """Clean (T3), isolate digits (T5), then list all pre-token matches.

    Whitespace runs are tokens of their own. Returns ``ARRAY<STRING>``.
    """
    x = clean_text(c) if clean else F.coalesce(col_of(c), F.lit(""))
    return F.regexp_extract_all(isolate_digits(x), F.lit(PRETOKEN_PATTERN), F.lit(0))


# Ends a pre-token where a whole text is one string; a text's own is written as 1 and 2.
TOKEN_MARK = "\x00"


def marked_tokens(c, clean: bool = True) -> Column:
    """T6 as one string, with ``TOKEN_MARK`` after every pre-token: no array of small strings
    is built. The cleaning removes control characters; a text that is not cleaned here has the
    mark and U+0001 written as two control characters, which end no pre-token
    (:func:`unmarked` undoes it)."""
    x = clean_text(c) if clean else F.replace(
        F.replace(F.coalesce(col_of(c), F.lit("")), F.lit("\x01"), F.lit("\x01\x03")), F.lit(TOKEN_MARK), F.lit("\x01\x02"))
    return F.regexp_replace(isolate_digits(x), F.lit(PRETOKEN_PATTERN), F.lit("$0" + TOKEN_MARK))


def unmarked(word: str) -> str:
    """A pre-token of :func:`marked_tokens` as it is in the text."""
    return word.replace("\x01\x02", TOKEN_MARK).replace("\x01\x03", "\x01") if "\x01" in word else word


def split_lossless(c) -> Column:
    """Lossless split (no cleaning); ``array_join(result, '')`` equals the input."""
    return F.regexp_extract_all(F.coalesce(col_of(c), F.lit("")), F.lit(LOSSLESS_PATTERN), F.lit(0))


def bytes_as_symbols(word, byte_ids: list[int]) -> Column:
    """A word as a string of symbols, those of ``byte_ids[b]`` for each UTF-8 byte b."""
    latin = F.decode(F.encode(col_of(word), "UTF-8"), "ISO-8859-1")
    return F.translate(latin, _LATIN256, "".join(map(sym, byte_ids)))


def to_byte_symbols(word) -> Column:
    """A word as a string of byte symbols (one character per UTF-8 byte, id 19+b)."""
    return bytes_as_symbols(word, [BYTE_OFFSET + b for b in range(256)])


def symbols_to_ids(syms) -> Column:
    """Symbol string -> ``ARRAY<INT>`` of token ids (an empty pattern splits at every character)."""
    chars = F.filter(F.split(col_of(syms), ""), lambda ch: ch != "")       # an empty string gives one empty part
    return F.transform(chars, lambda ch: F.ascii(ch) - F.lit(SYM_BASE))


def word_ids(word) -> Column:
    """T8 as ids: ``ARRAY<INT>`` of ``19 + byte`` for the UTF-8 bytes of ``word``."""
    return symbols_to_ids(to_byte_symbols(word))


def bytes_to_printable(b) -> Column:
    """S5 applied to a BINARY column: the printable-character form of the bytes."""
    return F.translate(F.decode(col_of(b), "ISO-8859-1"), _LATIN256, _PRINTABLE256)


def printable_to_bytes(s) -> Column:
    """Inverse of :func:`bytes_to_printable` for strings made of the 256 printable characters.
    (``translate`` deletes what maps to U+0000, so byte 0 is put in by itself.)"""
    rest = F.translate(col_of(s), _PRINTABLE256[1:], _LATIN256[1:])
    return F.encode(F.replace(rest, F.lit(_PRINTABLE256[0]), F.lit("\0")), "ISO-8859-1")


def is_printable_form(s) -> Column:
    """True when every character of ``s`` belongs to the byte bijection."""
    return F.length(F.translate(col_of(s), _PRINTABLE256, "")) == 0


def utf8_lenient(b) -> Column:
    """Decode BINARY as UTF-8 replacing bad sequences with U+FFFD."""
    return F.make_valid_utf8(col_of(b).cast("string"))


# Characters that Python's repr() writes as escapes, by Java's character
# categories: separators other than the space, and Other (control, format,
# surrogate, private use, unassigned).
_NOT_PRINTABLE = r"[\p{Z}\p{C}&&[^ ]]"


def token_repr(b) -> Column:
    """Display form of token bytes, Python's ``repr`` of the lenient UTF-8
    text without its quotes: backslash, newline, return and tab as two-character
    escapes, other non-printable characters as ``\\x..``, ``\\u....`` or
    ``\\U........``, and the single quote escaped if both quotes occur."""
    s = utf8_lenient(b)
    both = F.contains(s, F.lit("'")) & F.contains(s, F.lit('"'))

    def escape(ch):
        code = F.ascii(ch)
        hexed = F.lower(F.hex(code))
        return (F.when(ch == "\\", F.lit("\\\\")).when(ch == "\n", F.lit("\\n")).when(ch == "\r", F.lit("\\r"))
                .when(ch == "\t", F.lit("\\t")).when((ch == "'") & both, F.lit("\\'"))
                .when(~ch.rlike(_NOT_PRINTABLE), ch)
                .when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(hexed, 2, "0")))
                .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(hexed, 4, "0")))
                .otherwise(F.concat(F.lit("\\U"), F.lpad(hexed, 8, "0"))))

    return F.array_join(F.transform(F.regexp_extract_all(s, F.lit("(?s)(.)"), F.lit(1)), escape), "")


def pair_repr(left_bytes, right_bytes) -> Column:
    """``(l , r)`` display form of a pair."""
    return F.concat(F.lit("("), token_repr(left_bytes), F.lit(" , "), token_repr(right_bytes), F.lit(")"))
