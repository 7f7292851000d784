"""DuckDB SQL fragments used by the oracle queries.

DuckDB's RE2 has ASCII ``\\s`` without ``\\v``, so the Unicode whitespace
class is spelled out; after cleaning only plain spaces remain, so the
split pattern can use ``\\s``.
"""

# --- fixed values: RE2 spelling of the whitespace and control classes
RE2_WS = r"[\s\v\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
RE2_CTRL = r"[\x{00}-\x{1f}\x{7f}-\x{9f}]"
RE2_PRETOKEN = r"(?i:''s|''t|''re|''ve|''m|''ll|''d)|\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+"


def clean(expr: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(coalesce({expr}, ''), '{RE2_WS}+', ' ', 'g'), "
            f"'{RE2_CTRL}', ' ', 'g'))")


def digits(expr: str) -> str:
    return f"regexp_replace({expr}, '(\\p{{Nd}})', ' \\1 ', 'g')"


def pretokens(expr: str) -> str:
    """List of pre-tokens of a raw text column."""
    return f"regexp_extract_all({digits(clean(expr))}, '{RE2_PRETOKEN}')"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{RE2_WS}+|{RE2_WS}+$', '', 'g')"


def title_of(doc_id: str = "doc_id", source: str = "source") -> str:
    """Derived title used by the compose queries: source for even ids."""
    return f"(case when {doc_id} % 2 = 0 then {source} else '' end)"


def compose(title: str, text: str) -> str:
    t, x = strip(f"coalesce({title}, '')"), strip(f"coalesce({text}, '')")
    return f"(case when {t} <> '' then {t} || chr(10) || chr(10) || {x} else {x} end)"


def byte_ids(expr: str, offset: int = 19) -> str:
    """List of offset + byte over the UTF-8 bytes of a string."""
    return (f"list_transform(regexp_extract_all(hex(encode({expr})), '..'), "
            f"lambda x: {offset} + ('0x' || x)::int)")


# T7 without look-ahead: a run of white space before other text ends one
# character earlier, so a mark (a noncharacter) is put before the last
# character of every such run without line ends; the mark belongs to no class
# below and so ends the run, and is in no piece.
_WS = RE2_WS[1:-1]
_BLANK = _WS.replace(r"\s", r"\t\f ")
_MARK = r"\x{fdd0}"
RE2_LOSSLESS = (r"(?i:''s|''t|''re|''ve|''m|''ll|''d)"
                rf"|[^\r\n\p{{L}}\p{{N}}{_MARK}]?\p{{L}}+|\p{{N}}{{1,3}}"
                rf"| ?[^{_WS}\p{{L}}\p{{N}}{_MARK}]+[\r\n]*"
                rf"|[{_WS}]*[\r\n]+|[{_WS}]+")


def lossless(expr: str) -> str:
    """List of T7 pieces of a raw text column."""
    marked = (f"regexp_replace(coalesce({expr}, ''), '([{_BLANK}]+)([{_BLANK}][^{_WS}])', "
              f"'\\1' || chr(64976) || '\\2', 'g')")
    return f"regexp_extract_all({marked}, '{RE2_LOSSLESS}')"


TRAINING_DOCS = (
    "select doc_id, text from documents "
    f"where length({strip('coalesce(text, %s)' % repr(''))}) >= 100 "
    f"and length({clean('text')}) >= 50"
)
