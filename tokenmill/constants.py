"""Fixed values that must equal the reference behaviour for equal results.

Everything in this module is a fixed value (token lists, character
classes, patterns, id layout); logic lives elsewhere.
"""

# --- fixed values: special tokens of the byte-level tokenizer, ids 0..18, in order
SPECIAL_TOKENS_19 = [
    "<|endoftext|>", "<fim_prefix>", "<fim_middle>", "<fim_suffix>",
    "<fim_pad>", "<filename>", "<gh_stars>", "<issue_start>",
    "<issue_comment>", "<issue_closed>", "<jupyter_start>",
    "<jupyter_text>", "<jupyter_code>", "<jupyter_output>",
    "<empty_output>", "<commit_before>", "<commit_msg>",
    "<commit_after>", "<reponame>",
]

# --- fixed values: special tokens of the lossless-split variant, ids 0..24, in order
SPECIAL_TOKENS_25 = [
    "<unk>", "<s>", "</s>", "<pad>", "<|im_start|>", "<|im_end|>",
] + SPECIAL_TOKENS_19

# --- fixed value: the special that stands for bytes without an id
UNKNOWN = "<unk>"

# --- fixed values: chat markers
CHAT_START = "<|im_start|>"
CHAT_END = "<|im_end|>"

# --- fixed values: id layout. byte b has id BYTE_OFFSET + b; merges start after the bytes
BYTE_OFFSET = len(SPECIAL_TOKENS_19)          # 19
FIRST_MERGE_ID = BYTE_OFFSET + 256            # 275

# --- fixed values: printable bytes that keep their own code point in the
# byte <-> printable-character bijection ('!'..'~', U+00A1..U+00AC, U+00AE..U+00FF);
# the other 68 bytes map, in byte order, to U+0100, U+0101, ...
PRINTABLE_BYTE_RANGES = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]

# --- fixed values: character classes (Java regex syntax)
# W: what a Unicode-aware "\s" matches (one literal space inside).
WS_CLASS = r"\x{09}-\x{0d} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# S: what str.strip() removes: W plus U+001C..U+001F.
STRIP_CLASS = WS_CLASS + r"\x{1c}-\x{1f}"
# the characters of S themselves
STRIP_CHARS = ("\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
               + "\u2028\u2029\u202f\u205f\u3000" + "\x1c\x1d\x1e\x1f")
CONTROL_CLASS = r"\x{00}-\x{1f}\x{7f}-\x{9f}"
# control characters that are not whitespace (CONTROL_CLASS minus WS_CLASS)
CONTROL_NOT_WS_CLASS = r"\x{00}-\x{08}\x{0e}-\x{1f}\x{7f}-\x{84}\x{86}-\x{9f}"

# --- fixed values: pre-tokenizer patterns
CONTRACTIONS = r"(?iu:'s|'t|'re|'ve|'m|'ll|'d)"
# The first characters of all parts but contractions and marks differ, so the
# frequent parts are tried first; contractions still come before marks.
PRETOKEN_PATTERN = (r"\p{L}+|[" + WS_CLASS + r"]+|\p{N}+|" + CONTRACTIONS
                    + r"|[^" + WS_CLASS + r"\p{L}\p{N}]+")
LOSSLESS_PATTERN = (
    CONTRACTIONS
    + r"|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}"
    + r"| ?[^" + WS_CLASS + r"\p{L}\p{N}]+[\r\n]*"
    + r"|[" + WS_CLASS + r"]*[\r\n]+"
    + r"|[" + WS_CLASS + r"]+(?![^" + WS_CLASS + r"])"
    + r"|[" + WS_CLASS + r"]+"
)

# --- fixed values: filters of the dataset trainer
MIN_RAW_CHARS = 100
MIN_CLEAN_CHARS = 50
RATIO_DIGITS = 3
RMS_EPS = 1e-6
ROPE_THETA = 10000.0
