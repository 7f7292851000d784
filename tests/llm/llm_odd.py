"""Odd and random texts for the tests of this folder."""
import random

import pytest

ODD = [None, "", " ", "\n\n", "a", "a b", "Ünï cödé 😀 text\u2003here\x1f.", "don't  stop\r\n\tnow 's 12345 ½",
       "x" * 5000, "word " * 3000, "line one is here.\n" * 50, "tail space ", " lead", "a\n b \n c", "!!??..  ,,",
       "日本語のテキスト\nです。", "İstanbul ΟΔΟΣ ß ﬁ K e\u0301 \u00a0x \x1c y\x85z"]


def random_text(seed: int) -> str:
    rng = random.Random(seed)
    kind = rng.random()
    if kind < 0.4:
        vocab = ["the", "of", "Bridge", "river.", "it's", "é", "über", "42", "a-b", "x,", "!!", "|"]
        return rng.choice(["", " "]).join("") + "".join(
            rng.choice(vocab) + rng.choice([" ", " ", " ", "  ", "\n", "\t", " \n "]) for _ in range(rng.randint(0, 200)))
    alphabet = "ab e\n  \t.,'s1é😀\u3000\x85\x1cΣ́"
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400)))


@pytest.fixture
def documents(spark):
    """Documents with extra columns whose names clash with results; a text is
    given alone (its place is the id) or as ``(doc_id, text)``."""
    def make(texts):
        data = [(*(t if isinstance(t, tuple) else (i, t)), "en", "s", 0, "x") for i, t in enumerate(texts)]
        return spark.createDataFrame(
            data, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string")
    return make


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
