import random
import re
import textwrap
from collections import defaultdict

import public_tokenizers as P
from llm_odd import ODD, documents, random_text  # noqa: F401
from test_duplicates import brute_components, brute_lines, brute_repeats

import corpus_pipeline
from test_codec_rules import brute_quality


def sentences(rng, n):
    vocab = [f"word{i}" for i in range(500)]
    out = []
    for _ in range(n):
        out.append(" ".join(rng.choice(vocab) for _ in range(rng.randint(5, 12))).capitalize() + ".")
    return out


def corpus():
    rng = random.Random(8)
    shared = sentences(rng, 9)
    # one-line passages between the stage's length and that of the ninth operator
    passages = [" ".join(sentences(rng, n)) for n in (4, 5, 6)]
    assert all(corpus_pipeline.PASSAGE_BYTES < len(p) < 400 for p in passages)
    texts = list(ODD)
    for k in range(25):
        s = sentences(rng, rng.randint(2, 20))
        if rng.random() < 0.4:
            at = rng.randrange(len(s))
            s[at:at] = shared
        if rng.random() < 0.4:
            s.insert(rng.randrange(len(s)), rng.choice(passages))
        if rng.random() < 0.3:
            s.insert(0, "Home | About | Help | Contact")
        if rng.random() < 0.3:
            s += [rng.choice(["Read more: click here!", "wow!! such!! deals!!", "a line of words that never ends",
                              "Those who want to read more about it will find all of it in the old book."])]
        texts.append(rng.choice(["\n", " "]).join(s))
        if k % 6 == 0:
            texts.append(textwrap.fill(" ".join(s), 72))
        if rng.random() < 0.4:
            words = texts[-1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        if rng.random() < 0.2:
            texts.append(texts[-1])
    return texts + [random_text(s) for s in range(20)]


SEPS, CLOSING = set("|»›•>"), ".!?…:;\"'”’»)]}"
PHRASES = ("cookie policy|privacy policy|terms of use|terms of service|all rights reserved|enable javascript|lorem ipsum|"
           "click here|read more|sign up for|log in to|share this|subscribe to our")


def plain_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w]


def plain_quality(text):
    """The first stage from its rules: the text without failing lines, or None."""
    lines = text.split("\n")
    words = [plain_words(x) for x in lines]
    fails = []
    for line, w in zip(lines, words):
        seps = sum(x in SEPS for x in w)
        noise = sum(bool(re.search(r"!!|[%*#$&]{3}", x)) for x in w)
        phrases = sum(len(p.split()) for p in re.findall(rf"\b(?:{PHRASES})\b", line.lower()))
        fails.append(bool(w) and (seps >= 2 and 5 * seps >= len(w) or 3 * noise > len(w) or phrases > 0 and 4 * phrases >= len(w)))
    groups, block = [], []
    for i, w in enumerate([*words, []]):             # blocks between lines without words
        if w:
            block.append(i)
            continue
        width = max([len(lines[k].strip()) for k in block], default=0)
        for k in block:
            goes_on = (groups and groups[-1][-1] == k - 1 and k - 1 in block and 40 <= width <= 120
                       and words[k - 1][-1][-1] not in CLOSING and len(lines[k - 1].strip()) + 1 + len(words[k][0]) > width)
            if goes_on:
                groups[-1].append(k)
            else:
                groups.append([k])
        block = []
    for g in groups:
        w = [x for k in g for x in words[k]]
        if len(w) >= 4 and w[-1][-1] not in CLOSING:
            ends = [i + 1 for i, x in enumerate(w) if re.search(r"[.!?…][\"'”’»)\]}]?$", x)]
            if 2 * (len(w) - max(ends, default=0)) > len(w):
                for k in g:
                    fails[k] = True
    n, *_, base_failed = brute_quality(text)
    lost = sum(len(w) for w, f in zip(words, fails) if f)
    if base_failed or 2 * lost > n:
        return None
    return "\n".join(x for x, f in zip(lines, fails) if not f)


def brute(texts):
    docs = [(i, q) for i, t in enumerate(texts) if (q := plain_quality(t or "")) is not None]
    lines = brute_lines(docs)
    docs = [(i, lines[i][2].decode()) for i, _ in docs]
    roots = brute_components([t for _, t in docs], 5)
    docs = [d for k, d in enumerate(docs) if roots[k][1] == k]
    gone = brute_repeats(docs, corpus_pipeline.PASSAGE_BYTES, "first")
    assert any(gone.values())
    return {i: bytes(c for j, c in enumerate(t.encode()) if j not in gone[i]).decode(errors="ignore") for i, t in docs}


def test_pipeline_equals_brute_force(spark, documents, tmp_path):
    from tokenizers import Tokenizer
    texts = corpus()
    documents(texts).drop("kept").write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute(texts)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(want) and len(want) < len(texts)
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for i, text in want.items():
        ids = t.encode(text, add_special_tokens=False).ids + [1]
        got = b"".join(bytes(r["ids"]) for r in sorted(by_doc[i], key=lambda r: r["piece"]))
        assert got == b"".join(x.to_bytes(4, "little") for x in ids), i
    for places in by_seq.values():
        at = 0
        for off, n in sorted(places):
            assert off == at
            at += n
        assert at <= 4096


def test_stages_keep_the_columns(spark, documents):
    docs = documents(ODD + ["Some clean prose that is long enough to stay in the table, with words enough to pass "
                            "the rule of twenty words that every document must have."])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), "").collect() == []
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").collect() == []


def test_passages_of_51_words_go(spark, documents):
    rng = random.Random(3)
    vocab = ["over", "bridge", "river", "spring", "garden", "after", "winter", "stone", "market", "house"]
    passage = " ".join(rng.choice(vocab) for _ in range(51)) + "."
    assert 200 < len(passage) < 400
    short = " ".join(rng.choice(["the", "over", "bees", "and", "old", "mills"]) for _ in range(51)) + "."
    assert 225 <= len(short) < 250
    texts = []
    for i in range(6):
        own = sentences(rng, 12) + [short] * (i > 3)
        texts.append("\n".join([*own[:6], passage, *own[6:]]))
    stage = dict(corpus_pipeline.STAGES)["repeated_passages"]
    got = {r["doc_id"]: r["text"] for r in stage(spark, documents(texts), "").collect()}
    assert [passage in got[i] for i in range(6)] == [True] + [False] * 5
    for i in range(1, 6):
        assert passage[:40] not in got[i] and (short in got[i]) == (i == 4) and len(got[i]) >= len(texts[i]) - len(passage) - len(short) * (i == 5) - 32
