import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest

from llm_odd import ODD, documents, random_text, rows  # noqa: F401
from tokenmill.llm import best_fit, byte_bpe, quality_rules, url_rules


@pytest.fixture(scope="module")
def reference_bpe():
    import tiktoken
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = byte_bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_library(spark, documents, reference_bpe):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    texts = ODD + [random_text(s) for s in range(60)]
    docs = documents(texts)
    enc = byte_bpe.encode_documents(docs, path, P.PATTERN)
    got = {r["doc_id"]: r for r in byte_bpe.decode_documents(enc, path, P.PATTERN).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert list(got[i]["ids"]) == reference_bpe.encode_ordinary(t or ""), repr(t)[:80]
        assert bytes(got[i]["decoded"]) == (t or "").encode()


def test_byte_bpe_backtracking_equals_merging():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        codec = byte_bpe.ByteBpe(f.read(), P.PATTERN)
    rng = random.Random(1)
    tokens = list(codec.ranks)
    for _ in range(3000):
        s = "".join(rng.choice(tokens) for _ in range(rng.randint(1, 5)))
        if rng.random() < 0.3:
            s = "".join(rng.choice("abetin \xc3\xa9\x80") for _ in range(rng.randint(1, 30)))
        assert list(codec.encode_piece(s)) == ([codec.ranks[s]] if s in codec.ranks else codec.merge_by_rank(s))


def test_cut_at_spaces_joins_back():
    for t in [x or "" for x in ODD] + [random_text(s) for s in range(50)]:
        assert "".join(byte_bpe.cut_at_spaces(t)) == t


def brute_quality(text):
    words = [w for w in __import__("re").findall("[^\x20\x09-\x0d]+", text or "")]
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    c = Counter(wins)
    cov = {i + j for i, w in enumerate(wins) if c[w] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if __import__("re").search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text or ""), dup, len(cov),
            len(words) < 20 or 100 * len(cov) > 30 * len(words))


def test_quality_counts(spark, documents):
    texts = ODD + [random_text(s) for s in range(80)]
    got = {r["doc_id"]: r for r in quality_rules.quality_report(documents(texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == brute_quality(t), repr(t)[:80]


def test_quality_lines(spark, documents):
    prose = "The committee met again in spring and talked about the old bridge over the river."
    nav = "Home | About | Contact | Help | Terms"
    texts = [f"{prose} One.\nNobody had asked them to do so, which made it all the more surprising to hear.\n{nav}\n"
                 "Accept our cookie policy now.", nav * 20,
             "\n".join(["only words without any closing mark at all"] * 5 + [prose])]
    docs = documents(texts)
    rep = {r["doc_id"]: r for r in quality_rules.quality_report(docs).collect()}
    assert rep[0]["kept"] and "Home" not in rep[0]["clean_text"] and "cookie" not in rep[0]["clean_text"]
    assert not rep[1]["kept"] and not rep[2]["kept"]
    out = quality_rules.filter_quality(docs)
    assert out.columns == docs.columns
    assert rows(out, "doc_id") == [(0,)] and out.first()["n_chars"] == len(rep[0]["clean_text"])
    empty = docs.limit(0)
    assert quality_rules.filter_quality(empty).collect() == [] and quality_rules.quality_report(empty).collect() == []


def test_clean_long_and_wrapped_documents_stay(spark, documents):
    import textwrap
    rng = random.Random(4)
    vocab = [f"word{i}" for i in range(900)] + ["Haus", "Brücke", "London"]
    prose = [" ".join(rng.choice(vocab) for _ in range(rng.randint(6, 14))).capitalize() + "." for _ in range(200)]
    read = "Those who want to read more about the old bridge have a blog in to which all of it is written down."
    one_line = " ".join([*prose[:100], read, *prose[100:]])
    cut_off = one_line[:-9]
    wrapped = "\n\n".join(textwrap.fill(" ".join(prose[i:i + 8]), 72) for i in range(0, 200, 8))
    spread_more = "They spread more news of the river, and his blog in to the night told all of it to the town. " + prose[0]
    menu = "\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(4, 12))) for _ in range(30))
    wall = textwrap.fill(" ".join(rng.choice(vocab) for _ in range(200)), 72)
    junk = "Read more: click here!\nAll rights reserved."
    texts = [one_line, cut_off, wrapped, spread_more, menu, wall, prose[1] + prose[2] + "\n" + junk + "\n" + prose[3]]
    got = {r["doc_id"]: r["text"] for r in quality_rules.filter_quality(documents(texts)).collect()}
    assert [got.get(i) == texts[i] for i in range(4)] == [True] * 4
    assert 4 not in got and 5 not in got
    assert "rights" not in got.get(6, "") and "click" not in got.get(6, "")


def test_packing(spark, documents):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    texts = ODD + [random_text(s) for s in range(60)] + ["same text here."] * 40
    docs = documents(texts)
    out = best_fit.pack_documents(docs, P.path("word_bpe_49k.json"), capacity=64).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        got = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["start"] for r in got] == list(range(0, len(ids), 64))
        joined = b"".join(bytes(r["ids"]) for r in got)
        assert joined == b"".join(v.to_bytes(4, "little") for v in ids), repr(x)[:60]
        assert all(r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and r["length"] * 4 == len(r["ids"]) for r in got)
    for places in by_seq.values():
        at = 0
        for off, n in sorted(places):
            assert off == at
            at += n
        assert at <= 64
    total = sum(r["length"] for r in out)
    assert len(by_seq) <= 1.02 * total / 64 + 1
    assert best_fit.pack_documents(docs.limit(0), P.path("word_bpe_49k.json")).collect() == []


def test_special_strings_are_special_tokens(spark, documents):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = ["a <|endoftext|> b", "<|startoftext|>", "Hello<|endoftext|>World.", "<|endoftext|><|startoftext|>!! x",
             "it's<|ENDOFTEXT|>", "x\n<|endoftext|>\n\ty", "<|endoftext|", "é<|startoftext|>e\u0301 <|endoftext|>\u2003z"]
    got = {r["doc_id"]: bytes(r["ids"]) for r in best_fit.pack_documents(documents(texts), P.path("word_bpe_49k.json")).collect()}
    assert t.encode(texts[0], add_special_tokens=False).ids == [320, 49407, 321]
    for i, x in enumerate(texts):
        ids = t.encode(x, add_special_tokens=False).ids + [1]
        assert got[i] == b"".join(v.to_bytes(4, "little") for v in ids), x


def test_rare_words_are_forgotten_and_frequent_ones_stay():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    table = best_fit.WordIds(t, remember=60)
    made, make = Counter(), table.cores.make
    table.cores.make = lambda low: made.update([low]) or make(low)
    rng = random.Random(12)
    often = ["The", "river,", "and", "its", "Old", "Bridge.", "1844", "caf\u00e9s"]
    for _ in range(60):
        words = often + ["".join(rng.choices("abcdefghij", k=9)) + rng.choice(["", ",", "!?", "7"]) for _ in range(25)]
        rng.shuffle(words)
        want = t.encode(" ".join(words), add_special_tokens=False).ids
        assert table.ids([w.encode() for w in words]) == b"".join(i.to_bytes(4, "little") for i in want)
        for cache in (table.words, table.cores, table.others):
            assert len(cache) <= 60 and len(cache.before) <= 60
    assert len(made) > 500
    assert {made[w] for w in ("the", "river", "and", "its", "old", "bridge", "caf\u00e9s")} == {1}


def test_plan_uses_exact_complements():
    plan = best_fit.plan_packing({60: 2, 40: 1, 20: 2, 50: 2, 33: 1, 34: 1, 30: 1, 3: 1}, 100)
    assert sum(m for _, m in plan.groups) == 4
    assert all(sum(g) == 100 for g, _ in plan.groups[:3])
    rng = random.Random(5)
    for _ in range(30):
        h = Counter(rng.randint(1, 99) for _ in range(300))
        p = best_fit.plan_packing(dict(h), 100)
        used = Counter()
        for g, m in p.groups:
            assert sum(g) <= 100
            for n in g:
                used[n] += m
        assert used == h
        alone = best_fit.Plan()
        best_fit._best_fit(sorted(h.items(), reverse=True), alone, 100)
        sequences = sum(m for _, m in p.groups)
        assert sequences <= sum(m for _, m in alone.groups)
        assert sequences <= 1.015 * least_sequences(h, 100) + 1


def least_sequences(h, capacity):
    """A lower bound of any packing. The tokens alone do not give one that can be
    reached: pieces over half of the capacity need a sequence each, and those of
    such a sequence's room that shorter pieces cannot use is lost."""
    best = -(-sum(k * v for k, v in h.items()) // capacity)
    for short in range(capacity // 2 + 1):
        alone = sum(v for k, v in h.items() if k > capacity - short)
        half = {k: v for k, v in h.items() if capacity / 2 < k <= capacity - short}
        room = sum((capacity - k) * v for k, v in half.items())
        rest = sum(k * v for k, v in h.items() if short <= k <= capacity / 2)
        best = max(best, alone + sum(half.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def one_by_one(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - n)
    return sorted(gaps)


def test_best_fit_fills_gaps_again():
    plan = best_fit.plan_packing({3000: 1000, 100: 5000}, 4096)
    assert sum(m for _, m in plan.groups) == 1000
    rng = random.Random(6)
    for _ in range(200):
        h = {rng.randint(1, 99): rng.randint(1, 60) for _ in range(rng.randint(1, 6))}
        plan = best_fit.Plan()
        best_fit._best_fit(sorted(h.items(), reverse=True), plan, 100)
        used = Counter()
        for g, m in plan.groups:
            for n in g:
                used[n] += m
        assert used == h
        assert sorted(100 - sum(g) for g, m in plan.groups for _ in range(m)) == one_by_one(Counter(h).elements(), 100)


def test_urls(spark):
    urls = ["http://Example.COM/en/1", "https://www.example.com/en/2", "http://x.www.example.com/en/", "http://a.net/es/x?q",
            "http://net/fr/", "http://notnet/fr/", "http://com", "http://a.com#x", None, "", "no scheme", "http://b.org/a",
            "http://b.org/free-bets/x", "http://cheap-pills.org", "http://b.org/en?u=http://example.com/en/", "a://b://c.com/"]
    df = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)], "page_id bigint, url string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge_urls(df).collect()}
    assert got[0] == ("example.com", "/en/1", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/2", "www.example.com/en/", "allow")
    assert got[2][2:] == ("www.example.com/en/", "allow")
    assert got[3] == ("a.net", "/es/x", "net/es/", "block")
    assert got[4][2:] == ("net/fr/", "block") and got[5][2] is None
    assert got[6][:3] == ("com", "", None) and got[7][:3] == ("a.com", "", None)
    assert got[8] == got[9] == got[10] == ("", "", None, "allow")
    assert got[11][2:] == (None, "allow") and got[12][2:] == (None, "block") and got[13][2:] == (None, "block")
    assert got[14] == ("b.org", "/en", None, "allow") and got[15][0] == "b:"
    assert url_rules.judge_urls(df.limit(0)).collect() == []
