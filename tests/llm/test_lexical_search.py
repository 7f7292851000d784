import math
import random
import re
from collections import Counter

import numpy as np

from llm_odd import ODD, documents, rows  # noqa: F401
from tokenmill.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    own = [(d, Counter(terms(t))) for d, t in docs]
    n = sum(bool(c) for _, c in own)
    total = sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in sorted({(i, t or "") for i, t in items if i is not None}):
        found = []
        for d, c in own:
            size = sum(c.values())
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 100 - 50 + (50 * size * n) // total
                    score += w * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
            if score and d is not None:
                found.append((-score, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def corpus(seed, n):
    """Zipf-like words, so that some are in nearly every text."""
    rng = random.Random(seed)
    vocab = [f"Word{i}" for i in range(400)] + ["é", "日本", "x1"]
    weight = [1 / (i + 1) for i in range(len(vocab))]
    texts = [rng.choice([" ", ", ", "-"]).join(rng.choices(vocab, weight, k=rng.randint(1, 120))) for _ in range(n)]
    items = [(i, " ".join(rng.choices(vocab, weight, k=rng.randint(1, 25)))) for i in range(25)]
    return texts, items


def ranked(spark, documents, texts, items, k):
    found = ls.rank_documents(documents(texts), spark.createDataFrame(
        [(i, t, "d", 1) for i, t in items], "item_id bigint, text string, doc_id string, score int"), k)
    return sorted(rows(found, "item_id", "rank", "doc_id", "score"))


def test_equal_brute_force(spark, documents, monkeypatch):
    texts, items = corpus(1, 400)
    texts = ODD + texts + texts[:30]
    items += [(100, "don't İstanbul 12345 WORD"), (101, ""), (102, None), (103, "unknownterm"), (None, "word0"),
              (104, "word0 word1"), (104, "word2"), (104, "word2")]
    want = brute(list(enumerate(texts)), items, 10)
    for block, item_bytes in ((8192, 8 << 20), (37, 900)):
        monkeypatch.setattr(ls, "BLOCK", block)
        monkeypatch.setattr(ls, "ITEM_BYTES", item_bytes)
        assert ranked(spark, documents, texts, items, 10) == want


def test_odd_tables(spark, documents):
    docs = [(3, "river bank"), (3, "river bank"), (None, "river"), (1, "bank " * 50_000), (7, None), (8, "!!"), (9, "other")]
    items = [(1, "River bank"), (2, "other")]
    assert ranked(spark, documents, docs, items, 50) == brute(docs, items, 50)
    assert ranked(spark, documents, [], items, 50) == []
    assert ranked(spark, documents, docs, [], 50) == []


def test_search_skips_and_pairs_bind():
    """Pair bounds are true bounds, tighter than single maxima, and save look-ups."""
    texts, items = corpus(2, 3000)
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in items for w in ls.terms_of(t.encode())}))}
    own = [Counter(vocabulary[w] for w in ls.terms_of(t.encode()) if w in vocabulary) for t in texts]
    n = np.array([len(ls.terms_of(t.encode())) for t in texts])
    df = np.zeros(len(vocabulary), np.int64)
    for c in own:
        df[list(c)] += 1
    weights = ls.term_weights(len(texts), df)
    plans, pairs = ls.item_plans([(i, ls.terms_of(t.encode())) for i, t in items], vocabulary, weights)
    corpus_ = ls.SimpleNamespace(documents=len(texts), terms=int(n.sum()), weights=weights, plans=plans, pairs=pairs)
    flat = [np.array(x) for x in zip(*((t, c) for d in own for t, c in sorted(d.items())))]
    index = ls.BlockIndex(corpus_, np.arange(len(texts)), n, np.array([len(c) for c in own]), *flat)
    tighter = postings = 0
    for _, plan in plans:
        bound = index.bounds(plan)
        for j in range(len(plan) + 1):
            score = np.zeros(len(texts), np.int64)
            for t in plan[:j]:
                docs, impacts = index.postings(t)
                score[docs] += impacts
            assert score.max(initial=0) <= bound[j] <= sum(index.highest[t] for t in plan[:j])
            tighter += bound[j] < sum(index.highest[t] for t in plan[:j])
        ids, total = index.search(plan, 10, 0)
        best = np.lexsort((np.arange(len(texts)), -score))[:10]
        got = np.lexsort((ids, -total))[:10]
        assert ids[got].tolist() == best[score[best] > 0].tolist()
        assert total[got].tolist() == score[best][score[best] > 0].tolist()
        index.search(plan, 10, int(score[best[-1]]))
        postings += 2 * sum(len(index.postings(t)[0]) for t in plan)
    assert tighter > 50 and index.looked_up < 0.7 * postings
