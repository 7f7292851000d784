import random

import xxhash
from pyspark.sql import functions as F

from llm_odd import ODD, documents, rows  # noqa: F401
from tokenmill.llm import simhash_pivots as sp

WORDS = [f"w{i}" for i in range(300)]


def brute_fingerprint(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(prints):
    """Smallest id reachable over links of at most two bits; prints: [(id, fingerprint)]."""
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x, a in prints:
        for y, b in prints:
            if x < y and (a ^ b).bit_count() <= 2:
                p, q = sorted((find(x), find(y)))
                root[q] = p
    return {i: find(i) for i in root}


def alike_texts(seed=1):
    rng = random.Random(seed)
    texts = list(ODD)
    for _ in range(8):
        base = [rng.choice(WORDS) for _ in range(rng.randint(200, 700))]
        for _ in range(rng.randint(1, 8)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(WORDS)
            texts.append(" ".join(t).upper() if rng.random() < 0.2 else " ".join(t))
    return texts + texts[-3:] + [None, "  "]


def test_near_duplicates_equal_brute_force(spark, documents):
    texts = alike_texts()
    prints = [(i, brute_fingerprint(t)) for i, t in enumerate(texts)]
    want = brute_roots(prints)
    got = {r["doc_id"]: r for r in sp.near_duplicates(documents(texts)).collect()}
    assert len(got) == len(texts)
    for i, f in prints:
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{f:016x}", want[i]), i
        assert got[i]["kept"] == (want[i] == i)
    assert len(set(want.values())) < len({f for _, f in prints})      # some link between different fingerprints


def flipped(rng, f, n):
    for b in rng.sample(range(64), n):
        f ^= 1 << b
    return f


def test_links_of_random_fingerprints(spark, monkeypatch):
    """Pairs at 0-4 bits, chains and balls, with and without crowds."""
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    for f in list(prints)[:60]:
        for n in (1, 2, 2, 3, 4):
            prints.add(flipped(rng, f, n))
    ball = rng.getrandbits(64)
    prints |= {ball ^ (rng.getrandbits(8) << 20) for _ in range(150)}
    numbered = list(enumerate(rng.sample(sorted(prints), len(prints))))
    want = brute_roots(numbered)
    groups = spark.createDataFrame([(i, sp._signed(f)) for i, f in numbered], "rep bigint, fp bigint")
    true = {(min(x, y), max(x, y)) for x, a in numbered for y, b in numbered if x < y and (a ^ b).bit_count() <= 2}
    for crowd in (256, 20, 1):
        monkeypatch.setattr(sp, "CROWD", crowd)
        edges = {tuple(sorted(e)) for e in rows(sp.links(groups), "a", "b")}
        assert edges <= true
        if crowd == 256:
            assert edges == true
        roots = dict(rows(sp.components(spark.createDataFrame(list(edges), "a bigint, b bigint")), "node", "root"))
        assert {i: roots.get(i, i) for i, _ in numbered} == want, crowd


def test_coordinates_bound_distances(spark):
    """Every coordinate moves by at most the distance, and a range's only by its own bits."""
    rng = random.Random(3)
    data = []
    for i in range(300):
        f = rng.getrandbits(64)
        data.append((i, sp._signed(f), sp._signed(flipped(rng, f, 2))))
    df = spark.createDataFrame(data, "rep bigint, fp bigint, other bigint")
    one = sp.pivot_table(df.select("rep", "fp")).collect()
    two = sp.pivot_table(df.select("rep", F.col("other").alias("fp"))).collect()
    for x, y in zip(sorted(one), sorted(two)):
        assert max(abs(p - q) for p, q in zip(x["far"], y["far"])) <= 2
        assert sum(p != q for p, q in zip(x["local"], y["local"])) <= 2
        moved = [(x["fp"] ^ y["fp"]) >> (16 * r) & 0xFFFF for r in range(4)]
        assert [p != q for p, q in zip(x["local"], y["local"])] == [m != 0 for m in moved]


def test_odd_tables(spark, documents):
    t = " ".join(WORDS)
    docs = documents([(5, t), (5, t), (None, t), (2, t.upper()), (7, None), (9, ""), (9, "other words here now")])
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in sp.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 2, False), (5, 2, False), (None, None, True), (2, 2, True), (7, 7, True), (9, 7, False),
                          (9, 7, False)], key=str)
    assert sp.near_duplicates(docs.limit(0)).collect() == []


def test_very_long_text(monkeypatch):
    rng = random.Random(8)
    text = " ".join(rng.choice(WORDS) for _ in range(40_000))
    assert sp.fingerprint(text.encode()) == brute_fingerprint(text)
    monkeypatch.setattr(sp, "SLICE", 7)
    short = text[:2000]
    assert sp.fingerprint(short.encode()) == brute_fingerprint(short)
