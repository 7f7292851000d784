import random
from collections import defaultdict

from llm_odd import ODD, documents, random_text, rows  # noqa: F401
from pyspark.sql import functions as F

from tokenmill.llm import bbit_minhash as mh
from tokenmill.llm import line_windows as lw
from tokenmill.llm import suffix_dedup as sd

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def near_texts(seed=3):
    rng = random.Random(seed)
    texts = list(ODD)
    for _ in range(12):
        base = prose(rng, rng.randint(30, 200)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(1, 8)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 12))):
                t[rng.randrange(len(t))] = rng.choice(WORDS)
            texts.append((" " if rng.random() < 0.5 else "\n").join(t).upper() if rng.random() < 0.2 else " ".join(t))
    chain = prose(rng, 60).split()               # a chain of links whose ends are not linked
    for i in range(0, 40, 2):
        chain[i] = rng.choice(WORDS)
        texts.append(" ".join(chain))
    return texts + ["a b c d e", "a b c d e f", "A b  c\nd e"] * 2


def brute_sets(text, width):
    w = (text or "").encode().translate(mh._LOWER).split()
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))}


def brute_components(texts, width):
    sets = [brute_sets(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(sets[i]), find(i)) for i in range(len(texts))]


def test_near_duplicates_equal_brute_force(spark, documents):
    texts = near_texts()
    for width in (2, 5):
        want = brute_components(texts, width)
        got = {r["doc_id"]: r for r in mh.near_duplicates(documents(texts), width).collect()}
        assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == want
        assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)


def test_near_duplicates_odd_tables(spark, documents):
    t = "one two three four five six seven"
    docs = documents([(1, t), (1, t), (None, t), (2, t.upper()), (3, None), (3, "")])
    got = sorted(map(tuple, mh.near_duplicates(docs, 2).collect()), key=str)
    assert got == sorted([(1, 6, 1, True), (1, 6, 1, True), (None, 6, None, True), (2, 6, 1, False),
                          (3, 0, 3, True), (3, 0, 3, True)], key=str)
    kept = mh.drop_near_duplicates(docs, 2)
    assert kept.columns == docs.columns and sorted(rows(kept, "doc_id"), key=str) == sorted(
        [(1,), (1,), (None,), (3,), (3,)], key=str)
    assert mh.near_duplicates(docs.limit(0), 2).collect() == []


def test_second_round_links_what_stars_miss(spark):
    """Two clusters in the same buckets: every member is compared with the other cluster."""
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (8, 5), (20, 21), (7, 7)], "a bigint, b bigint")
    assert dict(rows(mh.components(edges), "node", "root")) == {4: 3, 5: 3, 8: 3, 9: 3, 21: 20}
    assert mh.components(edges.limit(0)).collect() == []


def test_estimate_follows_similarity(spark):
    rng = random.Random(2)
    a = [rng.getrandbits(60) for _ in range(1000)]
    import numpy as np
    one = np.unique(np.array(a, np.uint64))
    for common in (500, 800, 950):
        two = np.unique(np.array(a[:common] + [rng.getrandbits(60) for _ in range(1000 - common)], np.uint64))
        true = common / (2000 - common)
        s = mh.pack_bits(mh.minima([one, two]))
        df = spark.createDataFrame([(s[0].tolist(), s[1].tolist())], "x array<bigint>, y array<bigint>")
        got = df.select(mh.estimate(F.col("x"), F.col("y"))).first()[0]
        assert abs(got - true) < 0.15


def brute_lines(docs):
    seen, out = set(), {}
    for d, t in docs:
        lines = (t or "").encode().split(b"\n")
        at = [i for i, x in enumerate(lines) if x.strip()]
        bare = [lines[i].strip() for i in at]
        gone = set()
        for i in range(len(bare) - 2):
            w = tuple(bare[i:i + 3])
            if w in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(w)
        out[d] = (len(at), len(gone), b"\n".join(x for i, x in enumerate(lines) if i not in {at[j] for j in gone}))
    return out


def test_line_windows_equal_brute_force(spark, documents):
    rng = random.Random(4)
    pool = [f"line {i} ends." for i in range(12)]
    texts = ODD + ["\n".join(rng.choice(pool) + rng.choice(["", " ", "\r"]) + rng.choice(["", "\n "])
                             for _ in range(rng.randint(0, 15))) for _ in range(60)]
    want = brute_lines(list(enumerate(texts)))
    docs = documents(texts)
    for r in lw.dedup_lines(docs).collect():
        assert (r["n_lines"], r["n_removed"], r["clean_text"].encode()) == want[r["doc_id"]]
    out = lw.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: (r["text"] or "").encode() for r in out.collect()} == {d: w[2] for d, w in want.items()}
    assert lw.dedup_lines(docs.limit(0)).collect() == []
    t = "a.\nb.\nc."
    same = documents([(4, t), (4, t), (None, t), (9, t)])
    assert sorted(rows(lw.dedup_lines(same), "doc_id", "n_removed"), key=str) == sorted(
        [(4, 0), (4, 0), (None, 0), (9, 3)], key=str)


def brute_repeats(docs, length, keep):
    starts = defaultdict(list)
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            starts[b[i:i + length]].append((d, i))
    cover = {d: set() for d, _ in docs}
    for at in starts.values():
        if len(at) > 1:
            for d, i in at if keep == "none" else sorted(at)[1:]:
                cover[d].update(range(i, i + length))
    return cover


def repeat_texts(seed, length):
    rng = random.Random(seed)
    shared = [prose(rng, rng.randint(5, 60)) for _ in range(6)]
    texts = list(ODD)
    for _ in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.4 else prose(rng, rng.randint(0, 40)) for _ in range(rng.randint(1, 5))]
        texts.append(" ".join(parts))
    texts += [texts[-1], texts[-2], texts[-3][3:], "é" * 600, "ab" * 500, "ab" * 300 + "x" + "ab" * 250]
    return texts


def test_repeats_equal_brute_force(spark, documents, monkeypatch):
    for seed, length, group in ((1, 100, 200), (2, 130, 2), (3, 400, 200)):
        monkeypatch.setattr(sd, "GROUP", group)
        texts = repeat_texts(seed, length)
        for keep in ("none", "first"):
            want = brute_repeats(list(enumerate(texts)), length, keep)
            got = {r["doc_id"]: r for r in sd.remove_repeats(documents(texts), length, keep).collect()}
            for i, t in enumerate(texts):
                b = (t or "").encode()
                have = {j for s in got[i]["spans"] for j in range(s["f"], s["t"])}
                assert have == want[i], (seed, keep, i)
                assert bytes(got[i]["kept"]) == bytes(c for j, c in enumerate(b) if j not in want[i])
                assert got[i]["n_bytes"] == len(b)


def test_repeats_long_text_and_odd_tables(spark, documents, monkeypatch):
    monkeypatch.setattr(sd, "SLICE", 3000)
    rng = random.Random(9)
    part = prose(rng, 120)
    texts = [prose(rng, 3000) + " " + part + " " + prose(rng, 2000), prose(rng, 100) + part, "short"]
    want = brute_repeats(list(enumerate(texts)), 400, "none")
    got = {r["doc_id"]: r for r in sd.remove_repeats(documents(texts), 400, "none").collect()}
    for i in range(3):
        assert {j for s in got[i]["spans"] for j in range(s["f"], s["t"])} == want[i]
    docs = documents([(1, part), (1, part), (None, part), (2, part)])
    assert sorted((r["doc_id"], len(r["kept"])) for r in sd.remove_repeats(docs.filter("doc_id is not null"), 400).collect()) \
        == [(1, len(part)), (1, len(part)), (2, 0)]
    out = sd.drop_repeats(docs, 400)
    assert out.columns == docs.columns and out.count() == 4
    assert sd.remove_repeats(docs.limit(0), 400).collect() == []


def test_longest_previous_factor_equals_definition():
    import numpy as np
    rng = random.Random(12)
    for _ in range(30):
        n, alphabet = rng.randint(1, 120), rng.choice(["a", "ab", "abc"])
        text = "".join(rng.choice(alphabet) for _ in range(n)).encode()
        shared = lambda i, j: next((k for k in range(n) if max(i, j) + k == n or text[i + k] != text[j + k]), n)
        order = sorted(range(n), key=lambda i: text[i:])
        common = np.array([0] + [shared(a, b) for a, b in zip(order, order[1:])])
        got = np.empty(n, np.int64)
        got[order] = sd.longest_previous_factor(np.array(order), common)
        assert got.tolist() == [max([0, *(shared(i, j) for j in range(i))]) for i in range(n)]
        later = np.empty(n, np.int64)
        later[order] = sd.longest_previous_factor(-np.array(order), common)
        assert later.tolist() == [max([0, *(shared(i, j) for j in range(i + 1, n))]) for i in range(n)]


def family(rng, n_words, changes):
    """Variants of one text; each changes its own share of the words."""
    base = [rng.choice(WORDS) for _ in range(n_words)]
    out = []
    for share in changes:
        t = list(base)
        for k in rng.sample(range(n_words), int(share * n_words)):
            t[k] = f"own{rng.random()}"
        out.append(" ".join(t))
    return out


def test_later_rounds_find_what_stars_miss(spark, documents, monkeypatch):
    """All texts in one bucket: its star around the smallest id finds next to nothing, so the
    links are left to the second and the third round."""
    import numpy as np
    monkeypatch.setattr(mh, "band_keys", lambda m: np.full((len(m), 1), 4, np.int64))   # partner: id 6
    rng = random.Random(10)
    # near variants link to the smallest id, others only to those, and another family not at all
    texts = family(rng, 200, [0.04] + [0.005] * 8 + [0.04] * 6) + family(rng, 90, [0.02] * 4 + [0.12] * 6)
    shared = texts[0].split()[:110]
    texts += [" ".join(shared + [f"x{i}" for i in range(k)]) for k in (2, 12, 22, 24, 26, 60)]
    calls = []
    confirm = mh.confirm
    monkeypatch.setattr(mh, "confirm", lambda *a: calls.append(1) or confirm(*a))
    got = {r["doc_id"]: r for r in mh.near_duplicates(documents(texts), 2).collect()}
    want = brute_components(texts, 2)
    assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == want
    assert len(calls) == 3                                 # stars, fresh partners, all that is left


def odd_columns(spark, texts):
    """Legal columns that are unlike those of ``documents``."""
    import datetime
    from decimal import Decimal
    schema = ("doc_id bigint, text string, `my col` string, price decimal(10,2), before string, _before int, spans string, "
              "_spans array<int>, id int, _id int, gone string, day date, more struct<`a b`: int, c: array<string>>, n_chars int")
    rows = [(i, t, "x", Decimal("1.25"), "b", 1, "s", [1], 2, 3, "g", datetime.date(2024, 1, 2), (1, ["y"]), 0)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def test_stages_take_any_columns(spark):
    import corpus_pipeline
    rng = random.Random(3)
    prose = [" ".join(prose_line(rng) for _ in range(6)) for _ in range(6)]
    docs = odd_columns(spark, [*prose, prose[0], prose[1] + " Something more stands here.", None, ""])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.dtypes == docs.dtypes, name
        got = {r["doc_id"]: r for r in out.collect()}
        assert got and all(r["my col"] == "x" and str(r["price"]) == "1.25" and r["more"]["a b"] == 1 and r["_spans"] == [1]
                           and r["gone"] == "g" for r in got.values()), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 10


def prose_line(rng):
    return " ".join(rng.choice(WORDS) for _ in range(12)).capitalize() + "."
