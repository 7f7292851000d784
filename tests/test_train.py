import random

from bruteforce import train_exact, train_indexed, train_stale_drop
from pyspark.sql import functions as F

from tokenmill.operators.stats import pair_freq, top_pairs
from tokenmill.operators.train import BpeModel, apply_merges, train_bpe
from tokenmill.functions.text import sym, symbols_to_ids


def words_df(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint")


def as_ids(counts):
    return {tuple(19 + b for b in w.encode()): n for w, n in counts.items()}


def test_pair_overlap(spark):
    p = pair_freq(words_df(spark, {"aaa": 1}))
    assert [(r["left"], r["right"], r["freq"]) for r in p.collect()] == [(19 + 97, 19 + 97, 2)]
    a = 19 + 97
    df = spark.createDataFrame([(sym(a) * 3,)], "s string")
    out = df.select(symbols_to_ids(apply_merges(F.col("s"), [(a, a, 300)])).alias("x")).first()["x"]
    assert out == [300, a]


def test_ties_take_smaller_pair(spark):
    p = pair_freq(words_df(spark, {"ab": 3, "cd": 3}))
    best = top_pairs(p, 1).first()
    assert (best["left"], best["right"]) == (19 + 97, 19 + 98)
    m = train_bpe(words_df(spark, {"ab": 3, "cd": 3}), 277)
    assert [x[:2] for x in m.merges] == [(19 + 97, 19 + 98), (19 + 99, 19 + 100)]


def test_stop_rule(spark):
    m = train_bpe(words_df(spark, {"ab": 1, "cd": 1}), 300)
    assert m.merges == []


def random_corpus(rnd, n_words, alphabet="abcde", max_len=7):
    out = {}
    for _ in range(n_words):
        w = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, max_len)))
        out[w] = out.get(w, 0) + rnd.randint(1, 9)
    return out


def test_exact_training_equals_one_at_a_time(spark):
    rnd = random.Random(11)
    for trial in range(6):
        corpus = random_corpus(rnd, 40 + 20 * trial, "abcdefg"[: 3 + trial % 4])
        want, _ = train_exact(as_ids(corpus), 25)
        got = train_bpe(words_df(spark, corpus), 275 + 25, batch=8, checkpoint_every=3)
        assert got.merges == want, trial


def test_stale_drop_equals_lazy_heap(spark):
    rnd = random.Random(5)
    for trial in range(3):
        corpus = random_corpus(rnd, 50, "abcd")
        want = train_stale_drop(as_ids(corpus), 12)
        got = train_bpe(words_df(spark, corpus), 275 + 12, selection="stale_drop", checkpoint_every=4)
        assert got.merges == want, trial


def test_extend_vocabulary(spark):
    rnd = random.Random(9)
    a, b = random_corpus(rnd, 40), random_corpus(rnd, 40, "cdefg")
    first = train_bpe(words_df(spark, a), 275 + 5)
    more = train_bpe(words_df(spark, b), 275 + 10, base_model=first)
    assert more.merges[:5] == first.merges
    from bruteforce import merge_word
    ids = as_ids(b)
    for l, r, n, _f, _t in first.merges:
        nxt = {}
        for w, c in ids.items():
            m = merge_word(w, l, r, n)
            nxt[m] = nxt.get(m, 0) + c
        ids = nxt
    want, _ = train_exact(ids, 5, first_id=280)
    assert more.merges[5:] == want


def test_extend_a_vocabulary_of_2000_merges(spark):
    """Earlier merges are not nested expressions, so there may be thousands."""
    base = BpeModel(merges=[(19 + k % 256, 19 + k // 256, 275 + k, 2, 0) for k in range(2000)])
    more = train_bpe(words_df(spark, {"\x00\x00xy": 3, "xyz": 2}), 275 + 2002, base_model=base)
    assert more.merges[:2000] == base.merges
    assert [m[:4] for m in more.merges[2000:]] == [(19 + 120, 19 + 121, 2275, 5), (275, 2275, 2276, 3)]


def test_model_vocab(spark):
    m = BpeModel(merges=[(19 + 97, 19 + 98, 275, 3, 0)])
    v = {r["id"]: (bytes(r["bytes"]), r["kind"]) for r in m.vocab_df(spark).collect()}
    assert v[275] == (b"ab", "merge") and v[0][1] == "special" and v[19] == (b"\x00", "byte")
    assert m.vocab_size == 276


def test_few_runs_give_the_same_merges(spark):
    """Whatever number of active pairs and runs a round may take, down to one pair."""
    rnd = random.Random(21)
    corpus = random_corpus(rnd, 120, "abcd", 9) | {"a" * k: 2 for k in range(1, 9)}
    want, _ = train_exact(as_ids(corpus), 40)
    for batch, limit, n in ((1, 1, 6), (8, 12, 20), (1000, 100_000, 40)):
        got = train_bpe(words_df(spark, corpus), 275 + n, batch=batch, run_limit=limit)
        assert got.merges == want[:n], (batch, limit)


def test_two_thousand_merges_of_the_documents(spark):
    from tokenmill.operators.stats import word_freq
    words = word_freq(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).persist()
    got = train_bpe(words, 275 + 2000)
    want = train_indexed(as_ids({r["word"]: r["n"] for r in words.collect()}), 2000)
    assert got.merges == want and got.rounds < 20
    words.unpersist()


def brute_stream(texts, n_merges):
    from collections import Counter

    from bruteforce import merge_word
    from test_text import py_clean, py_pretok
    streams = [[19 + b for b in "".join(py_pretok(py_clean(t))).encode()] for t in texts]
    want = []
    for k in range(n_merges):
        c, first = Counter(), {}
        for d, s in enumerate(streams):
            for i in range(len(s) - 1):
                p = (s[i], s[i + 1])
                c[p] += 1
                first.setdefault(p, (d, i))
        if not c:
            break
        p, f = min(c.items(), key=lambda kv: (-kv[1], first[kv[0]]))
        if f < 2:
            break
        streams = [list(merge_word(tuple(s), p[0], p[1], 275 + k)) for s in streams]
        want.append((p[0], p[1], 275 + k, f, sum(len(s) for s in streams)))
    return want


def test_stream_training_first_seen(spark):
    from tokenmill.operators.train_stream import train_bpe_stream
    rnd = random.Random(4)
    parts = ["ab", "ba", "abc", "cab", "b a", "aaaa", "bb", "cc", "é"]
    texts = [" ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = brute_stream(texts, 70)
    assert 20 < len(want)
    for active, limit, n in ((1, 1, 6), (8, 9, 20), (32, 30_000, 70)):
        got = train_bpe_stream(df, 275 + n, active=active, run_limit=limit)
        assert got.merges == want[:n], (active, limit)
    assert train_bpe_stream(df.limit(0), 300).merges == []


def test_symbol_arrays_round_trip():
    import numpy as np
    import pyarrow as pa
    from tokenmill.operators import active_runs as ar
    rows = ["", sym(0) + sym(1_048_575), sym(300), "", sym(70_000) * 3, None]
    for part in (slice(None), slice(1, 4), slice(0, 0)):
        column = pa.array(rows)[part]
        ids, at = ar._ids(column)
        assert len(ids) == at[-1]
        assert ar._strings(ids, at).to_pylist() == [r or "" for r in rows[part]]
    ids, at = ar._ids(pa.array(rows))
    assert ar._codes(ids, at).tolist() == [0 << 21 | 1_048_575, -1, -1, 70_000 << 21 | 70_000, 70_000 << 21 | 70_000]
    assert np.diff(at).tolist() == [0, 2, 1, 0, 3, 0]


def test_lossless_flavour_offsets(spark):
    from tokenmill.constants import SPECIAL_TOKENS_25
    corpus = {"hello": 3, " world": 2, "help": 2}
    m = train_bpe(words_df(spark, corpus), 25 + 256 + 4, specials=list(SPECIAL_TOKENS_25))
    ids = {tuple(25 + b for b in w.encode()): n for w, n in corpus.items()}
    want, _ = train_exact(ids, 4, first_id=281)
    assert m.merges == want


def brute_rows(rnd, n, ids, docs):
    return [([rnd.choice(ids) for _ in range(rnd.choice([0, 1, 2, 9, 30]))], rnd.choice([1, 1, 3]), rnd.choice(docs)) for _ in range(n)]


def strings_of(spark, rows):
    return spark.createDataFrame([("".join(map(sym, w)), n, d) for w, n, d in rows], "syms string, n long, doc long").repartition(3)


def packed_of(spark, rows):
    import numpy as np
    from tokenmill.operators.active_runs import pack
    made = [(pack(np.array(w, np.int64), np.array([0, len(w)])).to_pylist()[0], len(w), n, d) for w, n, d in rows]
    return spark.createDataFrame(made, "syms binary, size long, n long, doc long").repartition(3)


def brute_runs(w, active):
    cuts = [0, *[i for i in range(1, len(w)) if (w[i - 1], w[i]) not in active], len(w)]
    return [(a, tuple(w[a:z])) for a, z in zip(cuts, cuts[1:])]


def test_passes_over_strings_against_brute_force(spark):
    """Few ids and many, documents in no order and repeated, weights; with places and without."""
    import numpy as np
    import pyarrow as pa
    from tokenmill.operators import active_runs as ar
    rnd = random.Random(8)
    for ids, docs in (([19, 20, 21], range(200)), ([30, 5000, 1_048_575], range(-5, 9))):
        rows = brute_rows(rnd, 80, ids, docs)
        pairs, runs, active = {}, {}, {(ids[0], ids[1]), (ids[1], ids[1]), (ids[2], ids[0])}
        for w, n, d in rows:
            for i, p in enumerate(zip(w, w[1:])):
                f, at = pairs.get(p, (0, (d, i)))
                pairs[p] = f + n, min(at, (d, i))
            for i, r in brute_runs(w, active):
                if len(r) > 1:
                    f, at = runs.get(r, (0, (d, i)))
                    runs[r] = f + n, min(at, (d, i))
        work = strings_of(spark, rows)
        packed = packed_of(spark, rows)
        for placed, table in ((True, work), (False, work.drop("doc")), (True, packed), (False, packed.drop("doc"))):
            got = {(r["l"], r["r"]): (r["f"], (r["doc"], r["pos"]) if placed else None) for r in ar.pair_counts(table).collect()}
            assert got == {k: (f, at if placed else None) for k, (f, at) in pairs.items()}
            got = {tuple(np.frombuffer(r["run"], "<u4").tolist()): (r["n"], (r["doc"], r["pos"]) if placed else None)
                   for r in ar.distinct_runs(table, list(active)).collect()}
            assert got == {k: (f, at if placed else None) for k, (f, at) in runs.items()}
        short = {r: (77,) * rnd.randint(1, len(r) - 1) for r in list(runs)[::2]}
        merged = {np.array(k, "<u4").tobytes(): np.array(v, "<u4").tobytes() for k, v in short.items()}
        want = sorted(("".join(sym(i) for _, r in brute_runs(w, active) for i in short.get(r, r) if w), n, d) for w, n, d in rows)
        assert sorted(tuple(r) for r in ar.rewrite_runs(work, list(active), merged).collect()) == want
        after = ar.rewrite_runs(packed, list(active), merged).collect()
        assert sorted(("".join(map(sym, ar.unpack(pa.array([r["syms"]], pa.binary()), np.array([r["size"]]))[0])), r["n"], r["doc"])
                      for r in after) == want


def test_runs_of_a_task_are_summed_before_they_are_passed_on(spark):
    """Not once per Arrow batch."""
    from tokenmill.operators import active_runs as ar
    from tokenmill.session import session_conf
    rows = spark.range(9000).select(F.lit((sym(19) + sym(20) + sym(99)) * 3).alias("syms"), F.lit(1).cast("long").alias("n"), F.col("id").alias("doc"))
    with session_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        runs = ar.distinct_runs(rows.coalesce(1), [(19, 20)])
        assert [(r["n"], r["doc"], r["pos"]) for r in runs.collect()] == [(27_000, 0, 0)]
        node = runs._jdf.queryExecution().executedPlan()
        while "MapInArrow" not in node.nodeName():
            node = node.children().apply(0)
        assert node.metrics().apply("pythonNumRowsReceived").value() == 1


def test_stream_symbols_are_the_joined_pre_tokens(spark):
    from test_text import py_clean, py_pretok
    from tokenmill.operators.train_stream import stream_symbols
    texts = ["don't  x12\r\n\x00y\x01", "", None, " \t ", "h\u00e9 \U0001f600!'s"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    import numpy as np
    import pyarrow as pa
    from tokenmill.operators.active_runs import unpack
    got = {r["doc_id"]: unpack(pa.array([r["syms"]], pa.binary()), np.array([r["size"]]))[0].tolist() for r in stream_symbols(df).collect()}
    assert got == {i: [19 + b for b in "".join(py_pretok(py_clean(t or ""))).encode()] for i, t in enumerate(texts)}


def test_streams_are_checkpointed_packed(spark):
    """Less than the text's own size, where a symbol string has four bytes for each of its bytes."""
    import os

    from tokenmill.operators.train_stream import train_bpe_stream
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(3000)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")

    def files():
        return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names}
    before = files()
    model = train_bpe_stream(df, 275 + 3, active=1)         # more rounds than one
    assert len(model.merges) == 3 and model.rounds > 1
    assert 0 < sum(n for f, n in files().items() if f not in before) < 2 * sum(map(len, texts))
