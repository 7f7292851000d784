import math
import random

import numpy as np
from pyspark.sql import functions as F

from tokenmill.functions.vectors import rms_normalize, rotary, softmax
from tokenmill.operators.vectors import causal_history, softmax_over


def test_rotary_position_zero_unchanged(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], 0)], "v array<double>, p int")
    assert df.select(rotary("v", F.col("p")).alias("o")).first()["o"] == [1.0, 2.0, 3.0, 4.0]


def test_rotary_formula(spark):
    v = [0.5, -1.0, 2.0, 0.25]
    df = spark.createDataFrame([(v, 3)], "v array<double>, p int")
    got = df.select(rotary("v", F.col("p")).alias("o")).first()["o"]
    d, half = 4, 2
    f = [10000 ** (-2 * (i % half) / d) for i in range(d)]
    rot = [-v[2], -v[3], v[0], v[1]]
    want = [v[i] * math.cos(3 * f[i]) + rot[i] * math.sin(3 * f[i]) for i in range(d)]
    assert np.allclose(got, want)


def test_rms_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0, 0.0],)], "v array<double>")
    assert df.select(rms_normalize("v").alias("o")).first()["o"] == [0.0, 0.0, 0.0]


def test_softmax(spark):
    df = spark.createDataFrame([([1000.0, 1000.0],)], "v array<double>")
    assert df.select(softmax("v").alias("o")).first()["o"] == [0.5, 0.5]
    g = spark.createDataFrame([(1, 0.0), (1, math.log(3.0)), (2, 5.0)], "k int, s double")
    w = {(r["k"], round(r["s"], 3)): r["weight"] for r in softmax_over(g, ["k"], "s").collect()}
    assert math.isclose(w[(1, 0.0)], 0.25) and math.isclose(w[(2, 5.0)], 1.0)


def test_causal_history_matches_numpy(spark):
    rnd = random.Random(2)
    rows = []
    for e, n in [(1, 1), (2, 5), (3, 23)]:
        for t in range(n):
            rows.append((e, t * 3, [rnd.uniform(-1, 1) for _ in range(6)]))
    df = spark.createDataFrame(rows, "e int, t int, v array<double>")
    for back in (None, 1, 6):
        got = {(r["e"], r["t"]): r["out"] for r in causal_history(df, "e", "t", "v", block=4, look_back=back).collect()}
        assert len(got) == len(rows)
        for e in (1, 2, 3):
            seq = sorted((t, v) for ee, t, v in rows if ee == e)
            x = np.array([v for _, v in seq])
            for i, (t, _) in enumerate(seq):
                lo = 0 if back is None else max(0, i + 1 - back)
                s = x[lo: i + 1] @ x[i] / math.sqrt(6)
                w = np.exp(s - s.max())
                assert np.allclose(got[(e, t)], (w / w.sum()) @ x[lo: i + 1])


def test_hot_tokens_are_looked_up_apart(spark):
    from tokenmill.operators.vectors import embed_tokens, frequent_ids
    rng = random.Random(2)
    table = spark.createDataFrame([(i, [float(i), -float(i)]) for i in range(2000)], "token_id int, vec array<float>")
    docs = [(d, [7 if rng.random() < 0.35 else rng.randrange(2100) for _ in range(400)] + [None]) for d in range(50)]
    tokens = spark.createDataFrame(docs, "doc_id long, ids array<int>")
    got = embed_tokens(tokens, table, broadcast_bytes=0)
    want = sorted((d, p, i, [float(i), -float(i)] if i is not None and i < 2000 else None)
                  for d, ids in docs for p, i in enumerate(ids))
    assert sorted(((r["doc_id"], r["pos"], r["token_id"], r["vec"]) for r in got.collect()), key=str) == sorted(want, key=str)
    pos = tokens.select("doc_id", F.posexplode("ids").alias("pos", "token_id"))
    assert frequent_ids(pos) == [7]
    spread = pos.filter("token_id <> 7").repartition(8, "token_id").groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in spread)
    assert sizes[-1] < 1.5 * sizes[len(sizes) // 2]
    even = spark.createDataFrame([(0, list(range(2000)))], "doc_id long, ids array<int>")
    assert frequent_ids(even.select("doc_id", F.posexplode("ids").alias("pos", "token_id"))) == []
    assert embed_tokens(even, table, broadcast_bytes=0).count() == 2000
