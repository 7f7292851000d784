import math
import random

import numpy as np
from pyspark.sql import functions as F

from llm_odd import rows
from tokenmill.llm import hard_negatives as hn


def vectors(seed, n, dims=6, labels=4, clusters=10):
    """Clusters, single vectors, copies, and vectors of very different lengths."""
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(clusters)]
    out = []
    for i in range(n):
        kind = rng.random()
        v = [x + rng.gauss(0, 0.1) for x in rng.choice(middles)] if kind < 0.6 else [rng.gauss(0, 1) for _ in range(dims)]
        if kind > 0.9 and out:
            v = list(rng.choice(out)[2])
        if 0.5 < kind < 0.55:
            v = [x * 20 for x in v]
        out.append((i, rng.randrange(labels), v))
    return out


def brute(data, is_anchor, positives=5, negatives=5):
    usable = {}
    for i, label, v in data:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        got = (label, [math.floor(256 * x) for x in v])
        usable[i] = min(usable.get(i, got), got)
    out = []
    for a, (label, v) in usable.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in usable.items() if i != a)
        for p, i, m in [x for x in scored if x[2] == label][:positives]:
            p = -p
            inside = [(-s, j) for s, j, m in scored if m != label and 80 * p <= -100 * s <= 100 * p]
            out += [(a, i, r, j, p, s) for r, (s, j) in enumerate(inside[:negatives], 1)]
    return sorted(out)


SCHEMA = "vec_id bigint, label int, embedding array<double>, score string, `rank of` decimal(10,2)"


def mined(spark, data, step, **sizes):
    df = spark.createDataFrame([(*x, "s", None) for x in data], SCHEMA)
    out = hn.hard_negatives(hn.labelled_vectors(df, 256), F.col("vec_id") % step == 0)
    return sorted(rows(out, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def test_equal_brute_force(spark, monkeypatch):
    for seed, nodes, anchors in ((1, 2048, 1024), (2, 60, 7)):
        monkeypatch.setattr(hn, "NODES", nodes)
        monkeypatch.setattr(hn, "ANCHORS", anchors)
        data = vectors(seed, 300)
        want = brute(data, lambda a: a % 9 == 0)
        assert len(want) > 100
        assert mined(spark, data, 9) == want


def test_odd_rows(spark):
    v = [1.0, 0.5]
    data = [(0, 1, v), (1, 1, v), (2, 2, v), (3, 2, [1.0, 0.4]), (4, None, v), (None, 1, v), (5, 2, None), (6, 2, [1.0, None]),
            (7, 2, [1.0, float("nan")]), (8, 2, [float("inf"), 0.0]), (9, 2, [0.0, 0.0]), (2, 2, v), (2, 2, [9.0, 9.0]),
            (10, 3, []), (11, 3, [-1.0, -1.0]), (12, 1, [-1.0, -1.0]), (13, 4, v)]
    padded = [(i, m, v and (v + [0.0, 0.0])[:2] if v is not None else None) for i, m, v in data]
    assert mined(spark, data, 1) == brute(padded, lambda a: True)
    assert mined(spark, [], 1) == []
    assert mined(spark, [(0, 1, v), (1, 2, v)], 1) == []           # no positive, no row
    same = [(i, i % 2, v) for i in range(40)]                      # ties everywhere
    assert mined(spark, same, 10) == brute(same, lambda a: a % 10 == 0)
    zero = [(i, i % 2, [0.0, 0.0]) for i in range(12)]
    assert mined(spark, zero, 5) == brute(zero, lambda a: a % 5 == 0)


def test_covering_radii_hold():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(150, 5)) * 200, rng.normal(size=(5, 5)).repeat(20, axis=0) * 100]).round()
    parent, cover, norm = hn.build_tree(x)
    assert (parent == -1).sum() == 1
    full = np.concatenate([x, np.sqrt(np.maximum(norm ** 2 - (x * x).sum(axis=1), 0))[:, None]], axis=1) / norm
    assert np.allclose((full ** 2).sum(axis=1), 1)
    for i in range(len(x)):
        at = i
        while parent[at] >= 0:
            at = parent[at]
            assert np.arccos(np.clip(full[i] @ full[at], -1, 1)) <= cover[at] + hn.SLACK


def test_search_skips_nodes():
    """In clustered vectors most products are never taken, and the result is still whole."""
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(60, 32)) * 300
    x = (middles.repeat(30, axis=0) + rng.normal(size=(1800, 32)) * 4).round()
    parent, cover, norm = hn.build_tree(x)
    labels = np.arange(1800) % 3
    tree = hn.CoverTree(np.arange(1800), labels, x, parent, cover, norm)
    q = np.arange(0, 1800, 100)
    low, high = np.full((len(q), 1), -np.inf), np.full((len(q), 1), np.inf)
    who, _, ids, score = tree.search(q, labels[q], x[q], low, high, 5, True)
    assert tree.products < 0.35 * len(q) * len(x)
    for n, i in enumerate(q):
        s = x @ x[i]
        s[(labels != labels[i]) | (np.arange(1800) == i)] = -np.inf
        assert sorted(score[who == n]) == sorted(np.sort(s)[-5:])
