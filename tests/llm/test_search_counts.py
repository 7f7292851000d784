import random

import numpy as np
import public_tokenizers as P
import pytest
from llm_odd import ODD, documents, random_text, rows  # noqa: F401

from tokenmill.llm import exact_topk, license_scan, token_counts


def brute_topk(vecs, k):
    out = []
    for q in sorted(vecs):
        if q % 20 == 0:
            s = sorted(((-sum(a * b for a, b in zip(vecs[q], v)), i) for i, v in vecs.items() if i != q))[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return out


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "VECTORS", 64)
    monkeypatch.setattr(exact_topk, "QUERIES", 8)
    monkeypatch.setattr(exact_topk, "ENOUGH", 2)
    rng = np.random.default_rng(1)
    vecs = {i: rng.normal(0, 0.1 if i % 3 else 2.0, 16).tolist() for i in range(300)}
    for i in range(100, 180):
        vecs[i] = vecs[100]                        # ties
    vecs[40] = [0.0] * 16
    data = [(i, v, 1) for i, v in vecs.items()] + [(400, None, 0), (None, vecs[1], 0), (420, [1.0, None] * 8, 0),
                                                   (440, [float("nan")] * 16, 0), (460, [float("inf")] * 16, 0)]
    data.append((20, vecs[20], 5))                # repeated row
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, score int")
    v = exact_topk.integer_vectors(df)
    got = sorted(rows(exact_topk.top_k(v, v.filter("vec_id % 20 = 0"), 7), "query_id", "rank", "vec_id", "score"))
    want = brute_topk({i: [int(np.floor(64 * x)) for x in v] for i, v in vecs.items()}, 7)
    assert got == sorted(want)
    few = v.filter("vec_id in (0, 1, 2)")
    assert len(exact_topk.top_k(few, few.filter("vec_id = 0"), 7).collect()) == 2
    none = v.filter("vec_id < 0")
    assert exact_topk.top_k(none, none, 7).collect() == []


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, rule):
    import tiktoken
    from tokenmill.llm.byte_bpe import read_ranks
    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    texts = ODD + [random_text(s) for s in range(40)]
    data = [(i, t, rng, "src0" if i % 4 else None, "y") for i, (t, rng) in enumerate(zip(texts, ["en", "é", None] * 40))]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, section string")
    got = {(r["doc_id"], r["section"]): r for r in token_counts.section_token_counts(df, path, P.PATTERN, rule).collect()}
    for i, t, lang, source, _ in data:
        text, sections = token_counts.compose(source, lang, t)
        want = dict.fromkeys([n for n, _, _ in sections] + ["between"], 0)
        spans = byte_spans(text)
        at = 0
        for tok in enc.encode_ordinary(text):
            n = len(enc.decode_single_token_bytes(tok))
            cs = spans[at:at + n]
            at += n
            own = [next((s for s, a, b in sections if a <= c < b), "between") for c in sorted(set(cs))]
            if rule == "start":
                want[own[0]] += 1
            elif rule == "end":
                want[own[-1]] += 1
            else:
                best = max((s for s, _, _ in sections), key=lambda s: own.count(s))
                want[best if 2 * own.count(best) >= len(own) and own.count(best) else "between"] += 1
        assert {s: got[i, s]["n_tokens"] for s in want} == want, (i, t)
    assert token_counts.section_token_counts(df.limit(0), path, P.PATTERN).collect() == []


def byte_spans(text):
    """The character that each byte of the text belongs to."""
    return [i for i, ch in enumerate(text) for _ in ch.encode()]


@pytest.fixture(scope="module")
def model(spark):
    return license_scan.fit_license_model(spark)


def test_license_scan(spark, documents, model):
    named = {"Licensed under the Apache License, Version 2.0.": "apache", "Released under the MIT License.": "mit",
             "Licensed under CC BY-NC 4.0.": "cc-by-nc", "All rights reserved.": "proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "gpl",
             "SPDX-License-Identifier: MPL-2.0": "mpl"}
    clean = ["The old river runs under the bridge.", "She lost her license to drive.", "Version 2.0 of the story."]
    texts = [f"{c}\n{n}\nMore words follow here." for c, n in zip(clean * 2, named)] + clean + [None, "", "\n\n", "x" * 9999]
    got = {(r["doc_id"], r["paragraph"]): r for r in license_scan.scan_licenses(documents(texts), model).collect()}
    for i, (n, family) in enumerate(named.items()):
        r = got[i, 1]
        assert (r["text"], r["family"], r["confirmed"]) == (n, family, True), r
    assert all(k[1] == 1 and k[0] < len(named) for k, r in got.items() if r["confirmed"])
    assert license_scan.scan_licenses(documents(["a"]).limit(0), model).collect() == []


def test_license_held_out_accuracy(spark, model):
    """Held-out labelled rows, scored by a plain replica of the model."""
    import math
    import re
    cues = set(license_scan.cue_words())
    weights = dict(zip(model.vocabulary, model.weights))
    right = total = wrong_family = 0
    for text, family, held in license_scan.labelled_rows():
        if not held:
            continue
        w = [x for x in (p.strip(".+-") for p in re.split(license_scan.WORD, text.lower())) if x]
        g = {" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1) if cues & set(w[i:i + n])}
        z = [b + sum(weights[x][k] for x in g if x in weights) for k, b in enumerate(model.bias)]
        z = [x / model.temperature for x in z]
        top = max(z)
        p = [math.exp(x - top) for x in z]
        p = [x / sum(p) for x in p]
        best = max(range(len(p)), key=p.__getitem__)
        said = model.families[best] if best and p[best] >= model.least else license_scan.UNKNOWN
        total += 1
        right += said == family
        wrong_family += said not in (family, license_scan.UNKNOWN)
    assert right >= 0.93 * total and wrong_family <= 0.02 * total, (right, total, wrong_family)
