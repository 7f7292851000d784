"""Null ids, repeated rows, very long texts and clashing columns for the operators that
judge row by row."""
import hashlib
import re

import public_tokenizers as P
import pytest

from llm_odd import rows
from tokenmill.llm import best_fit, byte_bpe, license_scan, quality_rules, token_counts, url_rules

LONG = "A long line goes on and on. " * 8_000 + "x" * 300_000
TEXTS = [(1, "Some text, twice."), (1, "Some text, twice."), (None, "Some text, twice."), (2, LONG), (3, None), (4, "")]
CLASH = ("doc_id bigint, text string, kept string, n_words string, ids string, section string, sequence_id string, family string, "
         "`my col` decimal(4,1), lang string, source string")


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*x, *["c"] * 6, None, "en", "s") for x in TEXTS], CLASH)


def test_quality_rows(docs):
    got = sorted(rows(quality_rules.quality_report(docs), "doc_id", "n_words", "kept"), key=str)
    assert got == sorted([(1, 3, False), (1, 3, False), (None, 3, False), (2, 56_001, False), (3, 0, False), (4, 0, False)], key=str)
    assert quality_rules.quality_report(docs.limit(0)).collect() == []


def test_encoded_rows(docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = byte_bpe.encode_documents(docs, path, P.PATTERN)
    got = byte_bpe.decode_documents(enc, path, P.PATTERN).collect()
    assert sorted((str(r["doc_id"]), hashlib.md5(bytes(r["decoded"])).hexdigest()) for r in got) == \
        sorted((str(d), hashlib.md5((t or "").encode()).hexdigest()) for d, t in TEXTS)
    assert len({tuple(r["ids"]) for r in got if r["doc_id"] in (1, None)}) == 1


def test_counted_rows(docs):
    got = token_counts.section_token_counts(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert len(got) == 6 * len({r["section"] for r in got if r["doc_id"] == 2}) and {r["section"] for r in got} == {
        r["section"] for r in got if r["doc_id"] is None}
    by = {}
    for r in got:
        by.setdefault((r["doc_id"], r["section"]), []).append(r["n_tokens"])
    assert len(by[1, "lead"]) == 2 and by[1, "lead"] == 2 * by[None, "lead"] and by[3, "lead"] == by[4, "lead"] == [0]
    assert by[2, "lead"][0] > 50_000


def test_packed_rows(docs):
    out = best_fit.pack_documents(docs, P.path("word_bpe_49k.json")).collect()
    ones = [r for r in out if r["doc_id"] == 1]
    assert len(ones) == 2 and ones[0]["ids_crc32"] == ones[1]["ids_crc32"]
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == len(out) and sum(r["doc_id"] is None for r in out) == 1
    long = sorted((r for r in out if r["doc_id"] == 2), key=lambda r: r["piece"])
    assert len(long) > 10 and all(r["length"] == 4096 for r in long[:-1])
    assert [r["length"] for r in out if r["doc_id"] in (3, 4)] == [1, 1]


@pytest.fixture(scope="module")
def model(spark):
    return license_scan.fit_license_model(spark)


def test_scanned_rows(spark, model):
    line = "Released under the MIT License."
    data = [(1, line), (1, line), (None, line), (2, LONG + "\n" + line), (3, None), (4, "")]
    df = spark.createDataFrame([(*x, *["c"] * 6, None, "en", "s") for x in data], CLASH)
    got = license_scan.scan_licenses(df, model).collect()
    assert sorted((str(r["doc_id"]), r["paragraph"]) for r in got) == [("1", 0), ("1", 0), ("2", 1), ("None", 0)]
    assert all(r["family"] == "mit" and r["confirmed"] for r in got)


def plain_scan(text, model):
    """The query's rows of one text, from the definitions."""
    import math
    cues = set(license_scan.cue_words())
    weights = dict(zip(model.vocabulary, model.weights))
    lines, parts = (text or "").split("\n"), []
    for k, line in enumerate(lines):
        before = lines[k - 1].rstrip(" \t\r") if k else ""
        if k and 40 <= len(before) <= 120 and before[-1] not in ".!?:;" and line.strip():
            parts[-1] = parts[-1].rstrip(" \t\r") + " " + line
        else:
            parts.append(line)
    out = []
    for k, part in enumerate(parts):
        w = [x for x in (p.strip(".+-") for p in re.split(license_scan.WORD, part.lower())) if x]
        grams = {" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1) if cues & set(w[i:i + n])}
        z = [b + sum(weights[g][i] for g in grams if g in weights) for i, b in enumerate(model.bias)]
        best = max(range(len(z)), key=z.__getitem__)
        p = 1 / sum(math.exp((x - z[best]) / model.temperature) for x in z)
        if not cues & set(w) or best == 0 or p < model.least:
            continue
        own = {*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}
        share = 0.0
        for t in license_scan.TEMPLATES[model.families[best]]:
            tw = license_scan._words(t)
            need = {*tw, *(f"{a} {b}" for a, b in zip(tw, tw[1:]))}
            share = max(share, len(need & own) / len(need))
        out.append((k, model.families[best], p, share))
    return out


def test_scan_equals_definitions(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    header = ("Licensed to the authors under one or more agreements. This program is free to use\nunder the terms of the GNU "
              "General Public License as published by\nthe Free Software Foundation, whatever the year.\n\nOther text.")
    more = spark.createDataFrame([(10 ** 6, header), (10 ** 6 + 1, "All rights\nreserved."), (10 ** 6 + 2, None)], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").unionByName(more)
    got = {}
    for r in license_scan.scan_licenses(docs, model).collect():
        got.setdefault(r["doc_id"], []).append((r["paragraph"], r["family"], r["probability"], r["similarity"], r["confirmed"]))
    want = {r["doc_id"]: x for r in docs.collect() if (x := plain_scan(r["text"], model))}
    assert set(got) == set(want) and len(want) > 30
    for d, x in want.items():
        assert [(k, f) for k, f, _, _, _ in sorted(got[d])] == [(k, f) for k, f, _, _ in x]
        for (_, _, p, s, ok), (_, _, q, share) in zip(sorted(got[d]), x):
            assert abs(p - q) < 2e-6 and abs(s - share) < 2e-6 and ok == (share >= license_scan.CONFIRM)
    assert [x[:2] for x in want[10 ** 6]] == [(0, "gpl")] and sorted(got[10 ** 6])[0][4]      # a wrapped header is confirmed


def test_url_rows(spark):
    long = "http://a.org/" + "x/" * 100_000 + "casino"
    data = [(1, "http://b.net/es/"), (1, "http://b.net/es/"), (None, "http://b.net/es/"), (2, long), (3, None)]
    df = spark.createDataFrame([(*x, "r", "h") for x in data], "page_id bigint, url string, rule string, host string")
    got = sorted(rows(url_rules.judge_urls(df), "page_id", "rule", "verdict", "pattern"), key=str)
    assert got == sorted([(1, "net/es/", "block", None)] * 2 + [(None, "net/es/", "block", None), (2, None, "block", "casino"),
                                                               (3, None, "allow", None)], key=str)


def test_ten_thousand_rules_run_few_expressions(spark, monkeypatch):
    import random
    rng = random.Random(4)
    hosts = [(("block", "allow")[i % 2], f"site{i}.example{i % 7}.com", f"/p{i % 13}/", None) for i in range(7000)]
    words = [("block", None, None, f"word{i}-{rng.choice(['buy', 'win', 'now'])}") for i in range(3000)]
    table = spark.createDataFrame(hosts + words, "verdict string, host string, path string, words string")
    rules = url_rules.rules_from_table(table)
    assert len(rules) == 10_000
    urls = [f"http://sub.site{rng.randrange(9000)}.example{rng.randrange(7)}.com/p{rng.randrange(13)}/word{rng.randrange(4000)}-buy"
            for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"], r["pattern"]) for r in url_rules.judge_urls(pages, rules).collect()}
    compiled = [(r, re.compile(r.pattern)) for r in rules]
    parts = [u.split("://")[1].split("/", 1) for u in urls]
    for i, (host, path) in enumerate(parts):
        fit = [r for r, e in compiled if e.search(f"{host}/{path}")]
        best = max(fit, key=lambda r: (r.rank, len(r.text), r.text), default=None)
        assert got[i] == ((best.text if best.rank else None, best.verdict, None if best.rank else best.text) if best
                          else (None, "allow", None)), urls[i]
    counts = url_rules.token_counts(spark.createDataFrame([(h, "/" + p) for h, p in parts], "host string, path string"),
                                    sorted({t for r in rules for t in r.literals}))
    index = url_rules.rule_index(rules, counts)
    run = [sum(1 for _ in url_rules.candidates(index, h, "/" + p)) for h, p in parts]
    assert sum(run) / len(run) < 5 and max(run) < 20
    monkeypatch.setattr(url_rules, "MAX_RULES", 9_999)
    with pytest.raises(ValueError):
        url_rules.rules_from_table(table)
