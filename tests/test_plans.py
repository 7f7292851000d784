from tokenmill.plans.q_stats import flagship
from tokenmill.operators.codec import decode_ids
from tokenmill.operators.train import BpeModel


def test_flagship_prunes_and_aggregates_partially(spark):
    df = flagship(spark, "/root/testdata/sf0.001")
    scan = df._jdf.queryExecution().sparkPlan().toString()
    assert "struct<text:string>" in scan
    assert "TakeOrderedAndProject" in scan
    assert scan.count("HashAggregate") >= 2   # partial + final around the shuffle


def test_decode_table_is_one_constant(spark):
    m = BpeModel(merges=[(19 + 97, 19 + 98, 275, 2, 0)])
    df = spark.createDataFrame([([275, 19 + 99],)], "ids array<int>").select(decode_ids("ids", m).alias("t"))
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in opt          # the vocabulary array was folded at planning time
    assert df.first()["t"] == "abc"


def test_stream_pairs_hash_before_they_sort(spark):
    """Byte pairs are combined in hash maps; only the table of pairs per document is sorted."""
    from tokenmill.operators.stats import stream_pair_freq
    df = spark.range(4).selectExpr("id as doc_id", "'some text' as text")
    plan = stream_pair_freq(df)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.split("\n") if "Aggregate" in x]
    assert "HashAggregate" in lines[-1] and "HashAggregate" in lines[-2]


def test_approximate_summary(spark):
    from tokenmill.operators.stats import corpus_stats, corpus_stats_approx, pair_freq, word_freq
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    freq = word_freq(docs)
    exact = corpus_stats(docs, docs, freq, pair_freq(freq)).first().asDict()
    for by in (None, "lang"):
        near = corpus_stats_approx(docs, docs, by=by).first().asDict()
        for c, v in exact.items():
            assert abs(near[c] - v) <= (0.03 * v if c.startswith("distinct") else 0), (by, c)
    assert corpus_stats_approx(docs.limit(0), docs.limit(0)).first().asDict() == {
        "articles_read": 0, "articles_kept": 0, "distinct_words": 0, "total_tokens": 0, "distinct_pairs": 0}


def test_stream_pairs_are_counted_per_batch(spark):
    """A byte pair of a batch is one row, not one per place; counts and first places are those of every place."""
    from tokenmill.functions.text import clean_text, isolate_digits
    from tokenmill.operators.stats import stream_pair_freq
    texts = {5: "aaa b1", 2: None, 9: "ba é", 1: "", 3: "é\n\naa", 7: "x"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    raw = {r[0]: (r[1] or "").encode() for r in df.select("doc_id", isolate_digits(clean_text("text"))).collect()}
    for cross in (False, True):
        want, last = {}, None
        for d in sorted(raw):
            if cross and last is not None and raw[d]:
                at = want.setdefault((raw[last][-1], raw[d][0]), [0, last, len(raw[last]) - 1])
                at[0] += 1
            for i in range(len(raw[d]) - 1):
                at = want.setdefault((raw[d][i], raw[d][i + 1]), [0, d, i])
                at[0] += 1
            last = d if raw[d] else last
        got = stream_pair_freq(df, cross_docs=cross)
        assert "regexp_extract_all" not in got._jdf.queryExecution().executedPlan().toString()
        assert {(r["left"] - 19, r["right"] - 19): [r["freq"], r["first_doc"], r["first_pos"]] for r in got.collect()} == want


def test_pairs_of_the_summary_are_distinct_per_batch(spark):
    """The pairs inside pre-tokens come once per part and batch, whatever control characters a text has."""
    import pyarrow as pa
    from tokenmill.functions.text import marked_tokens, pre_tokenize
    from tokenmill.operators.stats import _distinct_pairs
    texts = [("p", "ab ab\x00\x01!"), (None, "é's"), ("q", ""), ("p", None), ("p", "ba1ba\x01\x02"), (None, "aab")]
    df = spark.createDataFrame(texts, "part string, text string")
    for clean in (True, False):
        rows = df.select("part", marked_tokens("text", clean).alias("t"), pre_tokenize("text", clean).alias("w")).collect()
        want = sorted({(str(r["part"]), a << 8 | b) for r in rows for w in r["w"] for a, b in zip(w.encode(), w.encode()[1:])})
        batch = pa.RecordBatch.from_arrays([pa.array([r["part"] for r in rows]), pa.array([r["t"] for r in rows])], names=["part", "t"])
        got = next(_distinct_pairs(iter([batch]))).to_pylist()
        assert sorted((str(r["part"]), r["pair"]) for r in got) == want
