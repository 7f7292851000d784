import tempfile

from tokenmill.operators.stats import word_freq
from tokenmill.streaming.word_counts import start_word_counts, stream_documents


def test_streaming_word_counts_equal_batch(spark):
    src = "/root/testdata/sf0.001/documents.parquet"
    docs = stream_documents(spark, "/root/testdata/sf0.001",
                            "doc_id bigint, text string, lang string, source string, n_chars bigint",
                            glob="documents.parquet")
    ck = tempfile.mkdtemp(prefix="tokenmill-stream-")
    q = start_word_counts(docs, ck, query_name="wc_test")
    q.processAllAvailable()
    q.stop()
    got = {r["word"]: r["n"] for r in spark.table("wc_test").collect()}
    want = {r["word"]: r["n"] for r in word_freq(spark.read.parquet(src)).collect()}
    assert got == want


def chunk_files(spark, folder, texts):
    """One file per chunk, in order of their time."""
    import os
    for i, chunk in enumerate(texts):
        spark.createDataFrame([(i * 100 + j, t) for j, t in enumerate(chunk)], "doc_id long, text string").coalesce(1) \
            .write.parquet(f"{folder}/chunk{i}")
        for name in os.listdir(f"{folder}/chunk{i}"):
            os.utime(f"{folder}/chunk{i}/{name}", (1_000_000 + i * 1000,) * 2)


def test_chunk_training_survives_a_restart(spark, tmp_path, monkeypatch):
    import random

    import pytest
    from pyspark.errors import StreamingQueryException
    from tokenmill.streaming import train_chunks as tc
    rng = random.Random(3)
    texts = [[" ".join(rng.choice(["river", "riverbank", "bank", "ranks", "drank", "é", "overseas", "seasons", "sonata", "atlas"]) for _ in range(20)) for _ in range(5)]
             for _ in range(4)]
    chunk_files(spark, str(tmp_path / "in"), texts)
    one_pass = None
    for i, chunk in enumerate(texts):
        words = word_freq(spark.createDataFrame([(t,) for t in chunk], "text string"))
        one_pass = tc.train_chunk(words, i, str(tmp_path / "once"), 400, 4)
    again = tc.train_chunk(word_freq(spark.createDataFrame([("zzzz zzzz",)], "text string")), 3, str(tmp_path / "once"), 400, 4)
    assert [m[:3] for m in again.merges] == [m[:3] for m in one_pass.merges]       # a batch counts once
    assert len(one_pass.merges) == 16 and tc.published_batches(spark, str(tmp_path / "once")) == [2, 3]

    def start():
        docs = stream_documents(spark, f"{tmp_path}/in/*", max_files_per_trigger=1)
        return tc.start_chunk_training(docs, str(tmp_path / "state"), str(tmp_path / "ck"), 400, 4, available_now=True)

    write = tc.write_tokenizer
    for when in ("before", "after"):              # the third chunk dies before, then right after, its model is published
        def fail(spark_, model, path, trained_on=""):
            if "batch-2" in path:
                if when == "after":
                    write(spark_, model, path, trained_on)
                raise RuntimeError("the driver died")
            write(spark_, model, path, trained_on)
        monkeypatch.setattr(tc, "write_tokenizer", fail)
        with pytest.raises(StreamingQueryException):
            start().awaitTermination()
        assert tc.published_batches(spark, str(tmp_path / "state"))[-1] == (1 if when == "before" else 2)
    monkeypatch.setattr(tc, "write_tokenizer", write)
    start().awaitTermination()
    got = tc.chunk_model(spark, str(tmp_path / "state"))
    assert [m[:3] for m in got.merges] == [m[:3] for m in one_pass.merges]
