import json
import os

import pytest

from tokenmill.constants import SPECIAL_TOKENS_25
from tokenmill.operators.codec import encode_corpus
from tokenmill.operators.train import BpeModel
from tokenmill.sources.corpus import read_corpus
from tokenmill.sources.tokenizer_io import read_tokenizer, write_tokenizer


def test_first_n_of_text_files_is_in_file_order(spark, tmp_path):
    for name, lo in (("b.txt", 4000), ("a.txt", 0)):
        (tmp_path / name).write_text("".join(f"line {i}\n" for i in range(lo, lo + 4000)))
    got = read_corpus(spark, str(tmp_path), fmt="text", max_examples=5).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(i, f"line {i}") for i in range(5)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        every = read_corpus(spark, str(tmp_path), fmt="text")
        assert {r["doc_id"]: r["text"] for r in every.collect()} == {i: f"line {i}" for i in range(8000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert read_corpus(spark, str(tmp_path), fmt="text", max_examples=10 ** 6).count() == 8000


def test_tokenizer_with_25_specials_survives(spark, tmp_path):
    a, b = 25 + 97, 25 + 98
    m = BpeModel(specials=list(SPECIAL_TOKENS_25), merges=[(a, b, 281, 3, 9), (281, a, 282, 2, 7)])
    path = str(tmp_path / "tok")
    write_tokenizer(spark, m, path, "test")
    assert os.path.isfile(f"{path}/tokenizer.json") and os.path.isfile(f"{path}/tokenizer_config.json")
    doc = json.load(open(f"{path}/tokenizer.json", encoding="utf-8"))
    assert doc["model"]["merges"] == ["a b", "ab a"] and doc["model"]["vocab"]["ab"] == 281 and doc["model"]["unk_token"] is None
    assert doc["pre_tokenizer"]["pretokenizers"][0] == {"type": "Digits", "individual_digits": True}
    back = read_tokenizer(spark, path)
    assert (back.specials, back.byte_offset, [x[:3] for x in back.merges]) == (m.specials, 25, [x[:3] for x in m.merges])
    assert back.vocab_bytes() == m.vocab_bytes()
    df = spark.createDataFrame([(1, "ab aba")], "doc_id long, text string")
    assert encode_corpus(df, back).first()["ids"] == encode_corpus(df, m).first()["ids"]


def test_missing_and_damaged_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_tokenizer(spark, str(tmp_path / "none"))
    for name, text in (("cut", '{"version": "1.0", "model": {"type": "BPE", "vocab": {"a": 1'), ("empty", ""), ("other", "{}")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "tokenizer.json").write_text(text)
        with pytest.raises(ValueError):
            read_tokenizer(spark, str(tmp_path / name))


def test_file_order_rows(spark):
    import hashlib

    import pyarrow.parquet as pq

    from tokenmill.plans.catalog import QUERIES, load_all
    load_all()
    html = pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["html"])["html"].to_pylist()
    got = {(r["doc_id"], r["text_sha256"]) for r in QUERIES["S1_file_order_rows"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {(i, hashlib.sha256(x.encode()).hexdigest()) for i, x in enumerate(html)}


def test_a_vocabulary_with_its_own_alphabet_survives(spark, tmp_path):
    from tokenmill.operators.codec import decode_corpus
    from tokenmill.operators.train import train_bpe
    words = spark.createDataFrame([("banana", 3), ("band", 2), ("é", 1)], "word string, n bigint")
    m = train_bpe(words, 25 + 6 + 3, specials=list(SPECIAL_TOKENS_25), alphabet="corpus")
    assert m.alphabet == sorted({*"bandé".encode()}) and m.first_merge_id == 31 and m.vocab_size == 34
    assert m.merges[0][:4] == (25, 28, 31, 8)               # a, n
    path = str(tmp_path / "tok")
    write_tokenizer(spark, m, path)
    doc = json.load(open(f"{path}/tokenizer.json", encoding="utf-8"))["model"]
    assert doc["unk_token"] == "<unk>" and doc["byte_fallback"] is False and len(doc["vocab"]) == 34
    back = read_tokenizer(spark, path)
    assert (back.alphabet, back.byte_offset, back.vocab_bytes()) == (m.alphabet, 25, m.vocab_bytes())
    df = spark.createDataFrame([(1, "banana bxn"), (2, "ü")], "doc_id long, text string")
    for mode in ("ranked", "sweep", "native"):
        enc = encode_corpus(df, back, mode=mode, splitter="lossless")
        got = {r["doc_id"]: r["ids"] for r in enc.collect()}
        # the space, x and the second byte of the other vowel have no id
        assert got[1][-4:] == [0, 26, 0, 28] and got[2] == [29, 0] or got[2] == [30, 0]
        assert {r["doc_id"]: r["text"] for r in decode_corpus(enc, back).collect()}[1] == "banana<unk>b<unk>n"
    # bytes without an id are never merged
    more = train_bpe(spark.createDataFrame([("xxxx", 9), ("xan", 2)], "word string, n bigint"), 40, base_model=back)
    assert all(0 not in x[:2] for x in more.merges) and more.alphabet == m.alphabet


def test_a_writer_that_dies_leaves_the_old_model(spark, tmp_path, monkeypatch):
    from tokenmill.sources import tokenizer_io as io
    path = str(tmp_path / "tok")
    old = BpeModel(merges=[(19 + 97, 19 + 98, 275, 1, 1)])
    new = BpeModel(merges=[(19 + 98, 19 + 97, 275, 1, 1), (275, 19 + 97, 276, 1, 1)])
    write_tokenizer(spark, old, path)
    one_file = io._write_one_file
    for dies_at in ("tokenizer_config.json", "tokenizer.json", io.MANIFEST):
        def fail(df, folder, name):
            if name == dies_at:
                raise RuntimeError("the writer died")
            one_file(df, folder, name)
        monkeypatch.setattr(io, "_write_one_file", fail)
        with pytest.raises(RuntimeError):
            write_tokenizer(spark, new, path)
        assert [m[:3] for m in read_tokenizer(spark, path).merges] == [m[:3] for m in old.merges]
    monkeypatch.setattr(io, "_write_one_file", one_file)
    for model in (new, old, new):
        write_tokenizer(spark, model, path)
        assert [m[:3] for m in read_tokenizer(spark, path).merges] == [m[:3] for m in model.merges]
    assert len(os.listdir(f"{path}/versions")) - sum(x.startswith(".") for x in os.listdir(f"{path}/versions")) == 2
    (version,) = {spark.read.json(f"{path}/manifest.json").first()["version"]}
    with open(f"{path}/versions/{version}/tokenizer.json", "a") as f:
        f.write(" ")
    os.remove(f"{path}/versions/{version}/.tokenizer.json.crc") if os.path.exists(
        f"{path}/versions/{version}/.tokenizer.json.crc") else None
    with pytest.raises(ValueError):
        read_tokenizer(spark, path)


def test_splits_are_pruned(spark, tmp_path):
    rows = [(i, f"text {i}", "train" if i % 3 else "test") for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, split string").write.partitionBy("split").parquet(str(tmp_path / "c"))
    test = read_corpus(spark, str(tmp_path / "c"), split="test")
    assert sorted(r["doc_id"] for r in test.collect()) == list(range(0, 30, 3))
    scan = [x for x in test._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in x][-1]
    assert "= test" in scan.split("PartitionFilters")[1].split("]")[0]
    files = read_corpus(spark, str(tmp_path / "c"), split="test", id_col=None)
    assert sorted(r["text"] for r in files.collect()) == sorted(f"text {i}" for i in range(0, 30, 3))
    assert read_corpus(spark, str(tmp_path / "c"), split="none").collect() == []
    assert len(read_corpus(spark, str(tmp_path / "c"), split="train", max_examples=4).collect()) == 4
    with pytest.raises(ValueError):
        read_corpus(spark, "/root/testdata/sf0.001/documents.parquet", split="train")


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    """A file in many splits whose rows are all in one row group: one split would read everything."""
    from pyspark.sql import functions as F
    from tokenmill.session import session_conf
    from tokenmill.sources.corpus import read_table
    spark.range(4000).selectExpr("id as doc_id", "sha2(string(id), 512) as text").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "0"}):
        assert spark.read.parquet(f"{tmp_path}/documents.parquet").rdd.getNumPartitions() >= 4
        got = read_table(spark, str(tmp_path), "documents")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
