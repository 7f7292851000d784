"""Headline timings: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_MERGES (merges learned by the training query, default 64).
Each query is forced to completion with the ``noop`` sink (or an action
for driver-side results such as training).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tokenmill.constants import FIRST_MERGE_ID  # noqa: E402
from tokenmill.operators.codec import decode_corpus, encode_corpus  # noqa: E402
from tokenmill.operators.stats import pair_freq, stream_pair_freq, training_documents, word_freq  # noqa: E402
from tokenmill.operators.train import train_bpe  # noqa: E402
from tokenmill.operators.vectors import causal_history  # noqa: E402
from tokenmill.operators.windows import context_windows, example_count, permuted_batches, token_stream  # noqa: E402
from tokenmill.session import get_spark  # noqa: E402
from tokenmill.sources.corpus import read_table  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    merges = int(os.environ.get("BENCH_MERGES", "64"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    docs = read_table(spark, sf, "documents")
    timed("warmup_read", lambda: run(docs.select(F.length("text"))))
    timed("a1_word_freq", lambda: run(word_freq(docs)))
    timed("a1_word_freq_training_docs", lambda: run(word_freq(training_documents(docs, title_col=None), "clean", clean=False)))
    timed("a3_pair_freq", lambda: run(pair_freq(word_freq(docs))))
    timed("a4_stream_pair_freq", lambda: run(stream_pair_freq(docs)))
    model = timed("v3_train_exact", lambda: train_bpe(word_freq(docs), FIRST_MERGE_ID + merges))
    enc = encode_corpus(docs, model, mode="sweep")
    timed("e1_encode_sweep", lambda: run(enc))
    timed("e2_encode_ranked", lambda: run(encode_corpus(docs, model, mode="ranked")))
    timed("e4_decode", lambda: run(decode_corpus(enc, model)))
    # the stream is built (and its documents encoded) inside the timed part
    timed("p2_windows_stride1", lambda: run(context_windows(token_stream(enc), 32, stride=1)))
    def batches():
        stream = token_stream(enc)
        run(permuted_batches(context_windows(stream, 32, stride=32), 4, example_count(stream, 32, 32)))

    timed("p3_shuffle_batches", batches)
    emb = read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("k"), F.col("embedding").alias("v"))
    conv = read_table(spark, sf, "conversations").select(
        "conv_id", "turn", F.pmod(F.col("conv_id") * 31 + F.col("turn"), F.lit(emb.count())).alias("k"))
    timed("m6_causal_history", lambda: run(causal_history(conv.join(emb, "k"), "conv_id", "turn", "v")))
    queries = {k: v for k, v in times.items() if k != "warmup_read"}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(queries.values()), 3), "unit": "sec",
                      "queries": queries, "sf": sf, "cpus": int(cpus), "train_merges": len(model.merges),
                      "train_rounds": getattr(model, "rounds", None)}))
    spark.stop()


if __name__ == "__main__":
    main()
