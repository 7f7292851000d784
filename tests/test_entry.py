import duckdb

import __spark_entry__ as E
from check_oracle_helpers import digest

SF = "/root/testdata/sf0.001"
CHEAP = ["T1_compose_document", "T3_clean_text", "T5_isolate_digits", "T8_byte_symbols", "T10_render_chat",
         "A1_top20_words", "A3_pair_freq", "A4_stream_pair_freq", "A5_top_pairs", "A10_running_mean",
         "M3_rotary", "M6_causal_history", "P4_pad_batch", "S5_byte_alphabet", "V1_base_vocab"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 20 and df.columns == ["word", "n"]


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    if E.training_data is None:
        assert not any(k.lower().startswith("op") or "pipeline" in k.lower() for k in q)


def test_oracles_small(spark):
    q, o = E.queries(), E.oracle_sql()
    con = duckdb.connect()
    for t in ["documents", "conversations", "embeddings", "events", "benchmark", "pages"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for name in CHEAP:
        df = q[name](spark, SF)
        s = digest(df.columns, [tuple(r) for r in df.collect()])
        res = con.execute(o[name])
        d = digest([x[0] for x in res.description], res.fetchall())
        assert s == d, name
