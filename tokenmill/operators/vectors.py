"""Embedding-table jobs (M2, M5, M6)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.functions.vectors import as_double
from tokenmill.operators.prefix import running_totals

BROADCAST_BYTES = 64 << 20


HOT_IDS = 1024          # frequent ids that are looked up by broadcast, at most


def embed_tokens(tokens: DataFrame, table: DataFrame, ids_col: str = "ids", key: str = "doc_id",
                 table_id: str = "token_id", vec_col: str = "vec", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """M2: one row per token position: ``(key, pos, token_id, vec)``.

    The embedding table has one row per vocabulary id. It is broadcast when
    its measured size (rows x dims x 4 bytes) is at most ``broadcast_bytes``. Otherwise
    the ids that have more positions than a quarter of an even partition are measured
    (few by definition, and at most ``HOT_IDS`` rows of the table): they are looked up in a broadcast
    of these rows alone, all other positions by a shuffle join.
    """
    pos = tokens.select(F.col(key).alias(key), F.posexplode(ids_col).alias("pos", "token_id"))
    t = table.select(F.col(table_id).cast("int").alias("token_id"), F.col(vec_col).alias("vec"))
    stats = t.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    est = (stats["n"] or 0) * (stats["d"] or 0) * 4
    columns = (key, "pos", "token_id", "vec")
    if est <= broadcast_bytes:
        return pos.join(F.broadcast(t), "token_id", "left").select(*columns)
    hot = frequent_ids(pos)
    if not hot:
        return pos.join(t, "token_id", "left").select(*columns)
    is_hot = F.coalesce(F.col("token_id").isin(hot), F.lit(False))
    often = pos.filter(is_hot).join(F.broadcast(t.filter(is_hot)), "token_id", "left").select(*columns)
    return often.unionByName(pos.filter(~is_hot).join(t.filter(~is_hot), "token_id", "left").select(*columns))


def frequent_ids(pos: DataFrame, id_col: str = "token_id", limit: int = HOT_IDS) -> list[int]:
    """Ids with over a quarter of the positions that a shuffle partition would get if all were even."""
    parts = int(pos.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = pos.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    many = counts.agg(total).first()[0] / (4 * parts)
    rows = counts.filter(F.col("n") > many).orderBy(F.desc("n"), id_col).limit(limit).collect()
    return [r[id_col] for r in rows]


def softmax_over(df: DataFrame, keys: list[str], score: str, out: str = "weight") -> DataFrame:
    """M5 over rows: ``exp(s - max) / sum(exp(s - max))`` within each group.

    Group max and sum are grouped aggregates (partial + final, so a huge
    group does not land in one task) joined back on the keys.
    """
    mx = df.groupBy(*keys).agg(F.max(score).alias("_m"))
    with_m = df.join(mx, keys)
    e = with_m.withColumn("_e", F.exp(F.col(score).cast("double") - F.col("_m")))
    tot = e.groupBy(*keys).agg(F.sum("_e").alias("_s"))
    return e.join(tot, keys).withColumn(out, F.col("_e") / F.col("_s")).drop("_m", "_e", "_s")


def _block_partials(scale: float, look_back: int | None):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, k = pdf[pdf["_role"] == 0], pdf[pdf["_role"] == 1]
        columns = ["_e", "_o", "_i", "_m", "_s", "_acc"]
        if q.empty or k.empty:
            return pd.DataFrame({c: [] for c in columns})
        queries = np.stack(q["_v"].to_numpy()).astype(np.float64)
        keys = np.stack(k["_v"].to_numpy()).astype(np.float64)
        age = q["_r"].to_numpy()[:, None] - k["_r"].to_numpy()[None, :]
        seen = (age >= 0) if look_back is None else (age >= 0) & (age < look_back)
        scores = np.where(seen, (queries @ keys.T) * scale, -np.inf)
        top = scores.max(axis=1)
        some = np.isfinite(top)
        weights = np.where(seen, np.exp(scores - np.where(some, top, 0.0)[:, None]), 0.0)
        return pd.DataFrame(dict(zip(columns, (
            q["_e"].to_numpy()[some], q["_o"].to_numpy()[some], q["_r"].to_numpy()[some], top[some],
            weights.sum(axis=1)[some], list((weights @ keys)[some])))))
    return run


def causal_history(df: DataFrame, entity: str, order: str, vec: str, block: int = 1024,
                   look_back: int | None = None) -> DataFrame:
    """M6: for each row i of an entity, the softmax over rows j <= i of
    ``dot(x_i, x_j) / sqrt(d)`` weighting ``x_j`` (q = k = v = x):
    ``(entity, order, out ARRAY<DOUBLE>)``. With ``look_back`` only the last
    so many rows, the row itself included, take part.

    Exact, without a group in one task and without pair rows: rows are
    numbered per entity (two-phase prefix count), cut into blocks of
    ``block`` rows, and each (query block, key block <= query block) group,
    at most ``2 * block`` rows, computes log-sum-exp partials with NumPy.
    A row's partials, one per key block, are merged as whole arrays:
    ``M = max m``, ``S = sum s e^(m-M)``, ``out = sum acc e^(m-M) / S``.
    """
    d = df.select(F.col(entity).alias("_e"), F.col(order).alias("_o"), as_double(vec).alias("_v"))
    dim = d.select(F.max(F.size("_v"))).first()[0] or 1
    d = d.withColumn("_one", F.lit(1).cast("bigint"))
    num = running_totals(d, ["_e"], "_o", ["_one"], inclusive=False)
    num = num.select("_e", "_o", "_v", F.col("_one_run").alias("_r"),
                     F.floor(F.col("_one_run") / block).alias("_b"))
    numb = num.join(num.groupBy("_e").agg(F.max("_b").alias("_nb")), "_e")
    oldest, newest = F.lit(0).cast("bigint"), F.col("_nb")
    if look_back is not None:
        reach = -(-(look_back - 1) // block)           # key blocks before a query's own that it can need
        oldest, newest = F.greatest(oldest, F.col("_b") - reach), F.least(newest, F.col("_b") + reach)
    # a query row meets the key blocks up to its own; a key row the query blocks from its own
    queries = numb.select("_e", "_o", "_r", "_v", F.col("_b").alias("_qb"),
                          F.explode(F.sequence(oldest, F.col("_b"))).alias("_kb"), F.lit(0).alias("_role"))
    keys = numb.select("_e", "_o", "_r", "_v", F.explode(F.sequence(F.col("_b"), newest)).alias("_qb"),
                       F.col("_b").alias("_kb"), F.lit(1).alias("_role"))
    parts = queries.unionByName(keys).groupBy("_e", "_qb", "_kb").applyInPandas(
        _block_partials(1.0 / math.sqrt(dim), look_back),
        f"_e {df.schema[entity].dataType.simpleString()}, _o {df.schema[order].dataType.simpleString()}, _i bigint, "
        "_m double, _s double, _acc array<double>")
    g = parts.groupBy("_e", "_i").agg(F.first("_o").alias("_o"), F.max("_m").alias("_mx"),
                                      F.collect_list(F.struct("_m", "_s", "_acc")).alias("_p"))
    weigh = F.transform("_p", lambda p: F.struct((p["_s"] * F.exp(p["_m"] - F.col("_mx"))).alias("s"),
                                                 F.transform(p["_acc"], lambda a: a * F.exp(p["_m"] - F.col("_mx"))).alias("a")))
    g = g.select("_e", "_o", weigh.alias("_p"))
    total = F.aggregate("_p", F.lit(0.0), lambda t, p: t + p["s"])
    acc = F.aggregate(F.slice("_p", 2, F.size("_p")), F.element_at("_p", 1)["a"],
                      lambda t, p: F.zip_with(t, p["a"], lambda x, y: x + y))
    g = g.select("_e", "_o", total.alias("_t"), acc.alias("_a"))
    return g.select(F.col("_e").alias(entity), F.col("_o").alias(order),
                    F.transform("_a", lambda a: a / F.col("_t")).alias("out"))
