"""Exact top-k search (7): impact-ordered, score at a time.

Vectors and queries are dealt to blocks by a hash of their id; a cell is one
block of each. In a cell the vectors are indexed by posting segments: all
entries of one dimension whose impact (the entry's magnitude, quantised to
powers of two) is equal. Segments are processed by descending impact for all
queries of the cell together, adding to the score accumulators. After each
impact level a vector's unseen entries have a known Euclidean norm, so its
score lies within ``norm(query) * norm(unseen)`` of the accumulator. A query
stops only when that proves that few vectors can be among its k best; those
possible members are rescored exactly, everything else is proved out. A query
for which no level proves enough runs to the last one, where scores are exact.

Every query's k best of each cell meet in one ranking that Spark limits
before its shuffle. Cells are the unit of memory: ``VECTORS`` by ``QUERIES``.

Defined cases: vectors that are null, or hold null or non-finite components,
and rows with a null id take no part; rows with one id count once (the
smallest vector); shorter vectors are padded with zeros; ties go to the
smaller id; fewer than k candidates are all returned; inner products must fit
64 bits; texts do not occur; other columns are ignored, whatever their names; an
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VECTORS, QUERIES = 8192, 512
SCALE = 64
WORTH = 0.125               # a proof is tried once the unseen norm is at most this share of the whole
ENOUGH = 8                  # a query stops when at most ENOUGH * k vectors remain possible


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(vec_id, v ARRAY<BIGINT>)``: floor(scale * x) of usable vectors, one row per id."""
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    d = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)
    return (d.select("vec_id", F.transform("x", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint")).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


class ImpactIndex:
    """Posting segments of one block of vectors, by descending impact. The segments
    of one impact level are held side by side, a column per dimension that has any,
    so that a level is scored for all queries by one product."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.highest = int(np.abs(vectors).max(initial=0))
        size = np.abs(vectors)
        level = np.where(size > 0, np.frexp(size.astype(np.float64))[1], 0)
        self.segments: list[tuple[np.ndarray, np.ndarray]] = []
        self.unseen: list[np.ndarray] = []
        square = vectors.astype(np.float64) ** 2
        self.norm = np.sqrt(square.sum(axis=1))
        for at in sorted(set(np.unique(level).tolist()) - {0}, reverse=True):
            here = level == at
            dims = np.flatnonzero(here.any(axis=0))
            self.segments.append((dims, np.where(here[:, dims], vectors[:, dims], 0).T))
            self.unseen.append(np.sqrt(np.where(level < at, square, 0).sum(axis=1)))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query_id, vec_id, score)`` of each query's k best, its own id left out."""
        n = len(self.ids)
        norm = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        # sums of integers below 2**53 are exact in doubles
        small = self.highest * int(np.abs(queries).max(initial=0)) * queries.shape[1] < 2 ** 53
        kind = np.float64 if small else np.int64
        active = np.arange(len(queries))
        acc = np.zeros((len(queries), n), kind)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for level, ((dims, postings), unseen) in enumerate(zip(self.segments, self.unseen)):
            if not len(active):
                break
            acc += queries[active][:, dims].astype(kind) @ postings.astype(kind)
            last = level == len(self.segments) - 1
            if not last and unseen.max() > WORTH * self.norm.max():
                continue                          # too much unseen for a proof to be likely
            slack = norm[active][:, None] * unseen[None, :] * (1 + 1e-9) + (0 if last else 1)
            low, high = acc - slack, acc + slack
            rows, own = np.nonzero(self.ids[None, :] == query_ids[active][:, None])
            low[rows, own], high[rows, own] = -np.inf, -np.inf
            place = n - min(k, n)
            edge = np.partition(low, place, axis=1)[:, place]      # the k-th best lower bound
            possible = high >= edge[:, None]
            possible[rows, own] = False
            done = (possible.sum(axis=1) <= ENOUGH * k) | last
            for i in np.flatnonzero(done):
                out.append(self._rescore(query_ids[active[i]], queries[active[i]], np.flatnonzero(possible[i]), k))
            active, acc = active[~done], acc[~done]
        if not self.segments:                                       # all vectors are zero
            for q, v in zip(query_ids, queries):
                out.append(self._rescore(q, v, np.flatnonzero(self.ids != q), k))
        if not out:
            z = np.zeros(0, np.int64)
            return z, z, z
        return tuple(np.concatenate(c) for c in zip(*out))

    def _rescore(self, query_id: int, query: np.ndarray, members: np.ndarray, k: int):
        score = self.vectors[members] @ query
        best = np.lexsort((self.ids[members], -score))[:k]
        return np.full(len(best), query_id, np.int64), self.ids[members][best], score[best]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    at = 0
    for chunk in column.chunks:
        lengths = pa.compute.list_value_length(chunk).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(at, at + len(chunk)), lengths)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        cols = np.arange(lengths.sum()) - np.repeat(starts, lengths)
        out[rows, cols] = chunk.flatten().to_numpy(zero_copy_only=False)
        at += len(chunk)
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of integer vectors ``(vec_id, v)``: each
    query's k highest inner products over all vectors but its own."""
    n, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    m = queries.count()
    shards, blocks = max(1, -(-n // VECTORS)), max(1, -(-m // QUERIES))
    right = vectors.select("vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    left = queries.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
                          F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))

    def cell(q: pa.Table, v: pa.Table) -> pa.Table:
        if q.num_rows and v.num_rows:
            index = ImpactIndex(v["vec_id"].to_numpy(), _matrix(v["v"], width))
            found = index.search(q["vec_id"].to_numpy(), _matrix(q["v"], width), k)
        else:
            found = [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found))))

    best = (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
            .applyInArrow(cell, "query_id bigint, vec_id bigint, score bigint"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
