"""Hard negatives through cover trees over norm-augmented vectors (11).

1. Candidates are dealt to shards of about ``NODES`` vectors by a hash of their
   id. Every vector gets one more component, ``sqrt(M**2 - |x|**2)`` with M the
   largest norm of the shard, so all lie on a sphere and inner products with a
   query (whose extra component is zero) become angles.
2. A shard's cover tree, built level by level: a node keeps the members that
   lie within the next radius of its own vector, and the rest is covered by new
   child nodes of that radius. Each vector is one node; a node's
   covering radius is the angle to its farthest descendant. Nodes are rows of a
   written table that all searches read.
3. A search meets a shard's tree with a block of anchors. From the angle
   between anchor and node and the covering radius follow the least and
   greatest inner product below the node. Nodes are opened best first; an
   anchor leaves a node when no window of it can be reached there, or when the
   worst of its best members so far is better than all below. Members are
   verified by exact integer products.
4. Two searches: the anchors' best rows of the same label (their positives),
   then for every anchor and positive the best rows of another label whose
   score lies in the positive's window. The bests of all shards meet in a
   ranking that Spark limits before its shuffle.

Memory is bounded by a cell of ``NODES`` nodes and ``ANCHORS`` anchors. A label
or vector that a third of all rows have is spread over all shards like others.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component, take no part; rows that share an id count once (least
label, then least vector); shorter vectors are padded with zeros; ties go to
the smaller id, equal vectors are members of their own; fewer positives or
negatives than asked for are all returned; an anchor without any gives no row;
inner products must stay below 2**53; texts do not occur; other columns are
ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.common import cut_lineage

NODES, ANCHORS = 2048, 1024
BASE = 1.5                  # radius of a level over that of the next
SLACK = 1e-7                # rounding of angles and cosines
_NONE = np.iinfo(np.int64).max


def labelled_vectors(df: DataFrame, scale: int, id_col: str = "vec_id", label_col: str = "label",
                     vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, label, v ARRAY<BIGINT>)``: floor(scale * x) of usable rows, one row per id."""
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    d = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"),
                  F.col(vec_col).cast("array<double>").alias("x"))
    d = d.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    whole = F.transform("x", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))
    return (d.select("vec_id", F.struct("label", whole.alias("v")).alias("r"))
            .groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.v"))


# ------------------------------------------------------------------ the tree of one shard

def build_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """``(parent, covering radius)`` of every vector (parent -1: the root), and M.
    Radii are angles between the augmented vectors."""
    n = len(vectors)
    square = (vectors * vectors).sum(axis=1)
    top = float(square.max(initial=0.0))
    if not top:
        parent = np.zeros(n, np.int64)
        parent[:1] = -1
        return parent, np.zeros(n), 0.0
    extra = np.sqrt(np.maximum(top - square, 0))
    angle = vectors @ vectors.T
    angle += np.outer(extra, extra)
    angle /= top
    np.clip(angle, -1, 1, out=angle)
    np.arccos(angle, out=angle)
    np.fill_diagonal(angle, 0)
    parent, cover = np.full(n, -1, np.int64), np.zeros(n)
    members = np.arange(1, n)
    cover[0] = angle[0, 1:].max(initial=0)
    todo = [(0, members)]
    while todo:
        node, members = todo.pop()
        while len(members):
            away = angle[node, members]
            radius = away.max() / BASE
            far = members[away > radius] if radius > SLACK else members
            members = members[away <= radius] if radius > SLACK else members[:0]
            while len(far):                       # new children cover what the node does not
                child, far = far[0], far[1:]
                if radius > SLACK:
                    near = angle[child, far] <= radius
                    own, far = far[near], far[~near]
                else:
                    own = far[:0]
                parent[child] = node
                if len(own):
                    cover[child] = angle[child, own].max()
                    todo.append((child, own))
    return parent, cover, float(np.sqrt(top))


class CoverTree:
    """A shard's tree as arrays: ids, labels, integer vectors, parents and radii."""

    def __init__(self, ids, labels, vectors, parent, cover, norm: float):
        self.ids, self.labels, self.norm = ids, labels, norm
        self.vectors = vectors.astype(np.float64)  # integers below 2**53 are exact in doubles
        order = np.argsort(parent, kind="stable")
        starts = np.searchsorted(parent[order], np.arange(len(parent) + 1))
        self.children = [order[a:b] for a, b in zip(starts[:-1], starts[1:])]
        self.inner = np.diff(starts) > 0
        self.root = int(order[0])
        self.cos, self.sin = np.cos(np.minimum(cover + SLACK, np.pi)), np.sin(np.minimum(cover + SLACK, np.pi))

    def search(self, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, low: np.ndarray, high: np.ndarray,
               k: int, same_label: bool) -> tuple[np.ndarray, ...]:
        """``(query number, window, vec_id, score)``: for every query and window
        ``low <= score <= high`` its k best rows of the query's label, or of other labels."""
        n, windows = low.shape
        queries = queries.astype(np.float64)
        reach = np.sqrt((queries * queries).sum(axis=1)) * self.norm
        best = np.full((n, windows, k), -np.inf)
        best_id = np.full((n, windows, k), _NONE, np.int64)
        self.products = 0

        def worth(who, least, most):              # (who, nodes): some window may still gain there
            floor = np.maximum(low[who], best[who, :, -1])[:, None, :]
            return ((most[:, :, None] >= floor) & (least[:, :, None] <= high[who][:, None, :])).any(axis=2)

        def verify(who, nodes):
            score = queries[who] @ self.vectors[nodes].T
            self.products += score.size
            fits = (self.labels[nodes][None, :] == labels[who][:, None]) == same_label
            fits &= self.ids[nodes][None, :] != ids[who][:, None]
            for w in range(windows):
                edge = np.maximum(low[who, w], best[who, w, -1])[:, None]
                hit = fits & (score >= edge) & (score <= high[who, w][:, None])
                rows = np.flatnonzero(hit.any(axis=1))
                if len(rows):
                    at = who[rows]
                    s = np.concatenate([best[at, w], np.where(hit[rows], score[rows], -np.inf)], axis=1)
                    i = np.concatenate([best_id[at, w], np.where(hit[rows], self.ids[nodes], _NONE)], axis=1)
                    order = np.lexsort((i, -s), axis=1)[:, :k]
                    best[at, w], best_id[at, w] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
            return score

        queue: list = []

        def push(who, nodes, score):
            inner = np.flatnonzero(self.inner[nodes])
            if not len(inner):
                return
            nodes = nodes[inner]
            r = reach[who][:, None]
            c = np.clip(np.divide(score[:, inner], r, out=np.zeros((len(who), len(inner))), where=r > 0), -1, 1)
            s = np.sqrt(1 - c * c)
            cos, sin = self.cos[nodes][None, :], self.sin[nodes][None, :]
            most = np.where(c >= cos, 1, c * cos + s * sin) + SLACK
            least = np.where(-c >= cos, -1, c * cos - s * sin) - SLACK
            alive = worth(who, least * r, most * r)
            for j in np.flatnonzero(alive.any(axis=0)):
                a = alive[:, j]
                heapq.heappush(queue, (-float(most[a, j].max()), int(nodes[j]), who[a], least[a, j] * r[a, 0],
                                       most[a, j] * r[a, 0]))

        everyone, root = np.arange(n), np.array([self.root])
        push(everyone, root, verify(everyone, root))
        while queue:
            _, node, who, least, most = heapq.heappop(queue)
            who = who[worth(who, least[:, None], most[:, None])[:, 0]]
            if len(who):
                children = self.children[node]
                push(who, children, verify(who, children))
        q, w, j = np.nonzero(best_id != _NONE)
        return q, w, best_id[q, w, j], best[q, w, j].astype(np.int64)


# ------------------------------------------------------------------ the jobs

def _matrix(column: pa.ChunkedArray, width: int, fill=0) -> np.ndarray:
    """Rows of a list column, padded to ``width``."""
    column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.full((len(lengths), width), fill, values.dtype if len(values) else np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def cover_trees(vectors: DataFrame, width: int, shards: int) -> DataFrame:
    """``(shard, place, parent, cover, norm, vec_id, label, v)``: the nodes of all shards' trees."""

    def build(t: pa.Table) -> pa.Table:
        order = np.argsort(t["vec_id"].to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        parent, cover, norm = build_tree(_matrix(t["v"], width).astype(np.float64))
        n = t.num_rows
        return pa.table({"shard": t["shard"], "place": pa.array(np.arange(n), pa.int32()),
                         "parent": pa.array(parent, pa.int32()), "cover": pa.array(cover),
                         "norm": pa.array(np.full(n, norm)), "vec_id": t["vec_id"], "label": t["label"], "v": t["v"]})

    dealt = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "label", "v")
    return dealt.groupBy("shard").applyInArrow(
        build, "shard int, place int, parent int, cover double, norm double, vec_id bigint, label bigint, v array<bigint>")


def search_trees(trees: DataFrame, anchors: DataFrame, shards: int, width: int, k: int, same_label: bool) -> DataFrame:
    """``(anchor_id, window, vec_id, score)``: the best k of every shard for anchors
    ``(vec_id, label, v, low, high)`` and each of their windows (arrays of equal length)."""
    blocks = max(1, -(-anchors.count() // ANCHORS))
    left = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), "vec_id", "label", "v", "low", "high")
    right = trees.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                         *[c for c in trees.columns if c != "shard"])

    def cell(q: pa.Table, t: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 4
        if q.num_rows and t.num_rows:
            order = np.argsort(t["place"].to_numpy())
            t = t.take(pa.array(order))
            tree = CoverTree(t["vec_id"].to_numpy(), t["label"].to_numpy(), _matrix(t["v"], width),
                             t["parent"].to_numpy().astype(np.int64), t["cover"].to_numpy(), t["norm"][0].as_py())
            windows = pc.max(pc.list_value_length(q["low"])).as_py()
            ids = q["vec_id"].to_numpy()
            who, w, vec, score = tree.search(ids, q["label"].to_numpy(), _matrix(q["v"], width),
                                             _matrix(q["low"].cast(pa.list_(pa.float64())), windows, np.inf),
                                             _matrix(q["high"].cast(pa.list_(pa.float64())), windows, -np.inf), k, same_label)
            found = [ids[who], w, vec, score]
        return pa.table(dict(zip(("anchor_id", "window", "vec_id", "score"), (pa.array(x, pa.int64()) for x in found))))

    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        cell, "anchor_id bigint, window bigint, vec_id bigint, score bigint")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   low_percent: int = 80, high_percent: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of
    ``(vec_id, label, v)``: for each anchor and each of its best rows of the same label, the best
    rows of another label with ``low_percent`` to ``high_percent`` of the positive's score."""
    vectors = cut_lineage(vectors)
    n, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    shards = max(1, -(-n // NODES))
    trees = cut_lineage(cover_trees(vectors, width, shards))
    anchors = vectors.filter(is_anchor)
    everything = F.array(F.lit(float("-inf"))).alias("low"), F.array(F.lit(float("inf"))).alias("high")
    found = search_trees(trees, anchors.select("*", *everything), shards, width, positives, True)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = cut_lineage(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives))
    held = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    # 100 * s >= low * p and 100 * s <= high * p, for whole numbers s
    low = F.transform("p", lambda p: F.ceil(p["score"] * low_percent / F.lit(100.0)).cast("double"))
    high = F.transform("p", lambda p: F.floor(p["score"] * high_percent / F.lit(100.0)).cast("double"))
    asked = anchors.join(held, anchors["vec_id"] == held["anchor_id"])
    mined = search_trees(trees, asked.select("vec_id", "label", "v", low.alias("low"), high.alias("high")),
                         shards, width, negatives, False)
    positive = best.select("anchor_id", (F.col("rank") - 1).cast("bigint").alias("window"),
                           F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    ranked = mined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.join(positive, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
