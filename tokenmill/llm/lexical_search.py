"""Ranked lexical search by pair-bound MaxScore (12).

1. One narrow pass over whole texts: terms are runs of ASCII letters and digits
   and of all characters beyond ASCII. Of each document its number of terms
   and the frequencies of the items' terms are written to the shared folder.
2. Spark counts documents, terms and document frequencies over all documents;
   from them follow every term's weight and a document's impact for a term.
3. Documents are indexed in blocks of at most ``BLOCK`` where they lie, without
   a shuffle: posting lists by term with their greatest impact, and, for terms
   that stand next to each other in an item's order of weights, the
   intersection of both lists with its greatest joint impact.
4. An item's terms are ordered by weight. A document that has only the first j
   of them scores at most ``bound[j]``, the least sum that covers these terms by
   single maxima and by pair bounds (a pair's bound is its joint maximum,
   or the greater single one). Lists whose bound stays below the item's
   k-th best score so far are not opened; documents of the other lists are
   completed by look-ups from the heaviest list down and left as soon as their
   score and the remaining bound stay below it.
5. Scores are exact integers. Each task holds the k best of every item over all
   its blocks; Spark ranks what the tasks found.

Memory: a block's postings and items * k rows a task. Items go in blocks of
``ITEM_BYTES`` of text, each with its own broadcast vocabulary, so neither grows
with the items. Frequent terms are array entries of documents, never a group.

Defined cases: null and empty texts have no terms and count nowhere; documents
with a null id count in the statistics and are not returned; rows that share an
id are documents of their own, and so are items (repeated item rows, equal in id and
text, count once; items with a null id are left out); equal scores go to the
smaller id; an item without known terms gives no rows; a very long text is one
document, with at most the vocabulary as its entries; other columns are
ignored, whatever their names; empty tables give an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.llm.common import cut_lineage, map_batches, spread, texts_as_bytes

BLOCK = 8192                # documents indexed together
BLOCK_POSTINGS = 1 << 21    # or as many postings
ITEM_BYTES = 8 << 20
_SPACE, _CASE = 0x20, 0x20
_TERM_BYTES = bytes(b + _CASE if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else _SPACE for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def document_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(doc_id, n, terms ARRAY<INT>, tfs ARRAY<INT>)``: number of terms, and the frequencies
    of those in the vocabulary."""
    bc = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(b: pa.RecordBatch) -> dict:
        find = bc.value.get
        n, lengths, terms, tfs = [], [0], [], []
        for text in texts_as_bytes(b.column(1)):
            words = terms_of(text)
            n.append(len(words))
            own, count = np.unique(np.array([v for v in map(find, words) if v is not None], np.int32), return_counts=True)
            terms.append(own)
            tfs.append(count.astype(np.int32))
            lengths.append(lengths[-1] + len(own))
        offsets = pa.array(lengths, pa.int32())
        return {"doc_id": b.column(0), "n": pa.array(n, pa.int64()),
                "terms": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(terms))),
                "tfs": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tfs)))}

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(spread(d), run, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def corpus_statistics(tokens: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and document frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(b.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["term", "df"])

    n, total = tokens.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for r in tokens.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return n, total, df


def term_weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def item_plans(items: list[tuple], vocabulary: dict[bytes, int], weights: np.ndarray) -> tuple[list, list]:
    """``(item_id, terms by ascending weight)`` of all items, and the neighbouring pairs."""
    plans, pairs = [], set()
    for item_id, words in items:
        t = sorted({vocabulary[w] for w in words}, key=lambda x: (int(weights[x]), x))
        t = [x for x in t if weights[x] > 0]
        plans.append((item_id, t))
        pairs |= {(min(x, y), max(x, y)) for x, y in zip(t, t[1:])}
    return plans, sorted(pairs)


class BlockIndex:
    """Posting lists of a block of documents, their maxima and joint maxima of pairs."""

    def __init__(self, corpus: SimpleNamespace, doc_ids, n, counts, terms, tfs):
        self.ids = doc_ids
        size = len(doc_ids)
        m = 50 + (50 * n * corpus.documents) // max(corpus.terms, 1)
        doc = np.repeat(np.arange(size), counts)
        tf = tfs.astype(np.int64)
        impact = corpus.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        use = np.flatnonzero(impact > 0)
        use = use[np.argsort(terms[use], kind="stable")]
        self.doc, self.impact = doc[use], impact[use]
        self.starts = np.searchsorted(terms[use], np.arange(len(corpus.weights) + 1))
        self.highest = np.zeros(len(corpus.weights), np.int64)
        some = np.flatnonzero(np.diff(self.starts))
        if len(some):
            self.highest[some] = np.maximum.reduceat(self.impact, self.starts[some])
        self.joint: dict[tuple[int, int], int] = {}
        at, held = np.zeros(size, np.int64), None
        for x, y in corpus.pairs:                 # ordered by x
            if self.highest[x] and self.highest[y]:
                if held != x:
                    if held is not None:
                        at[self.postings(held)[0]] = 0
                    docs, impacts = self.postings(x)
                    at[docs], held = impacts, x
                docs, impacts = self.postings(y)
                other = at[docs]
                self.joint[x, y] = int(np.max(other + impacts, where=other > 0, initial=0))
        self.score = np.zeros(size, np.int64)
        self.looked_up = 0

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[term], self.starts[term + 1]
        return self.doc[a:b], self.impact[a:b]

    def bounds(self, terms: list[int]) -> list[int]:
        """``bound[j]``: the most that the first j terms can give to one document."""
        out = [0]
        for j, t in enumerate(terms):
            top = int(self.highest[t])
            low = out[-1] + top
            if j:
                u = terms[j - 1]
                pair = max(self.joint.get((min(t, u), max(t, u)), 0), top, int(self.highest[u]))
                low = min(low, out[j - 1] + pair)
            out.append(low)
        return out

    def search(self, terms: list[int], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """``(doc ids, scores)`` of all documents that can be among the k best with ``least`` or more."""
        least = max(least, 1)
        bound = self.bounds(terms)
        split = len(terms)
        while split and bound[split] >= least:
            split -= 1
        score = self.score
        for t in terms[split:]:
            docs, impacts = self.postings(t)
            score[docs] += impacts
            self.looked_up += len(docs)
        found = np.flatnonzero(score)
        total = score[found]
        score[found] = 0
        for j in range(split - 1, -1, -1):
            if len(total) >= k:
                least = max(least, int(np.partition(total, len(total) - k)[-k]))
            stay = total + bound[j + 1] >= least
            found, total = found[stay], total[stay]
            docs, impacts = self.postings(terms[j])
            if len(found) and len(docs):
                place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                total = total + np.where(docs[place] == found, impacts[place], 0)
                self.looked_up += len(found)
        stay = total >= least
        return self.ids[found[stay]], total[stay]


def _searcher(bc, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = bc.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(corpus.plans)
        held, docs, postings = [], 0, 0

        def search_block() -> None:
            index = BlockIndex(corpus, *(np.concatenate(c) for c in zip(*held)))
            for i, (_, terms) in enumerate(corpus.plans):
                ids, scores = best[i]
                least = int(scores[-1]) if len(scores) == k else 0
                new, total = index.search(terms, k, least)
                if len(new):
                    ids, scores = np.concatenate([ids, new]), np.concatenate([scores, total])
                    order = np.lexsort((ids, -scores))[:k]
                    best[i] = ids[order], scores[order]

        for b in batches:
            counts = np.diff(b.column(2).offsets.to_numpy())
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy(), counts,
                         b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()))
            docs, postings = docs + b.num_rows, postings + int(counts.sum())
            if docs >= BLOCK or postings >= BLOCK_POSTINGS:
                search_block()
                held, docs, postings = [], 0, 0
        if held:
            search_block()
        for i, (item_id, _) in enumerate(corpus.plans):
            ids, scores = best[i]
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), i, np.int32)), pa.array(np.full(len(ids), item_id, np.int64)), pa.array(ids),
                     pa.array(scores)], names=["item", "item_id", "doc_id", "score"])
    return run


def _rank_block(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in items for w in words}))}
    tokens = cut_lineage(document_terms(docs, vocabulary))
    n, total, df = corpus_statistics(tokens, max(len(vocabulary), 1))
    weights = term_weights(n, df)
    plans, pairs = item_plans(items, vocabulary, weights)
    bc = spark.sparkContext.broadcast(SimpleNamespace(documents=n, terms=total, weights=weights, plans=plans, pairs=pairs))
    found = tokens.filter("doc_id is not null and size(terms) > 0").mapInArrow(
        _searcher(bc, k), "item int, item_id bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, item_col: str = "item_id",
                   text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents ``(doc_id, text)`` of every item."""
    rows = items.select(F.col(item_col).cast("bigint").alias("item_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter("item_id is not null").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-size // ITEM_BYTES))
    out = []
    for block in range(blocks):
        mine = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        out.append(_rank_block(docs, [(r["item_id"], set(terms_of(r["text"].encode()))) for r in mine], k))
    return reduce(DataFrame.unionByName, out)
