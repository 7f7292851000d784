"""SimHash near-duplicates by pivot distance tables (13).

1. Fingerprints (one narrow pass over whole texts): XXH64 of every shingle,
   repeats included; a bit is 1 if over half of the hashes have it.
2. Equal fingerprints are put together first: a group of copies is one
   representative (its smallest id) from here on.
3. Pivot table: the Hamming distances of every fingerprint to fixed reference
   fingerprints. ``REFERENCES`` of them are spread over all 64 bits; ``LOCAL``
   lie inside each of four ranges of 16 bits, and their distance less the
   distance to zero is a coordinate that only the bits of that range move.
4. Two fingerprints at distance d differ by at most d in every coordinate, and
   the ranges' differences add up to at most d. With two differing bits
   the coordinates of at least two ranges are therefore equal: six keys, one
   for each two ranges, bring together all pairs that can link. (One pivot's
   band alone has no equality key and keeps a third of all pairs.)
5. Pairs of one key are discarded by the greatest difference of the spread
   coordinates; the survivors are verified by the bit count of the XOR.
6. Connected components of the links.

Hot groups: copies are pre-aggregated; a key that more than ``CROWD`` different
fingerprints have is not paired. Its members list the 65 fingerprints within
one bit of them: two members link exactly if they list a common one, and at
most 65 list the same one, so this stays linear in the crowd, and exact.

Defined cases: null and empty texts and texts without words have fingerprint
zero and link like any other; with fewer words than a shingle the whole
sequence is the only shingle; very long texts are hashed in slices of bounded
memory; rows with a null id get their fingerprint and no component (null) and
are kept; rows that share an id act as one node of every fingerprint they
have; ties cannot occur (a root is the smallest id); other columns are
ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.bbit_minhash import components, normal_words
from tokenmill.llm.common import cut_lineage, map_batches, spread, texts_as_bytes

MAX_BITS = 2
RANGES = 4                  # 2 * MAX_BITS: links keep at least RANGES - MAX_BITS of them
LOCAL, REFERENCES = 16, 16
CROWD = 256                 # fingerprints of one key that are still paired
SEED = 42
SLICE = 1 << 14             # shingles whose bits are unpacked at once


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _references() -> tuple[list[list[int]], list[int]]:
    """Reference fingerprints inside each range, and over all bits (fixed seed)."""
    rng = np.random.default_rng(64)
    width = 64 // RANGES
    local = [[_signed(int(rng.integers(1, 1 << width)) << (width * r)) for _ in range(LOCAL)] for r in range(RANGES)]
    return local, [int(rng.integers(-(1 << 63), (1 << 63) - 1)) for _ in range(REFERENCES)]


LOCAL_PIVOTS, SPREAD_PIVOTS = _references()


def fingerprint(text: bytes, width: int = 3, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text, unsigned."""
    words = normal_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    take = min(width, len(words))
    n = len(words) - take + 1
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        to = min(n, at + SLICE)
        h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(
            starts[at:to].tolist(), ends[at + take - 1:to + take - 1].tolist())), ">u8", to - at)
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``: the fingerprint as a signed 64-bit integer."""

    def run(b: pa.RecordBatch) -> dict:
        return {"doc_id": b.column(0),
                "fp": pa.array([_signed(fingerprint(t, width)) for t in texts_as_bytes(b.column(1))], pa.int64())}

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(spread(d), run, "doc_id bigint, fp bigint")


def pivot_table(groups: DataFrame) -> DataFrame:
    """``(rep, fp, local, far)`` of fingerprints ``(rep, fp)``: coordinates by range, and
    distances to the spread references."""
    fp = F.col("fp")

    def distance(pivot: int) -> Column:
        return F.bit_count(fp.bitwiseXOR(F.lit(pivot).cast("bigint")))

    local = F.array(*[F.array(*[(distance(p) - F.bit_count(fp)).cast("tinyint") for p in pivots])
                      for pivots in LOCAL_PIVOTS])
    far = F.array(*[distance(p).cast("tinyint") for p in SPREAD_PIVOTS])
    return groups.select("rep", "fp", local.alias("local"), far.alias("far"))


def links(groups: DataFrame) -> DataFrame:
    """``(a, b)`` of representatives of distinct fingerprints ``(rep, fp)`` that are at
    most MAX_BITS apart; members of crowds are tied to the smallest that shares a
    neighbouring fingerprint, which leaves the components as they are."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.lit(j), F.col("local")[i], F.col("local")[j])
                     for i, j in combinations(range(RANGES), RANGES - MAX_BITS)])
    rows = cut_lineage(pivot_table(groups).select("rep", "fp", "far", F.explode(keys).alias("key")))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = cut_lineage(rows.join(sizes, "key"))
    few = met.filter(F.col("n") <= CROWD)
    one = few.select("key", F.col("rep").alias("a"), F.col("fp").alias("fa"), F.col("far").alias("ca"))
    two = few.select("key", F.col("rep").alias("b"), F.col("fp").alias("fb"), F.col("far").alias("cb"))
    near = reduce(lambda x, y: x & y, [F.abs(F.col("ca")[i] - F.col("cb")[i]) <= MAX_BITS for i in range(REFERENCES)])
    alike = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= MAX_BITS
    # a representative can stand for several fingerprints only if rows share its id
    pairs = one.join(two, (one["key"] == two["key"]) & (F.col("fa") < F.col("fb")) & near & alike).select("a", "b")

    crowd = met.filter(F.col("n") > CROWD).select("rep", "fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << k)).cast("bigint")) for k in range(64)])
    cells = crowd.select("rep", F.explode(flips).alias("cell"))
    # at most 65 fingerprints have one in their neighbourhood
    shared = cells.groupBy("cell").agg(F.min("rep").alias("a"), F.collect_set("rep").alias("all")).filter(F.size("all") > 1)
    tied = shared.select("a", F.explode("all").alias("b"))
    return pairs.unionByName(tied).filter("a != b").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id, kept)``, one row per input row."""
    found = cut_lineage(fingerprints(docs, width, id_col, text_col))
    groups = cut_lineage(found.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("rep")))
    edges = links(groups)
    # rows that share an id tie their fingerprints together
    several = found.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low != high").select("doc_id")
    same = found.join(several, "doc_id").distinct().join(groups, "fp").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = components(edges.unionByName(same))
    owner = groups.join(roots, groups["rep"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "rep").alias("root"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("root"))
    return found.join(owner, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
