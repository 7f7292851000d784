"""b-bit MinHash near-duplicates (3).

1. Signatures (one narrow pass over whole texts): the set of word shingles of
   a text, its minima under ``BANDS * ROWS`` hash functions, a key per band
   of minima, and the packed low ``BITS`` bits of every minimum.
2. Texts with one and the same set are put together first; a group of exact
   copies is one representative from here on.
3. Candidates: representatives that share a band key. In each bucket every
   member is paired with the bucket's smallest id, never all with all.
4. Pairs are dropped when the sizes of their sets rule the similarity out, or
   when the similarity estimated from the packed bits (XOR and bit count,
   corrected for chance agreement of ``BITS`` bits) lies ``SLACK`` below the
   threshold, over five standard deviations. A second exact bound comes with
   it: the XOR of two parity maps shows a least number of shingles that only
   one of the sets has.
5. What is left is confirmed on the full shingle sets of the two texts.
6. Connected components of the confirmed links (Spark rounds, checkpointed).
   Two more rounds of candidates cover what the stars of step 3 did not, in
   buckets whose members ended in several components: first every member
   outside the bucket's largest component is paired with one of its members,
   another one in each bucket; then every member still outside with all
   members of other components. Members of one component need no further
   links.

A pair at similarity 0.8 shares no band with probability
``(1 - 0.8 ** ROWS) ** BANDS`` < 4e-6, and its estimate is too low with the
probability that 47 or more of HASHES groups differ, at 0.15 each: 2.8e-6
(binomial). Nothing else loses a link.

Hot groups: exact copies are pre-aggregated, bucket members meet in joins
that adaptive execution can split, no group is collected.

Defined cases: null or empty texts and texts without words have an empty set
and link with nothing; rows with a null id get their counts, no component
(null) and stay; rows that share an id act as one node; with fewer words than
a shingle the whole word sequence is the only shingle; a very long text is one
sorted array of hashes and, where it is confirmed, one set of shingles; equal
sets are one representative, so ties have no effect; other columns are
ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import cut_lineage, free_name, map_batches, spread, texts_as_bytes

ROWS, BANDS, BITS = 5, 32, 2
PARITY = 512                # parity bits of a set
HASHES = ROWS * BANDS
SLACK = 0.19
CACHE_WORDS = 60_000        # per worker
_U = np.uint64
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_MULTIPLIERS = _mix(np.arange(1, HASHES + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
_PLACES = _mix(np.arange(101, 101 + 64, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = normal_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    take = min(width, len(h))
    x = np.full(n, take, np.uint64)
    for j in range(take):
        x = (x ^ h[j:j + n]) * _PLACES[j % 64]
        x ^= x >> _U(31)
    return np.unique(_mix(x))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(non-empty sets, HASHES) array of 32-bit minima."""
    out = np.empty((len(sets), HASHES), np.uint32)
    at = 0
    while at < len(sets):                         # slices that stay in the processor's cache
        to, size = at, 0
        while to < len(sets) and (to == at or size + len(sets[to]) <= 32_768):
            size += len(sets[to])
            to += 1
        flat = np.concatenate(sets[at:to])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:to]])[:-1]])
        for k in range(HASHES):
            out[at:to, k] = np.minimum.reduceat(flat * _MULTIPLIERS[k], starts) >> _U(32)
        at = to
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys; a key also tells its band."""
    parts = m.reshape(len(m), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(m), BANDS)).copy()
    for r in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def pack_bits(m: np.ndarray) -> np.ndarray:
    """Low BITS bits of every minimum, packed into 64-bit words."""
    per = 64 // BITS
    words = -(-HASHES // per)
    low = np.zeros((len(m), words * per), np.uint64)
    low[:, :HASHES] = m & ((1 << BITS) - 1)
    low = low.reshape(len(m), words, per) << (np.arange(per, dtype=np.uint64) * _U(BITS))
    return np.bitwise_or.reduce(low, axis=2).view(np.int64)


def pack_parity(s: np.ndarray) -> np.ndarray:
    """One bit per hash bucket, set if an odd number of the set's hashes fall into it."""
    odd = np.bincount((s >> _U(64 - PARITY.bit_length() + 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def signatures(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, f1, f2, sig, bands)``; f1 and f2 identify the set, sig
    holds the packed minima and then the parity bits."""

    def run(b: pa.RecordBatch) -> dict:
        if len(_hashes) > CACHE_WORDS:
            _hashes.clear()
        sets = [shingle_hashes(t, width) for t in texts_as_bytes(b.column(1))]
        full = [i for i, s in enumerate(sets) if len(s)]
        sig: list = [None] * len(sets)
        bands: list = [None] * len(sets)
        f = np.zeros((len(sets), 2), np.int64)
        if full:
            m = minima([sets[i] for i in full])
            for i, s, k in zip(full, pack_bits(m), band_keys(m)):
                sig[i], bands[i] = np.concatenate([s, pack_parity(sets[i])]), k
                f[i] = np.frombuffer(xxhash.xxh3_128_digest(sets[i].tobytes()), np.int64)
        return {"doc_id": b.column(0), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "f1": pa.array(f[:, 0]), "f2": pa.array(f[:, 1]),
                "sig": pa.array(sig, pa.list_(pa.int64())), "bands": pa.array(bands, pa.list_(pa.int64()))}

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(spread(d), run, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, "
                                       "sig array<bigint>, bands array<bigint>")


SIGNATURE_WORDS = -(-HASHES // (64 // BITS))


def least_difference(a: Column, b: Column) -> Column:
    """A lower bound of the number of shingles that only one of two sets has: common
    shingles cancel out of the XOR of the parity bits, every other one flips one bit."""
    n = F.lit(0)
    for w in range(SIGNATURE_WORDS, SIGNATURE_WORDS + PARITY // 64):
        n = n + F.bit_count(a[w].bitwiseXOR(b[w]))
    return n


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed bits: share of equal BITS-bit groups, corrected for chance."""
    words = SIGNATURE_WORDS
    ones = sum(1 << (BITS * i) for i in range(64 // BITS))
    ones -= (1 << 64) if ones >> 63 else 0
    differ = None
    for w in range(words):
        x = a[w].bitwiseXOR(b[w])
        spread_bits = x
        for k in range(1, BITS):
            spread_bits = spread_bits.bitwiseOR(F.shiftrightunsigned(x, k))
        n = F.bit_count(spread_bits.bitwiseAND(F.lit(ones).cast("bigint")))
        differ = n if differ is None else differ + n
    chance = 0.5 ** BITS
    return ((F.lit(1.0) - differ / F.lit(float(HASHES))) - F.lit(chance)) / F.lit(1 - chance)


def shingle_set(text: bytes, width: int) -> set:
    words = normal_words(text)
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(width))))


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets have ``percent`` similarity or more."""
    both = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
            .select("a", "b", "ta", "tb"))

    def run(b: pa.RecordBatch) -> dict:
        last: tuple[bytes | None, set] = (None, set())
        ok = []
        for x, y in zip(texts_as_bytes(b.column(2)), texts_as_bytes(b.column(3))):
            if y != last[0]:
                last = (y, shingle_set(y, width))
            one, two = shingle_set(x, width), last[1]
            same = len(one & two)
            ok.append(bool(one) and 100 * same >= percent * (len(one) + len(two) - same))
        mask = pa.array(ok, pa.bool_())
        return {"a": b.column(0).filter(mask), "b": b.column(1).filter(mask)}

    return map_batches(both, run, "a bigint, b bigint")


TASK_EDGES = 100_000        # edges that one task of a component round takes at least, if there are as many


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``(a, b)`` edges; root is the smallest
    node that can be reached. Alternating large-star and small-star rounds:
    each node's neighbours are tied to the smallest of them until every
    component is a star around its root. Tasks follow the number of edges, so a few
    edges do not leave a file in every partition of every round."""
    edges = cut_lineage(_oriented(edges))
    while True:
        mark = _fingerprint(edges)
        if not mark[0]:
            break
        tasks = -(-mark[0] // TASK_EDGES)
        edges = _few(edges, tasks)
        for larger in (True, False):
            if larger:
                near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            else:
                near = edges
            low = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
            tied = near.join(low, "a")
            if larger:
                edges = tied.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            else:
                edges = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                    low.select("a", F.col("m").alias("b")))
            edges = _oriented(_few(edges, tasks))
        edges = cut_lineage(_few(edges, tasks))
        if _fingerprint(edges) == mark:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _few(df: DataFrame, tasks: int) -> DataFrame:
    """The rows in at most so many tasks; more than a thousand are left to Spark."""
    return df.coalesce(tasks) if tasks < 1000 else df


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.filter(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row."""
    sigs = cut_lineage(signatures(docs, width, id_col, text_col))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    named = sigs.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    sets = cut_lineage(named.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    reps = named.join(sets.select(F.col("rep").alias("doc_id"), F.col("f1").alias("g1"), F.col("f2").alias("g2")),
                      "doc_id").filter((F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")))
    traits = reps.select(F.col("doc_id").alias("id"), "n_shingles", "sig")
    rows = reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    buckets = (rows.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1"))
    members = cut_lineage(rows.join(buckets, "key").filter(F.col("id") != F.col("first")))

    sa, sb = F.col("sa"), F.col("sb")
    # similarity s or more means a difference of at most (1 - s) / (1 + s) of both sizes together
    plausible = ((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                 & (estimate(sa, sb) >= percent / 100 - SLACK)
                 & (least_difference(sa, sb) * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))))
    one = traits.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    two = traits.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))
    pairs = members.select(F.col("id").alias("a"), F.col("first").alias("b")).distinct()
    tried = cut_lineage(pairs.join(one, "a").join(two, "b").filter(plausible).select("a", "b"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
        return cut_lineage(confirm(pairs, texts.join(wanted, "doc_id", "left_semi"), width, percent))

    links = confirmed(tried)
    roots = components(links)
    # buckets of three or more, whose members may still be in several components
    crowd = members.filter("n > 2").select("key", "id").unionByName(
        members.filter("n > 2").select("key", F.col("first").alias("id")).distinct())
    crowd = cut_lineage(crowd.join(traits, "id"))
    for all_pairs in (False, True):
        placed = crowd.join(roots, crowd["id"] == roots["node"], "left").select(
            "key", "id", "n_shingles", "sig", F.coalesce("root", "id").alias("root"))
        sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
        home = sizes.groupBy("key").agg(F.max(F.struct("c", "root")).alias("h"), F.count(F.lit(1)).alias("parts")) \
            .filter("parts > 1").select("key", F.col("h.root").alias("home"))
        placed = cut_lineage(placed.join(home, "key"))
        outside = placed.filter("root != home").select(
            "key", F.col("id").alias("x"), F.col("root").alias("rx"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
        if all_pairs:      # every member outside the bucket's main component with all of other components
            inside = placed.select("key", F.col("id").alias("y"), F.col("root").alias("ry"), F.col("n_shingles").alias("nb"),
                                   F.col("sig").alias("sb"))
        else:              # with one member of the main component, another one in every bucket
            pick = F.min(F.struct(F.xxhash64("key", "id").alias("h"), "id", "root", "n_shingles", "sig")).alias("p")
            inside = placed.filter("root = home").groupBy("key").agg(pick).select(
                "key", F.col("p.id").alias("y"), F.col("p.root").alias("ry"), F.col("p.n_shingles").alias("nb"),
                F.col("p.sig").alias("sb"))
        fresh = outside.join(inside, (outside["key"] == inside["key"]) & (F.col("rx") != F.col("ry")) & plausible) \
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
        fresh = cut_lineage(fresh.join(tried, ["a", "b"], "left_anti"))
        if fresh.take(1):
            tried = tried.unionByName(fresh)
            more = confirmed(fresh)
            if more.take(1):
                links = links.unionByName(more)
                roots = components(links)
    owner = (sets.join(roots, sets["rep"] == roots["node"], "left")
             .select("f1", "f2", F.coalesce("root", "rep").alias("component_id")))
    out = sigs.select("doc_id", "n_shingles", "f1", "f2").join(owner, ["f1", "f2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))) \
        .otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Pipeline form: one document of each group stays, with all its columns.
    Rows that share the id of a kept document are kept with it."""
    name = free_name(docs.columns, "gone")
    gone = near_duplicates(docs, width, percent).filter(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone[name], "left_anti")
