"""Suffix-array dedup (9): passages of ``LENGTH`` bytes or more that occur again.

A window is a ``LENGTH``-byte string starting at some byte. A global suffix
array would sort every byte of the corpus; here suffixes are first dealt to
groups that can hold equal windows, and each group is sorted by itself.

1. Anchors. Of the ``GRAM``-byte substrings of a window the one with the
   smallest hash (leftmost on ties) is its anchor, so equal windows have equal
   anchors at equal places. Consecutive windows with one anchor form a block;
   a block row is an anchor hash, a 128-bit block hash and a place, about one
   row in 170 bytes. A block hash that occurs twice settles all its windows.
2. Anchors that several different blocks share are the edges of repeated
   passages. One copy of each such block is fetched (text joined once by
   document id) and the blocks of an anchor meet in one group.
3. In a group of at most ``GROUP`` blocks: suffix array by prefix doubling to
   depth ``LENGTH`` and what neighbours in it share; from the previous and the
   next smaller position in suffix order follows the longest-previous-factor
   array, and a window whose factor is ``LENGTH`` bytes or longer has an earlier match.
   Positions counted from the end give the longest next factor, the later matches.
4. An anchor with more blocks (a passage that a large part of all documents
   share, in ever new surroundings) is not gathered: runs of its windows, then
   single windows of the runs that this leaves open, are rows with 128-bit
   hashes, matched by grouped counts. That is exact as well, grows in
   proportion to the text concerned, and splits over any number of tasks.
5. Matched windows become byte spans per document and are cut out.

``keep="first"`` removes later copies and keeps the first (order: document
id, then place); ``keep="none"`` removes every copy.

Defined cases: null or empty texts have no bytes and lose none; bytes are cut
wherever the windows end, so a text may lose part of a character (then
decoding drops it in the pipeline form); very long texts are hashed in slices
of ``SLICE`` bytes; rows with a null id take no part
and are returned whole; rows that share an id are copies of each other, and
one document for ``keep="first"``; equal windows of one document are ranked by
place; other columns are ignored or, in the pipeline form, untouched, whatever
their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import cut_lineage, free_name, map_batches, spread, texts_as_bytes

LENGTH = 400
GRAM = 64
GROUP = 200                 # blocks of one anchor that are sorted together
STEP = 16                   # windows in a run, where blocks are too many for that
SLICE = 1 << 17             # bytes hashed at once
GROUP_BYTES = 1 << 18       # bytes of small groups that are sorted together
_U = np.uint64
_PLACE = (1 << 24) - 1      # low bits of a sort key that hold a place within a slice


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and their inverses."""
    if len(_powers.get("up", ())) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:n], _powers["down"][:n]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM-byte substring at every place, from one running sum."""
    up, down = _power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)])
    return _mix((sums[GRAM:] - sums[:-GRAM]) * down[:len(data) - GRAM + 1])


def window_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window start of the data: the place of its anchor; and all gram hashes."""
    h = gram_hashes(data)
    width = length - GRAM + 1                     # grams in a window
    key = (h & ~_U(_PLACE)) | np.arange(len(h), dtype=np.uint64)
    rows = -(-len(key) // width)
    padded = np.full(rows * width, ~_U(0), np.uint64)
    padded[:len(key)] = key
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - length + 1
    low = np.minimum(back[:n], ahead[width - 1:width - 1 + n])
    return (low & _U(_PLACE)).astype(np.int64), h


def slices(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """``(text's number, offset, bytes)`` parts, gathered to about SLICE bytes; long
    texts are cut so that every window is in exactly one part."""
    batch, size = [], 0
    for row, t in enumerate(texts):
        for at in range(0, len(t) - length + 1, SLICE):
            part = t[at:at + SLICE + length - 1]
            if size and size + len(part) > SLICE + length:
                yield batch
                batch, size = [], 0
            batch.append((row, at, part))
            size += len(part)
    if batch:
        yield batch


def block_rows(ids: list[int], texts: list[bytes], length: int) -> dict[str, list]:
    """Blocks of the texts of these ids, see the module's text. ``n`` counts a block's
    occurrences in its document; those after the first are spans (``n`` 0)
    that repeat an earlier place of the same document."""
    out: dict[str, list] = {k: [] for k in ("doc_id", "anchor", "b1", "b2", "s", "e", "n")}
    seen: dict[tuple[int, bytes], int] = {}
    for parts in slices(texts, length):
        joined = b"".join(p for _, _, p in parts)
        data = np.frombuffer(joined, np.uint8)
        places, hashes = window_anchors(data, length)
        at = 0
        for text, offset, part in parts:
            doc = ids[text]
            own = places[at:at + len(part) - length + 1]
            cut = np.flatnonzero(own[1:] != own[:-1]) + 1
            first = np.concatenate([[0], cut])
            last = np.concatenate([cut - 1, [len(own) - 1]])
            anchors = hashes[own[first]].view(np.int64).tolist()
            for anchor, s, e in zip(anchors, first.tolist(), last.tolist()):
                digest = xxhash.xxh3_128_digest(joined[at + s:at + e + length])
                row = seen.get((text, digest))
                if row is None:
                    seen[text, digest] = len(out["n"])
                    out["anchor"].append(anchor)
                    out["b1"].append(int.from_bytes(digest[:8], "little", signed=True))
                    out["b2"].append(int.from_bytes(digest[8:], "little", signed=True))
                    out["n"].append(1)
                else:
                    out["n"][row] += 1
                    if out["n"][-1] == 0 and out["doc_id"][-1] == doc and out["e"][-1] + length >= offset + s:
                        out["e"][-1] = offset + e     # touches the span before it
                        continue
                    for c in ("anchor", "b1", "b2"):
                        out[c].append(0)
                    out["n"].append(0)
                out["doc_id"].append(doc)
                out["s"].append(offset + s)
                out["e"].append(offset + e)
            at += len(part)
    return out


# ------------------------------------------------------------------ 3: one group's suffixes

def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].ravel()


def prefix_ranks(data: np.ndarray, depth: int) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Prefix doubling: for widths 8, 16, ... up to ``depth`` the rank of the string of
    that width at every place, and the rank of the ``depth``-byte string."""
    padded = np.concatenate([data, np.zeros(2 * depth, np.uint8)])
    n = len(data)
    key = np.zeros(n + depth, np.uint64)
    for j in range(8):
        key = (key << _U(8)) | padded[j:j + n + depth]
    rank, width = _ranks(key), 8
    tables = {8: rank}
    while 2 * width <= depth:
        m = len(rank) - width
        rank = _ranks(rank[:m] * np.int64(len(rank) + 1) + rank[width:])
        width *= 2
        tables[width] = rank
    if width < depth:
        m = len(rank) - (depth - width)
        rank = _ranks(rank[:m] * np.int64(len(rank) + 1) + rank[depth - width:depth - width + m])
    return tables, rank


def shared_bytes(tables: dict[int, np.ndarray], one: np.ndarray, two: np.ndarray, depth: int) -> np.ndarray:
    """How many bytes the suffixes at two places share, up to ``depth``, in steps of 8."""
    same = np.zeros(len(one), np.int64)
    for width in sorted(tables, reverse=True):
        at = np.flatnonzero(same + width <= depth)
        equal = tables[width][one[at] + same[at]] == tables[width][two[at] + same[at]]
        same[at[equal]] += width
    return same


def _before_in_order(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For every suffix, in suffix order: what it shares with the nearest one before it
    in that order that has a smaller position. ``common[i]`` is what suffix i shares
    with suffix i - 1; links jump over suffixes known to have greater positions."""
    link, share = np.arange(len(position)) - 1, common.copy()
    todo = np.flatnonzero(link >= 0)
    todo = todo[position[link[todo]] > position[todo]]
    while len(todo):
        over = link[todo]
        share[todo], link[todo] = np.minimum(share[todo], share[over]), link[over]
        todo = todo[(link[todo] >= 0) & (share[todo] > 0)]
        todo = todo[position[link[todo]] > position[todo]]
    return np.where(link >= 0, share, 0)


def longest_previous_factor(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The longest previous factor of every suffix, in suffix order: the greater of
    what it shares with the previous and with the next smaller position."""
    back = np.concatenate([common[:1], common[1:][::-1]])
    return np.maximum(_before_in_order(position, common), _before_in_order(position[::-1], back)[::-1])


def matched_windows(blocks: list[tuple[int, int, bytes]], length: int,
                    keep: str = "none") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For blocks ``(doc, place, bytes)``: documents and places of all their windows,
    and which of them have an earlier match or, for ``keep="none"``, any."""
    data = np.frombuffer(b"".join(b for _, _, b in blocks), np.uint8)
    docs, places, starts, at = [], [], [], 0
    for doc, s, b in blocks:
        k = len(b) - length + 1
        docs.append(np.full(k, doc, np.int64))
        places.append(np.arange(s, s + k))
        starts.append(np.arange(at, at + k))
        at += len(b)
    doc, place, start = np.concatenate(docs), np.concatenate(places), np.concatenate(starts)
    tables, full = prefix_ranks(data, length)
    rank = full[start]
    position = np.empty(len(start), np.int64)
    position[np.lexsort((place, doc))] = np.arange(len(start))
    order = np.lexsort((position, rank))          # suffix order to depth ``length``
    common = np.zeros(len(order), np.int64)
    equal = rank[order[1:]] == rank[order[:-1]]
    near = shared_bytes(tables, start[order[:-1]], start[order[1:]], length)
    common[1:] = np.where(equal, length, np.minimum(near, length - 1))
    hit = np.zeros(len(order), bool)
    hit[order] = longest_previous_factor(position[order], common) >= length
    if keep == "none":                            # the same from the last position down: later matches
        hit[order] |= longest_previous_factor(-position[order], common) >= length
    return doc, place, hit


def spans_of(doc: np.ndarray, place: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """Byte spans ``(doc, from, to)`` covered by windows given in ascending order per document."""
    if not len(doc):
        return
    cut = np.flatnonzero((doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)) + 1
    for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(doc)]])):
        yield int(doc[a]), int(place[a]), int(place[b - 1]) + length


def _group_matcher(length: int, keep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], bytes] = {}    # rows that share an id fetch a block twice
        size, last = 0, None

        def flush() -> pa.RecordBatch:
            doc, place, hit = matched_windows([(d, s, x) for (d, s), x in held.items()], length, keep)
            found = list(spans_of(doc[hit], place[hit], length))
            cols = list(zip(*found)) if found else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=["doc_id", "f", "t"])

        for b in batches:
            for anchor, doc, s, block in zip(*(b.column(i).to_pylist() for i in range(4))):
                if size > GROUP_BYTES and anchor != last:
                    yield flush()
                    held, size = {}, 0
                held[doc, s] = block
                size += len(block)
                last = anchor
        if held:
            yield flush()
    return run


# ------------------------------------------------------------------ the jobs

def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "first", id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(doc_id, spans ARRAY<STRUCT<f, t>>)``: byte ranges to remove (they may overlap)."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep must be 'first' or 'none', not {keep!r}")
    texts = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
             .filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)))

    def find(b: pa.RecordBatch) -> dict:
        return block_rows(b.column(0).to_pylist(), texts_as_bytes(b.column(1)), length)

    rows = cut_lineage(map_batches(spread(texts), find, "doc_id bigint, anchor bigint, b1 bigint, b2 bigint, "
                                                        "s bigint, e bigint, n bigint"))
    inner = rows.filter("n = 0").select("doc_id", F.col("s").alias("f"), (F.col("e") + length).alias("t"))
    rows = rows.filter("n > 0")
    blocks = rows.groupBy("anchor", "b1", "b2").agg(F.sum("n").alias("copies"), F.min("doc_id").alias("first"))
    kinds = blocks.groupBy("anchor").agg(F.count(F.lit(1)).alias("blocks"), F.sum("copies").alias("all"))
    # rows of anchors that occur once are most of the corpus; they end here
    shared = rows.join(kinds.filter("all > 1").select("anchor", "blocks"), "anchor")
    shared = cut_lineage(shared.join(blocks, ["anchor", "b1", "b2"]))
    whole = shared.filter("copies > 1" if keep == "none" else "copies > 1 and doc_id != first").select(
        "doc_id", F.col("s").alias("f"), (F.col("e") + length).alias("t"))

    # one copy of each block of anchors with several
    edge = shared.filter("blocks > 1 and doc_id = first").dropDuplicates(["anchor", "b1", "b2"])
    asked = edge.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "s", "e", "blocks")).alias("asked"))

    def fetch(b: pa.RecordBatch) -> dict:
        out = defaultdict(list)
        for doc, text, ask in zip(b.column(0).to_pylist(), texts_as_bytes(b.column(1)), b.column(2).to_pylist()):
            for a in ask:
                out["anchor"].append(a["anchor"])
                out["doc_id"].append(doc)
                out["s"].append(a["s"])
                out["block"].append(text[a["s"]:a["e"] + length])
                out["blocks"].append(a["blocks"])
        types = {"anchor": pa.int64(), "doc_id": pa.int64(), "s": pa.int64(), "block": pa.binary(), "blocks": pa.int64()}
        return {k: pa.array(out[k], t) for k, t in types.items()}

    fetched = cut_lineage(map_batches(texts.join(asked, "doc_id"), fetch,
                                      "anchor bigint, doc_id bigint, s bigint, block binary, blocks bigint"))
    grouped = (fetched.filter(F.col("blocks") <= GROUP).select("anchor", "doc_id", "s", "block")
               .repartition("anchor").sortWithinPartitions("anchor")
               .mapInArrow(_group_matcher(length, keep), "doc_id bigint, f bigint, t bigint"))

    crowd = _crowd_spans(fetched.filter(F.col("blocks") > GROUP).dropDuplicates(["doc_id", "s"])
                         .select("doc_id", "s", "block"), length, keep)
    spans = whole.unionByName(inner).unionByName(grouped).unionByName(crowd)
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("f", "t")).alias("spans"))


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def block_ranges(block: bytes, length: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Windows of a block in runs of STEP, counted from the block's anchor so that
    runs of blocks with one anchor agree: ``(first, last, hash of all bytes of the
    run, hash of the bytes that every window of a whole run has)``."""
    (anchor,), _ = window_anchors(np.frombuffer(block[:length], np.uint8), length)
    anchor, k = int(anchor), len(block) - length + 1
    for c in range(anchor % STEP - STEP, k, STEP):
        first, last = max(0, c), min(k, c + STEP) - 1
        if first <= last:
            yield (first, last, xxhash.xxh3_128_digest(block[first:last + length]),
                   xxhash.xxh3_128_digest(block[c + STEP - 1:c + length]))


def _crowd_spans(blocks: DataFrame, length: int, keep: str) -> DataFrame:
    """Spans of matched windows of blocks ``(doc_id, s, block)`` that are too many
    to be gathered, by grouped counts of hashes only. A run of windows whose bytes
    occur again is settled, and so is one whose common bytes do not; windows of the
    runs between are looked up one by one, together with one copy of each settled
    run, which may be their match."""

    def ranges(b: pa.RecordBatch) -> dict:
        out = defaultdict(list)
        for d, s, block in zip(*(b.column(i).to_pylist() for i in range(3))):
            for first, last, whole, core in block_ranges(block, length):
                for k, v in zip(("doc_id", "s", "a", "z", "whole", "core"), (d, s, s + first, s + last, whole, core)):
                    out[k].append(v)
        w, c = _halves(out["whole"]), _halves(out["core"])
        return {k: pa.array(out[k], pa.int64()) for k in ("doc_id", "s", "a", "z")} | {
            "w1": w[:, 0].copy(), "w2": w[:, 1].copy(), "c1": c[:, 0].copy(), "c2": c[:, 1].copy()}

    runs = cut_lineage(map_batches(blocks, ranges, "doc_id bigint, s bigint, a bigint, z bigint, w1 bigint, w2 bigint, "
                                                   "c1 bigint, c2 bigint"))
    at = F.struct("doc_id", "a")
    wholes = runs.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("low"))
    cores = runs.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    known = cut_lineage(runs.join(cores, ["c1", "c2"]).join(wholes, ["w1", "w2"])
                        .select("doc_id", "s", "a", "z", "n", (at == F.col("low")).alias("is_low")))
    settled = known.filter("n > 1" if keep == "none" else "n > 1 and not is_low").select(
        "doc_id", F.col("a").alias("f"), (F.col("z") + length).alias("t"))
    asked = known.filter("is_low").groupBy("doc_id", "s").agg(F.collect_list(F.struct("a", "z")).alias("asked"))

    def windows(b: pa.RecordBatch) -> dict:
        doc, place, w = [], [], []
        for d, s, block, ask in zip(*(b.column(i).to_pylist() for i in range(4))):
            for r in ask:
                doc.append(np.full(r["z"] - r["a"] + 1, d, np.int64))
                place.append(np.arange(r["a"], r["z"] + 1))
                w.extend(xxhash.xxh3_128_digest(block[i:i + length]) for i in range(r["a"] - s, r["z"] - s + 1))
        h = _halves(w)
        return {"doc_id": np.concatenate(doc), "place": np.concatenate(place), "w1": h[:, 0].copy(), "w2": h[:, 1].copy()}

    single = map_batches(blocks.join(asked, ["doc_id", "s"]).select("doc_id", "s", "block", "asked"), windows,
                         "doc_id bigint, place bigint, w1 bigint, w2 bigint")
    agreed = single.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "place")).alias("low")) \
        .filter("n > 1")
    found = single.join(agreed, ["w1", "w2"])
    if keep == "first":
        found = found.filter(F.struct("doc_id", "place") != F.col("low"))
    return settled.unionByName(found.select("doc_id", F.col("place").alias("f"), (F.col("place") + length).alias("t")))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans (touching spans are one run)."""
    out: list[list[int]] = []
    for f, t in sorted(spans):
        if out and f <= out[-1][1]:
            out[-1][1] = max(out[-1][1], t)
        else:
            out.append([f, t])
    return [(f, t) for f, t in out]


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for f, t in spans:
        parts.append(text[at:f])
        at = t
    return b"".join([*parts, text[at:]])


def _spans_column(column: pa.Array) -> Iterator[list[tuple[int, int]]]:
    for x in column.to_pylist():
        yield merged([(y["f"], y["t"]) for y in x]) if x else []


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first", id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, spans ARRAY<STRUCT<f, t>>, kept BINARY)`` per row: maximal
    removed byte runs and the bytes that stay."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    spans = repeated_spans(docs, length, keep, id_col, text_col)

    def run(b: pa.RecordBatch) -> dict:
        t = texts_as_bytes(b.column(1))
        s = list(_spans_column(b.column(2)))
        return {"doc_id": b.column(0), "n_bytes": pa.array([len(x) for x in t], pa.int64()),
                "spans": pa.array([[{"f": f, "t": e} for f, e in x] for x in s],
                                  pa.list_(pa.struct([("f", pa.int64()), ("t", pa.int64())]))),
                "kept": pa.array([_cut(x, y) for x, y in zip(t, s)], pa.binary())}

    return map_batches(texts.join(spans, "doc_id", "left").select("doc_id", "text", "spans"), run,
                       "doc_id bigint, n_bytes bigint, spans array<struct<f:bigint,t:bigint>>, kept binary")


def drop_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """Pipeline form: the documents with later copies of long passages removed,
    other columns untouched (``n_chars`` follows the new text). A character that
    a cut splits loses its other bytes too."""
    names = docs.columns
    own_id, found = free_name(docs.columns, "id"), free_name(docs.columns, "spans")
    spans = repeated_spans(docs, length, keep).select(F.col("doc_id").alias(own_id), F.col("spans").alias(found))
    joined = docs.join(spans, docs["doc_id"].cast("bigint") == spans[own_id], "left").select(
        *[docs[f"`{n}`"] for n in names], spans[found])

    def run(b: pa.RecordBatch) -> dict:
        out = {n: b.column(i) for i, n in enumerate(names)}
        column = out["text"]
        texts, s = texts_as_bytes(column), list(_spans_column(b.column(len(names))))
        valid = column.is_valid().to_pylist()
        out["text"] = pa.array([(_cut(x, y).decode("utf-8", "ignore") if y else x.decode()) if v else None
                                for x, y, v in zip(texts, s, valid)], pa.string())
        return out

    out = map_batches(joined, run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
