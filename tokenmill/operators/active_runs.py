"""Many merges from one pass: the runs of active pairs.

Take the best pairs of a symbol table as *active*, and let P be the best pair
that is not. Cut every symbol string between two symbols whose pair is not
active; what is left with two symbols or more is a run. Until a round's best
pair is worse than P, merges happen inside runs only: a new pair across a cut
occurs at most as often as the pair that was cut there, which is not better
than P (new ids are greater than all others and new places are not earlier, so
this holds for ties as well). And a pair inside a run never occurs across a
cut, as both symbols' outermost parts are the same wherever they meet.

Equal runs are one row, whatever number of words or documents hold them. Spark
counts pairs and runs over all data; the table of distinct runs is the only thing
that goes to the driver, is held to a stated number of rows by taking fewer
active pairs, and yields the exact merges, one at a time, until P would be
next. All strings are then rewritten run by run in one narrow pass.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.session import bounded_batches

PAIR_SHIFT = 21                 # a pair code is left << 21 | right; ids are below 2**20


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all symbols of a column of symbol strings, and where each row starts and the
    last ends. Symbols are supplementary characters: four UTF-8 bytes each, read as one number."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    size = (at[-1] - at[0]) // 4
    w = np.frombuffer(data, "<u4", size, at[0]) if size else np.zeros(0, "<u4")
    ids = (w & 0x07) << 18 | (w & 0x3F00) << 4 | (w & 0x3F0000) >> 10 | w >> 24 & 0x3F
    return ids.astype(np.int64) - 0x10000, (at - at[0]) // 4


def symbol_strings(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """The inverse of :func:`_ids`."""
    code = ids.astype(np.uint32) + np.uint32(0x10000)
    w = 0x808080F0 | code >> 18 | (code >> 12 & 0x3F) << 8 | (code >> 6 & 0x3F) << 16 | (code & 0x3F) << 24
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [
        None, pa.py_buffer((4 * at).astype(np.int64).tobytes()), pa.py_buffer(w.astype("<u4").tobytes())]).cast(pa.string())


_strings = symbol_strings


def pack(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """Symbols as compressed numbers: a byte with their width, then those of a row. The numbers of symbols
    go beside them (a column ``size``)."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    raw = memoryview(ids.astype(f"<u{width}").tobytes())
    return pa.array([bytes([width]) + pa.compress(raw[width * a:width * z], codec="zstd", asbytes=True) if z > a else b""
                     for a, z in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())


def unpack(packed: pa.Array, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of :func:`pack`."""
    raw = [np.frombuffer(pa.decompress(memoryview(x)[1:], x[0] * n, codec="zstd"), f"<u{x[0]}") if n else np.zeros(0, np.int64)
           for x, n in zip(packed.to_pylist(), size.tolist())]
    return np.concatenate([np.zeros(0, np.int64), *raw]).astype(np.int64, copy=False), np.concatenate([[0], np.cumsum(size)])


BATCH_SYMBOLS = 1 << 19     # symbols of packed rows that are unpacked together (a longer row is by itself)


def read_symbols(batches: Iterator[pa.RecordBatch], in_order: bool = False) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with the ids of their symbols, strings or packed; by document if asked."""
    for b in batches:
        if in_order and "doc" in b.schema.names:
            doc = b.column("doc").to_numpy()
            b = b if (doc[1:] >= doc[:-1]).all() else b.take(pa.array(np.argsort(doc, kind="stable")))
        if "size" not in b.schema.names:
            yield b, *_ids(b.column("syms"))
            continue
        ends, row = np.cumsum(b.column("size").to_numpy()), 0
        while row < len(ends):
            before = ends[row - 1] if row else 0
            to = max(row + 1, int(np.searchsorted(ends, before + BATCH_SYMBOLS, side="right")))
            part = b.slice(row, to - row)
            yield part, *unpack(part.column("syms"), part.column("size").to_numpy())
            row = to


def _passed_in(work: DataFrame) -> DataFrame:
    """The columns that the passes read."""
    return bounded_batches(work).select(*[c for c in ("syms", "size", "n", "doc") if c in work.columns])


def symbols_of(work: DataFrame) -> Column:
    """How many symbols a row has."""
    return F.col("size") if "size" in work.columns else F.length("syms")


def _codes(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Pair code at every symbol but the last of all; -1 at the last of a row."""
    code = ids[:-1] << PAIR_SHIFT | ids[1:]
    ends = at[1:-1] - 1
    code[ends[(ends >= 0) & (ends < len(code))]] = -1
    return code


class ActivePairs:
    """Which of two adjacent symbols are an active pair: two look-ups for the places of both
    symbols and one in a table of places."""

    def __init__(self, active: list[tuple[int, int]]):
        pairs = np.array(active, np.int64).reshape(-1, 2)
        self.left, self.right = (self.places(pairs[:, i]) for i in (0, 1))
        self.table = np.zeros((self.left.max(initial=0) + 1, self.right.max(initial=0) + 1), bool)
        self.table[self.left[pairs[:, 0]], self.right[pairs[:, 1]]] = True

    @staticmethod
    def places(ids: np.ndarray) -> np.ndarray:
        """Place 1, 2, ... of every id that occurs, 0 for all others; the last place stands for greater ids."""
        found = np.unique(ids)
        out = np.zeros(found.max(initial=0) + 2, np.int32)
        out[found] = np.arange(1, len(found) + 1)
        return out

    def runs(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all maximal runs of two symbols or more."""
        left = self.left[np.minimum(ids[:-1], len(self.left) - 1)]
        joined = self.table[left, self.right[np.minimum(ids[1:], len(self.right) - 1)]]
        ends = at[1:-1] - 1
        joined[ends[(ends >= 0) & (ends < len(joined))]] = False
        edge = np.diff(np.concatenate([[0], joined.view(np.int8), [0]]))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1


def _parts(ids: np.ndarray, a: np.ndarray, z: np.ndarray) -> pa.Array:
    """The ids from each a to z, four bytes each."""
    # what is between two runs is a value of its own that is left out
    bounds = np.stack([a, z], axis=1).reshape(-1)
    at = np.append(4 * bounds, 4 * bounds[-1:]).astype(np.int32)
    every = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
    return every.take(pa.array(np.arange(0, 2 * len(a), 2)))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first)


def _counted(keys: np.ndarray, size: int, n: np.ndarray) -> np.ndarray:
    """Sums of n by keys below size, exact."""
    if (n == 1).all():
        return np.bincount(keys, minlength=size)
    if n.sum(dtype=np.float64) < 1 << 52:
        return np.bincount(keys, n, size).astype(np.int64)      # whole numbers of this size are exact
    out = np.zeros(size, np.int64)
    np.add.at(out, keys, n)
    return out


def _first(keys: np.ndarray, size: int, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """For each key below size the index of its least place (all keys occur)."""
    if len(doc) and ((doc[1:] < doc[:-1]) | (doc[1:] == doc[:-1]) & (pos[1:] < pos[:-1])).any():
        order = np.lexsort((pos, doc))
    else:
        order = np.arange(len(keys))
    out = np.zeros(size, np.int64)
    out[keys[order][::-1]] = order[::-1]        # of equal keys the last one written stays
    return out


# ------------------------------------------------------------------ the three passes

DENSE_IDS = 1024            # ids up to which pairs are counted in a table of all pairs
KEPT_RUNS = 200_000         # distinct runs that a task sums up before it passes them on


def pair_counts(work: DataFrame) -> DataFrame:
    """``(l, r, f[, doc, pos])`` of symbol strings ``(syms, n[, doc])``, or packed ones ``(syms, size, n[, doc])``: weighted counts of all
    overlapping adjacent pairs and, with ``doc``, the place of the first (the left symbol's)."""
    placed = "doc" in work.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, ids, at in read_symbols(batches, in_order=True):
            if len(ids) < 2:
                continue
            rows = np.repeat(np.arange(len(at) - 1), np.diff(at))[:-1]
            top = int(ids.max()) + 1
            if top <= DENSE_IDS:
                code = ids[:-1] * top + ids[1:]
                use = np.ones(len(code), bool)
                ends = at[1:-1] - 1
                use[ends[(ends >= 0) & (ends < len(code))]] = False
                use = np.flatnonzero(use)
                code = code[use]
                f = _counted(code, top * top, b.column("n").to_numpy()[rows[use]])
                keys = np.flatnonzero(np.bincount(code, minlength=top * top))
                f, l, r = f[keys], keys // top, keys % top
                if placed:
                    group = np.zeros(top * top, np.int64)
                    group[keys] = np.arange(len(keys))
                    group = group[code]
            else:
                code = _codes(ids, at)
                use = np.flatnonzero(code >= 0)
                if not len(use):
                    continue
                keys, f = _summed(code[use], b.column("n").to_numpy()[rows[use]])
                l, r = keys >> PAIR_SHIFT, keys & (1 << PAIR_SHIFT) - 1
                if placed:
                    group = np.searchsorted(keys, code[use])
            out = [pa.array(l.astype(np.int32)), pa.array(r.astype(np.int32)), pa.array(f)]
            if placed:
                doc, pos = b.column("doc").to_numpy()[rows[use]], use - at[rows[use]]
                first = _first(group, len(keys), doc, pos)
                out += [pa.array(doc[first]), pa.array(pos[first])]
            yield pa.RecordBatch.from_arrays(out, names=["l", "r", "f", "doc", "pos"][:len(out)])

    schema = "l int, r int, f bigint" + ", doc bigint, pos bigint" * placed
    found = _passed_in(work).mapInArrow(run, schema)
    first = [F.min(F.struct("doc", "pos")).alias("at")] * placed
    total = found.groupBy("l", "r").agg(F.sum("f").alias("f"), *first)
    return total.select("l", "r", "f", *[F.col("at.doc").alias("doc"), F.col("at.pos").alias("pos")] * placed)


def _same_runs(run: pa.Array, n: np.ndarray, doc: np.ndarray | None, pos: np.ndarray | None) -> tuple:
    """Equal runs as one: the sum of their weights and their least place."""
    coded = run.dictionary_encode()
    group, size = coded.indices.to_numpy(), len(coded.dictionary)
    n = _counted(group, size, n)
    if doc is None:
        return coded.dictionary, n, None, None
    first = _first(group, size, doc, pos)
    return coded.dictionary, n, doc[first], pos[first]


def distinct_runs(work: DataFrame, active: list[tuple[int, int]]) -> DataFrame:
    """``(run, n[, doc, pos])``: every distinct run of two symbols or more of the strings, its
    weight and, with ``doc``, where it is first."""
    placed = "doc" in work.columns

    def summed(kept: list[tuple]) -> tuple:
        run, n, doc, pos = zip(*kept)
        return _same_runs(pa.concat_arrays(run), np.concatenate(n), *[np.concatenate(x) if placed else None for x in (doc, pos)])

    def passed(run: pa.Array, n: np.ndarray, *place: np.ndarray) -> pa.RecordBatch:
        out = [run, pa.array(n), *[pa.array(x) for x in place if placed]]
        return pa.RecordBatch.from_arrays(out, names=["run", "n", "doc", "pos"][:len(out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, kept, rows = ActivePairs(active), [], 0
        for b, ids, at in read_symbols(batches, in_order=True):
            if len(ids) < 2:
                continue
            a, z = pairs.runs(ids, at)
            if not len(a):
                continue
            row = np.searchsorted(at, a, side="right") - 1
            doc, pos = (b.column("doc").to_numpy()[row], a - at[row]) if placed else (None, None)
            kept.append(_same_runs(_parts(ids, a, z), b.column("n").to_numpy()[row], doc, pos))
            rows += len(kept[-1][0])
            if rows > KEPT_RUNS:
                kept = [summed(kept)]
                rows = len(kept[0][0])
                if 2 * rows > KEPT_RUNS:
                    yield passed(*kept[0])
                    kept, rows = [], 0
        if kept:
            yield passed(*summed(kept))

    schema = "run binary, n bigint" + ", doc bigint, pos bigint" * placed
    found = _passed_in(work).mapInArrow(run, schema)
    first = [F.min(F.struct("doc", "pos")).alias("at")] * placed
    total = found.groupBy("run").agg(F.sum("n").alias("n"), *first)
    return total.select("run", "n", *[F.col("at.doc").alias("doc"), F.col("at.pos").alias("pos")] * placed)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the spans that begin at ``starts``."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def rewrite_runs(work: DataFrame, active: list[tuple[int, int]], merged: dict[bytes, bytes]) -> DataFrame:
    """The strings with every run replaced by what it became (runs without a merge are left out
    of ``merged``); other columns are untouched."""
    bc = work.sparkSession.sparkContext.broadcast(merged)
    names = work.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, now = ActivePairs(active), bc.value
        for b, ids, at in read_symbols(batches):
            columns = {c: b.column(c) for c in names}
            a, z = pairs.runs(ids, at) if len(ids) > 1 else (ids[:0], ids[:0])
            if len(a):
                coded = _parts(ids, a, z).dictionary_encode()
                became = [now.get(x) for x in coded.dictionary.to_pylist()]     # None: it stays
                size = np.array([-1 if x is None else len(x) // 4 for x in became], np.int64)
                base = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
                new = np.frombuffer(b"".join(x for x in became if x is not None), "<u4").astype(np.int64)
                kind = coded.indices.to_numpy()
                changed = np.flatnonzero(size[kind] >= 0)
                a, z, kind = a[changed], z[changed], kind[changed]
                ids = ids.copy()                        # those of a single row can be the row's own memory
                # a run that has merged is shorter: it is written at its start and the rest goes
                ids[_spans(a, size[kind])] = new[_spans(base[kind], size[kind])]
                keep = np.ones(len(ids), bool)
                keep[_spans(a + size[kind], z - a - size[kind])] = False
                ids, at = ids[keep], np.concatenate([[0], np.cumsum(keep)])[at]
                if "size" in names:
                    columns |= {"syms": pack(ids, at), "size": pa.array(np.diff(at))}
                else:
                    columns["syms"] = symbol_strings(ids, at)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return bounded_batches(work).mapInArrow(run, work.schema)


# ------------------------------------------------------------------ merges inside the runs

@dataclass
class Run:
    ids: list[int]
    n: int
    place: tuple[int, int] | None               # document and symbol where the run is first
    widths: list[int]                           # symbols of the round's start in each symbol

    def pairs(self) -> Iterator[tuple[int, int]]:
        return zip(self.ids, self.ids[1:])

    def first(self, pair: tuple[int, int]) -> tuple[int, int]:
        """Where the two symbols of the pair's first occurrence meet."""
        k = next(k for k, p in enumerate(self.pairs()) if p == pair)
        return self.place[0], self.place[1] + sum(self.widths[:k + 1])

    def join(self, pair: tuple[int, int], new: int) -> int:
        """Merge the pair, left to right and non-overlapping; how often it was."""
        ids, widths, k = [], [], 0
        while k < len(self.ids):
            if k + 1 < len(self.ids) and (self.ids[k], self.ids[k + 1]) == pair:
                ids.append(new)
                widths.append(self.widths[k] + self.widths[k + 1])
                k += 2
            else:
                ids.append(self.ids[k])
                widths.append(self.widths[k])
                k += 1
        times = len(self.ids) - len(ids)
        self.ids, self.widths = ids, widths
        return times


def merge_runs(runs: list[Run], bound: tuple | None, first_id: int, room: int) -> list[tuple[int, int, int, int, int]]:
    """Exact merges ``(left, right, new_id, freq, times)``, best pair first, until the best
    one is worse than ``bound``, has fewer than two occurrences, or ``room`` merges are made.
    The order is ``(-freq, left, right)``, or ``(-freq, first place)`` for placed runs."""
    count: dict[tuple[int, int], int] = defaultdict(int)
    where: dict[tuple[int, int], set[int]] = defaultdict(set)

    def enter(i: int, sign: int) -> None:
        for p in runs[i].pairs():
            count[p] += sign * runs[i].n
            if sign > 0:
                where[p].add(i)
            else:
                where[p].discard(i)

    for i in range(len(runs)):
        enter(i, 1)
    out = []
    while len(out) < room and count:
        most = max(count.values())
        if most < 2:
            break
        ties = [p for p, f in count.items() if f == most]
        if runs[0].place is None:
            pair = min(ties)
            rank = (-most, *pair)
        else:
            place, pair = min((min(runs[i].first(p) for i in where[p]), p) for p in ties)
            rank = (-most, *place)
        if bound is not None and rank > bound:
            break
        new, times = first_id + len(out), 0
        for i in list(where[pair]):
            enter(i, -1)
            times += runs[i].n * runs[i].join(pair, new)
            enter(i, 1)
        out.append((*pair, new, most, times))
        count.pop(pair, None)                     # none is left
        where.pop(pair, None)
    return out


def next_merges(work: DataFrame, first_id: int, room: int, active: int, limit: int, never: int | None = None,
                ) -> tuple[list[tuple[int, int, int, int, int]], DataFrame, int]:
    """One round over symbol strings ``(syms, n[, doc])``: the next merges, the strings after
    them, and how many active pairs to try next. At most ``limit`` runs are taken;
    the symbol ``never`` is not merged."""
    placed = "doc" in work.columns
    counts = pair_counts(work).filter("f >= 2")
    if never is not None:
        counts = counts.filter((F.col("l") != never) & (F.col("r") != never))
    order = [F.desc("f"), "doc", "pos"] if placed else [F.desc("f"), "l", "r"]
    top = counts.orderBy(*order).limit(active + 1).collect()
    while top:
        chosen = [(r["l"], r["r"]) for r in top[:active]]
        bound = None
        if len(top) > active:
            p = top[active]
            # in a placed order pairs are compared by where their symbols meet
            bound = (-p["f"], p["doc"], p["pos"] + 1) if placed else (-p["f"], p["l"], p["r"])
        found = distinct_runs(work, chosen)
        rows = (found.limit(limit + 1) if active > 1 else found).collect()
        if len(rows) <= limit or active == 1:     # a single pair has one run, or one per length if it is of equal symbols
            runs = [Run(np.frombuffer(r["run"], "<u4").tolist(), r["n"], (r["doc"], r["pos"]) if placed else None,
                        [1] * (len(r["run"]) // 4)) for r in rows]
            merges = merge_runs(runs, bound, first_id, room)
            merged = {bytes(r["run"]): np.array(x.ids, "<u4").tobytes() for r, x in zip(rows, runs)
                      if 4 * len(x.ids) < len(r["run"])}
            return merges, rewrite_runs(work, chosen, merged), 2 * active if 4 * len(rows) < limit else active
        active = max(1, active // 2)
    return [], work, active
