"""Best-fit packing (8): documents into few sequences of a fixed number of tokens.

Steps, none of which sees rows of one length or document set in one place:

1. token ids of every whole text (narrow map; words are encoded once per
   worker and remembered), cut into pieces of at most ``capacity`` tokens;
2. a histogram of piece lengths: at most ``capacity`` counts, whatever the
   corpus, and the only thing that goes to the driver;
3. a plan made on the histogram. From the longest length down, the gap of a
   sequence is looked up among the lengths (single), the sums of two lengths
   (pair) and of three (triple) that are still available; a combination that
   fills the gap exactly is consumed as often as its counts allow. What is
   left is placed by best fit: the smallest open gap that holds it;
4. pieces get a number within their length (salted, so a length that a third
   of the pieces have is numbered by many tasks) and look up their place in
   the plan, a table bounded by the capacity.

Defined cases: a null or empty text is the end token alone; a very long text is
cut into pieces of the capacity, one document at a time; null ids and repeated
rows are documents of their own; pieces of equal length are interchangeable, so
ties have no effect on the number of sequences; other columns are ignored,
whatever their names; an empty table packs to nothing.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenmill.functions.text import byte_to_printable_map
from tokenmill.llm.common import cut_lineage, map_batches, spread, texts_as_bytes

CAPACITY = 4096
END_ID = 1
CACHE_WORDS = 250_000       # per worker, cache and generation


# ------------------------------------------------------------------ 1: token ids and pieces

_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PRINTABLE = {b: ord(c) for b, c in byte_to_printable_map().items()}


class Recent(dict):
    """Remembers what ``make`` gives for a key. Two generations of ``size`` keys: a full
    one becomes the older one, and keys in use come back from it, so words that are
    rare go and frequent ones stay."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.before = make, size, {}

    def __missing__(self, key):
        got = self.before.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = got
        return got


class WordIds:
    """Word -> its ids as little-endian 32-bit integers. White space parts
    words in this tokenizer and is dropped, so words encode one by one. It
    lower-cases, and marks after letters are tokens of their own, so most new
    words are a lower-case core of letters, which goes straight to the merge
    model, and a tail of marks; all others take the whole tokenizer, so also
    every word with a special string (marks around letters) in it."""

    def __init__(self, tokenizer, remember: int = CACHE_WORDS):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.words = Recent(self._encode, remember)
        self.cores = Recent(self._core, remember)
        self.others = Recent(self._other, remember)

    def ids(self, words: list[bytes]) -> bytes:
        """Ids of all words in order."""
        return b"".join(map(self.words.__getitem__, words))

    def _encode(self, word: bytes) -> bytes:
        s = word.decode()
        core = s.rstrip(_MARKS)
        if core.isalpha() and core[-1] < "\u3000" and is_normalized("NFC", core):
            # the letters whose lower case depends on more than the letter take the other way
            if "\u03a3" not in core and "\u0130" not in core:
                got = self.cores[core.lower()]
                return got + self.others[s[len(core):]] if len(core) < len(s) else got
        return self.others[s]

    def _core(self, low: str) -> bytes:
        text = low.encode().decode("latin-1").translate(_PRINTABLE)
        return np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()

    def _other(self, s: str) -> bytes:
        return np.array(self.tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes()


_tokenizers: dict[tuple[int, int], WordIds] = {}


def _word_ids(bc, remember: int) -> WordIds:
    key = hash(bc.value), remember
    if key not in _tokenizers:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _tokenizers.clear()
        _tokenizers[key] = WordIds(Tokenizer.from_str(bc.value), remember)
    return _tokenizers[key]


def document_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
                    remember: int = CACHE_WORDS) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids BINARY])``, one row per piece;
    ``ids`` holds little-endian unsigned 32-bit integers. ``remember`` bounds what a
    worker keeps of its words and changes no result."""
    with open(tokenizer_path, encoding="utf-8") as f:
        bc = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(b: pa.RecordBatch) -> dict:
        table = _word_ids(bc, remember)
        out = defaultdict(list)
        for doc, text in zip(b.column(0).to_pylist(), texts_as_bytes(b.column(1))):
            ids = table.ids(text.split()) + end
            for piece, at in enumerate(range(0, len(ids), step)):
                part = ids[at:at + step]
                out["doc_id"].append(doc)
                out["piece"].append(piece)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
                if with_ids:
                    out["ids"].append(part)
        cols = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
                "ids_crc32": pa.int64()} | ({"ids": pa.binary()} if with_ids else {})
        return {k: pa.array(out[k], t) for k, t in cols.items()}

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(spread(d), run, schema)


# ------------------------------------------------------------------ 3: the plan

class Plan:
    """Groups of equal sequences: ``(lengths, how many)`` in the order made."""

    def __init__(self):
        self.groups: list[tuple[tuple[int, ...], int]] = []

    def add(self, lengths: tuple[int, ...], times: int) -> None:
        self.groups.append((lengths, times))

    def places(self) -> dict[int, list[tuple[int, int, int]]]:
        """Length -> ``(first number, first sequence, offset)`` rows, numbers ascending."""
        used: dict[int, int] = defaultdict(int)
        out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        first = 0
        for lengths, times in self.groups:
            offset = 0
            for n in lengths:
                out[n].append((used[n], first, offset))
                used[n] += times
                offset += n
            first += times
        return out


def _times(count: np.ndarray, combination: tuple[int, ...]) -> int:
    """How often the combination can be taken from the counts."""
    need = defaultdict(int)
    for n in combination:
        need[n] += 1
    return min(int(count[n]) // k for n, k in need.items())


def _pair(count: np.ndarray, total: int) -> tuple[int, int] | None:
    """Two available lengths with the given sum, the longest first one wins."""
    a = np.arange(total - 1, (total - 1) // 2, -1)
    a = a[a < len(count)]
    b = total - a
    ok = (count[a] > 0) & (count[b] > 0) & ((a != b) | (count[a] > 1))
    hit = np.flatnonzero(ok)
    return (int(a[hit[0]]), int(b[hit[0]])) if len(hit) else None


def _triple(count: np.ndarray, total: int) -> tuple[int, int, int] | None:
    for a in range(min(total - 2, len(count) - 1), (total - 1) // 3, -1):
        if count[a]:
            count[a] -= 1
            pair = _pair(count, total - a)
            count[a] += 1
            if pair:
                return a, *pair
    return None


RESERVES = (0, 8, 4, 2)     # lengths up to capacity / this are kept out of combinations (0: none)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Exact complements first, best fit for the rest; works on counts only.

    Short lengths that combinations consume are missing later, when best fit could
    have filled other gaps with them. The plan is therefore made with growing
    reserves of short lengths until it needs no more sequences than the tokens do;
    else the shortest plan stands. The largest reserve leaves all to best fit,
    so no plan is longer than best fit alone."""
    least = -(-sum(n * c for n, c in histogram.items()) // capacity)
    best, size = None, 0
    for part in RESERVES:
        plan = _plan(histogram, capacity, capacity // part if part else 0)
        used = sum(times for _, times in plan.groups)
        if best is None or used < size:
            best, size = plan, used
        if size == least:
            break
    return best


def _plan(histogram: dict[int, int], capacity: int, reserve: int) -> Plan:
    count = np.zeros(capacity + 1, np.int64)
    for n, c in histogram.items():
        count[n] = c
    kept = [(n, int(count[n])) for n in range(reserve, 0, -1) if count[n]]
    count[:reserve + 1] = 0
    plan = Plan()
    if count[capacity]:
        plan.add((capacity,), int(count[capacity]))
        count[capacity] = 0
    rest: list[tuple[int, int]] = []
    for n in range(capacity - 1, 0, -1):
        gap = capacity - n
        for find in (lambda g: (g,) if count[g] else None, lambda g: _pair(count, g), lambda g: _triple(count, g)):
            while count[n]:
                count[n] -= 1                     # the piece that opens the sequence
                found = find(gap)
                count[n] += 1
                times = _times(count, (n, *found)) if found else 0
                if not times:
                    break
                for x in (n, *found):
                    count[x] -= times
                plan.add((n, *found), times)
        if count[n]:
            rest.append((n, int(count[n])))
            count[n] = 0
    _best_fit(rest + kept, plan, capacity)
    return plan


def _best_fit(rest: list[tuple[int, int]], plan: Plan, capacity: int) -> None:
    """Lengths descending; each piece goes to the open sequence with the smallest
    gap that holds it. That sequence's new gap, if it holds another piece of the
    length, is then the smallest one, so it is filled before the next is looked at."""
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    gaps: list[int] = []                          # keys of open_at, ascending

    def put(gap: int, lengths: tuple[int, ...], times: int) -> None:
        if gap not in open_at:
            insort(gaps, gap)
        open_at[gap].append((lengths, times))

    for n, left in rest:
        while left:
            i = bisect_left(gaps, n)
            if i < len(gaps):
                gap = gaps[i]
                lengths, times = open_at[gap].pop()
                if not open_at[gap]:
                    del open_at[gap], gaps[i]
            else:                                 # no open gap holds it: new sequences
                gap, lengths, times = capacity, (), -(-left // (capacity // n))
            fill = gap // n
            whole = min(times, left // fill)
            if whole:
                put(gap - fill * n, (*lengths, *(n,) * fill), whole)
                left -= whole * fill
                times -= whole
            if times and left:                    # fewer than fill: the last sequence that gets any
                put(gap - left * n, (*lengths, *(n,) * left), 1)
                left, times = 0, times - 1
            if times:
                put(gap, lengths, times)
    for groups in open_at.values():
        for lengths, times in groups:
            plan.add(lengths, times)


# ------------------------------------------------------------------ 4: places

def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have ``length``, ``doc_id`` and ``piece``."""
    spark: SparkSession = pieces.sparkSession
    pieces = cut_lineage(pieces)
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan_packing(histogram, capacity).places()
    bc = spark.sparkContext.broadcast({k: list(zip(*v)) for k, v in places.items()})
    before = sizes.select("length", "_salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("_salt")) - F.col("n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32"))
    numbered = (salted.withColumn("_own", own - 1).join(before, ["length", "_salt"])
                .withColumn("_number", F.col("_own") + F.col("_before")).drop("_salt", "_own", "_before"))
    names = [c for c in pieces.columns]

    def run(b: pa.RecordBatch) -> dict:
        table = bc.value
        out = {n: b.column(b.schema.get_field_index(n)) for n in names}
        seq, off = [], []
        for n, k in zip(out["length"].to_pylist(), b.column(b.schema.get_field_index("_number")).to_pylist()):
            firsts, sequences, offsets = table[n]
            i = bisect_right(firsts, k) - 1
            seq.append(sequences[i] + k - firsts[i])
            off.append(offsets[i])
        return out | {"sequence_id": pa.array(seq, pa.int64()), "offset": pa.array(off, pa.int64())}

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", sequence_id bigint, offset bigint"
    return map_batches(numbered, run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   with_ids: bool = True, remember: int = CACHE_WORDS) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id, piece, start, length,
    ids_crc32, [ids,] sequence_id, offset``."""
    return place_pieces(document_pieces(docs, tokenizer_path, capacity, end_id, with_ids=with_ids,
                                        remember=remember), capacity)
