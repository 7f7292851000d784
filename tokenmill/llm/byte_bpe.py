"""Byte-level BPE (5): encoding and decoding with a public rank file.

Bytes are mapped to Latin-1 characters so that a pyahocorasick trie can hold
every token. A piece is encoded by taking the longest token at each place
and stepping back to the next shorter one when it cannot follow the token
before it. Two tokens may stand next to each other exactly if merging their
joined bytes by rank gives the two again; that test is memoised, and places
from which no encoding is possible are marked, so each place is tried once
and the work is linear in the text. The result equals rank-order merging.

Encoding and decoding are narrow maps; every worker builds the trie once
from the broadcast rank file (bounded by the vocabulary) and keeps bounded
caches of pieces.

Defined cases: null text encodes to an empty list and decodes to empty
bytes; null ids, repeated rows and empty tables pass through row by row; very long
texts and very long words are encoded whole, in linear time; merges of equal rank
do not exist, so there are no ties; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.llm.common import map_batches, spread

CACHE_PIECES = 300_000      # per worker and cache


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank from the lines ``base64 rank`` of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class ByteBpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, data: bytes, pattern: str):
        ranks = read_ranks(data)
        self.ranks = {t.decode("latin-1"): r for t, r in ranks.items()}
        self.text_of = {r: t for t, r in self.ranks.items()}
        self.trie = ahocorasick.Automaton()
        for t, r in self.ranks.items():
            self.trie.add_word(t, (len(t) - 1, r))
        self.trie.make_automaton()
        self.shorter_memo: dict[int, int] = {}
        self.split = regex.compile(pattern)
        self.fits_memo: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.units: dict[str, tuple[int, ...]] = {}
        size = max(self.text_of) + 1
        lengths = np.zeros(size, np.int64)
        for r, t in self.text_of.items():
            lengths[r] = len(t)
        self.lengths, self.size = lengths, lengths.tolist()
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.bytes = np.frombuffer("".join(self.text_of.get(i, "") for i in range(size)).encode("latin-1"), np.uint8)

    def merge_by_rank(self, s: str) -> list[int]:
        """The definition: merge the adjacent pair of lowest rank until none is left."""
        parts = list(s)
        while len(parts) > 1:
            joined = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            low = min(joined)
            if low == 1 << 60:
                break
            i = joined.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, a: int, b: int) -> bool:
        """May token ``b`` follow token ``a``?"""
        got = self.fits_memo.get((a, b))
        if got is None:
            if len(self.fits_memo) > 2_000_000:
                self.fits_memo.clear()
            got = self.merge_by_rank(self.text_of[a] + self.text_of[b]) == [a, b]
            self.fits_memo[a, b] = got
        return got

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of the token (-1: none)."""
        got = self.shorter_memo.get(token)
        if got is None:
            t = self.text_of[token]
            n = len(t) - 1
            while n and t[:n] not in self.ranks:
                n -= 1
            got = self.shorter_memo[token] = self.ranks[t[:n]] if n else -1
        return got

    def encode_piece(self, s: str) -> tuple[int, ...]:
        """Tokens of one piece given as Latin-1 characters."""
        whole = self.ranks.get(s)
        if whole is not None:
            return (whole,)
        longest = [0] * len(s)
        for end, (back, token) in self.trie.iter(s):   # longer matches of a place come later
            longest[end - back] = token
        lengths, memo, fits, dead = self.size, self.fits_memo, self.fits, set()
        out: list[int] = []
        n, at, last, token = len(s), 0, -1, longest[0]
        while at < n:
            while token >= 0:
                to = at + lengths[token]
                if to not in dead:
                    ok = True if last < 0 else memo.get((last, token))
                    if fits(last, token) if ok is None else ok:
                        break
                token = self.shorter(token)
            if token >= 0:
                out.append(token)
                at, last = to, token
                token = longest[at] if at < n else -1
            else:                                  # nothing can start here: take one token back
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1
                token = self.shorter(token)
        return tuple(out)

    def encode_unit(self, unit: str) -> tuple[int, ...]:
        out: list[int] = []
        pieces = self.pieces
        for p in self.split.findall(unit):
            ids = pieces.get(p)
            if ids is None:
                if len(pieces) >= CACHE_PIECES:
                    pieces.clear()
                ids = self.encode_piece(p.encode().decode("latin-1"))
                if len(p) < 64:
                    pieces[p] = ids
            out.extend(ids)
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text. The split pattern always starts a new match at
        a single space between two non-space characters, so the text is cut
        there first and each cut part is encoded once and remembered."""
        units, out = self.units, []
        for unit in cut_at_spaces(text):
            ids = units.get(unit)
            if ids is None:
                if len(units) >= CACHE_PIECES:
                    units.clear()
                ids = self.encode_unit(unit)
                if len(unit) < 64:
                    units[unit] = ids
            out.extend(ids)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - n), n)
        return self.bytes[at].tobytes()


def cut_at_spaces(text: str) -> list[str]:
    """Parts of the text, in order, cut before each space that stands between
    two characters that are not white space."""
    parts = text.split(" ")
    out = [parts[0]]
    open_end = not parts[0] or parts[0][-1].isspace()     # the last part may not be closed before the next space
    for p in parts[1:]:
        if not p or p[0].isspace() or open_end:
            out[-1] += " " + p if p else " "
            open_end = not p or p[-1].isspace()
        else:
            out.append(" " + p)
            open_end = p[-1].isspace()
    return out


_codecs: dict[int, ByteBpe] = {}


def _codec(data_bc, pattern: str) -> ByteBpe:
    """One codec per worker process and rank file."""
    data = data_bc.value
    key = hash((data, pattern))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = ByteBpe(data, pattern)
    return _codecs[key]


def load_rank_file(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``(doc_id, ids ARRAY<INT>)`` of every whole text."""
    bc = load_rank_file(docs.sparkSession, rank_path)

    def run(b: pa.RecordBatch) -> dict:
        codec = _codec(bc, pattern)
        flat, ends = [], [0]
        for t in b.column(1).to_pylist():
            if t:
                flat.append(np.array(codec.encode(t), np.int32))
            ends.append(ends[-1] + (len(flat[-1]) if t else 0))
        values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        return {"doc_id": b.column(0),
                "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))}

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(spread(d), run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids, decoded BINARY)``: the bytes that the ids stand for (null ids: empty)."""
    bc = load_rank_file(encoded.sparkSession, rank_path)

    def run(b: pa.RecordBatch) -> dict:
        codec = _codec(bc, pattern)
        ids = b.column(1)
        out = []
        for i in range(len(ids)):
            v = ids[i].values
            out.append(codec.decode(v.to_numpy(zero_copy_only=False)) if v is not None and len(v) else b"")
        return {"doc_id": b.column(0), "ids": ids, "decoded": pa.array(out, pa.binary())}

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, ids array<int>, decoded binary")
