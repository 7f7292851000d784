"""Byte-level BPE training as iterative Spark rounds (V1-V8).

State: distinct words as symbol strings ``(syms STRING, n BIGINT)`` (one
character per token id, see ``functions.text.sym``). The driver only ever sees
small aggregates: the best pairs of a round, a bounded table of runs (see
``operators.active_runs``) and the merges themselves (at most ``vocab_size``
rows).

Exact selection (the default) finds many merges in one round, and they are the
ones that merging one pair at a time gives (freq desc, then smaller
``(left, right)``). A round is three jobs: count pairs, collect the distinct
runs of the best pairs, rewrite the words; the words are checkpointed to
the reliable checkpoint folder after it, so lineage stays short.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.constants import SPECIAL_TOKENS_19, UNKNOWN
from tokenmill.functions.text import (
    END_MARK, MAX_SYMBOL_ID, SYM_BASE, bytes_as_symbols, sym,
)
from tokenmill.operators.active_runs import next_merges, symbols_of
from tokenmill.operators.stats import symbol_pairs
from tokenmill.session import cut_lineage, session_conf

END_ID = ord(END_MARK) - SYM_BASE   # -1: never a token id
ACTIVE_PAIRS = 64                   # active pairs of the first round
RUN_LIMIT = 30_000                  # distinct runs that go to the driver at most

# ----------------------------------------------------------------------------- model

@dataclass
class BpeModel:
    """A trained vocabulary: specials, bytes, merges in rank order.

    ``merges`` rows are ``(left, right, new_id, freq, tokens_after)``; the
    model is bounded by the vocabulary size and is what encoders broadcast.
    ``alphabet`` lists the bytes that have an id, in id order (``None``: all 256);
    every other byte is the special ``<unk>``, which merges never join.
    """

    specials: list[str] = field(default_factory=lambda: list(SPECIAL_TOKENS_19))
    merges: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    byte_offset: int | None = None
    extra_vocab: dict[int, bytes] = field(default_factory=dict)
    alphabet: list[int] | None = None

    def __post_init__(self):
        if self.byte_offset is None:
            self.byte_offset = len(self.specials)
        if self.alphabet is not None and UNKNOWN not in self.specials:
            raise ValueError(f"a vocabulary without all bytes needs the special {UNKNOWN}")

    @property
    def first_merge_id(self) -> int:
        return self.byte_offset + (256 if self.alphabet is None else len(self.alphabet))

    @property
    def unknown_id(self) -> int | None:
        """Id of bytes outside the alphabet; ``None`` if there are none."""
        return None if self.alphabet is None else self.specials.index(UNKNOWN)

    def byte_ids(self) -> list[int]:
        """The id of each of the 256 bytes."""
        if self.alphabet is None:
            return [self.byte_offset + b for b in range(256)]
        place = {b: self.byte_offset + i for i, b in enumerate(self.alphabet)}
        return [place.get(b, self.unknown_id) for b in range(256)]

    @property
    def vocab_size(self) -> int:
        ids = list(self.vocab_bytes().keys())
        return max(ids) + 1 if ids else 0

    def vocab_bytes(self) -> dict[int, bytes]:
        v: dict[int, bytes] = {i: s.encode("utf-8") for i, s in enumerate(self.specials)}
        for b, i in enumerate(self.byte_ids()):
            if i != self.unknown_id:
                v[i] = bytes([b])
        v.update(self.extra_vocab)
        for left, right, new_id, _f, _t in self.merges:
            v[new_id] = v[left] + v[right]
        return v

    def merge_map(self) -> dict[tuple[int, int], int]:
        return {(l, r): n for l, r, n, _f, _t in self.merges}

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        """``(id INT, bytes BINARY, kind STRING)``."""
        kinds = {i: "special" for i in range(len(self.specials))}
        kinds.update({i: "byte" for i in range(self.byte_offset, self.first_merge_id)})
        rows = [(i, bytearray(b), kinds.get(i, "merge")) for i, b in sorted(self.vocab_bytes().items())]
        return spark.createDataFrame(rows, "id int, bytes binary, kind string")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        """V8 merge log: ``(rank, left, right, new_id, freq, tokens_after)``."""
        rows = [(k, l, r, n, f, t) for k, (l, r, n, f, t) in enumerate(self.merges)]
        return spark.createDataFrame(
            rows, "rank int, left int, right int, new_id int, freq bigint, tokens_after bigint")


def base_vocab(spark: SparkSession, specials: list[str] | None = None) -> DataFrame:
    """V1: specials (ids 0..) then the 256 bytes."""
    return BpeModel(specials=list(specials or SPECIAL_TOKENS_19)).vocab_df(spark)


# ----------------------------------------------------------------------------- building blocks

def corpus_alphabet(words: DataFrame, word_col: str = "word") -> list[int]:
    """The distinct bytes of all words, ascending: one narrow pass and at most 256 rows a task."""
    chars = F.regexp_extract_all(F.decode(F.encode(F.col(word_col), "UTF-8"), "ISO-8859-1"), F.lit("(?s)(.)"), F.lit(1))
    # \x00-\xff as characters; a distinct list per word keeps the rows few
    found = words.select(F.explode(F.array_distinct(chars)).alias("c")).distinct().collect()
    return sorted(ord(r["c"]) for r in found)


def words_to_symbols(words: DataFrame, word_col: str = "word", n_col: str = "n",
                     byte_offset: int = len(SPECIAL_TOKENS_19), keep_word: bool = False,
                     byte_ids: list[int] | None = None) -> DataFrame:
    """``([word,] syms, n)`` of the words, one byte symbol per UTF-8 byte."""
    syms = bytes_as_symbols(F.col(word_col), byte_ids or [byte_offset + b for b in range(256)])
    word = [F.col(word_col).alias("word")] if keep_word else []
    return words.select(*word, syms.alias("syms"), F.col(n_col).cast("bigint").alias("n"))


def apply_merges(syms: Column, merges: list[tuple[int, int, int]]) -> Column:
    """V2: replace, left to right and non-overlapping, each ``(a, b)`` by ``n``, in order."""
    for a, b, n in merges:
        syms = F.replace(syms, F.lit(sym(a) + sym(b)), F.lit(sym(n)))
    return syms


def _end_pairs(df: DataFrame, syms: str, weight: Column) -> DataFrame:
    """Adjacent pairs of every word and ``(last, END)``, one weighted row each."""
    return df.select(F.explode(symbol_pairs(F.concat(F.col(syms), F.lit(END_MARK)))).alias("pair"), weight.alias("f"))


def _by_id(pairs: DataFrame) -> DataFrame:
    """Summed pair rows as ``(l INT, r INT, f BIGINT)``."""
    return pairs.groupBy("pair").agg(F.sum("f").alias("f")).select(
        (F.ascii(F.substring("pair", 1, 1)) - F.lit(SYM_BASE)).alias("l"),
        (F.ascii(F.substring("pair", 2, 1)) - F.lit(SYM_BASE)).alias("r"), "f")


def pair_table(work: DataFrame) -> DataFrame:
    """All adjacent pairs of all words (plus ``(last, END)`` per word), weighted."""
    return _by_id(_end_pairs(work, "syms", F.col("n")))


def pair_change(work: DataFrame, merges: list[tuple[int, int, int]]) -> DataFrame:
    """How the merges change the pair counts: ``(l, r, f)``, from the words that hold one of them."""
    hit = F.lit(False)
    for a, b, _n in merges:
        hit = hit | F.contains(F.col("syms"), F.lit(sym(a) + sym(b)))
    changed = work.filter(hit).select("n", "syms", apply_merges(F.col("syms"), merges).alias("after"))
    return _by_id(_end_pairs(changed, "syms", -F.col("n")).unionByName(_end_pairs(changed, "after", F.col("n")))) \
        .filter("f != 0")


def add_change(counts: DataFrame, change: DataFrame) -> DataFrame:
    return counts.unionByName(change).groupBy("l", "r").agg(F.sum("f").alias("f")).filter("f > 0")


# ----------------------------------------------------------------------------- V3 / V5 / V7

def train_bpe(words: DataFrame, vocab_size: int, specials: list[str] | None = None,
              word_col: str = "word", n_col: str = "n", selection: str = "exact",
              batch: int = ACTIVE_PAIRS, checkpoint_every: int = 8,
              base_model: BpeModel | None = None, run_limit: int = RUN_LIMIT,
              alphabet: str = "all") -> BpeModel:
    """V3: learn merges from a word-count table ``(word, n)`` until the
    vocabulary has ``vocab_size`` ids or no pair occurs twice.

    ``selection='exact'`` gives the textbook result (ties: smaller
    ``(left, right)``); ``selection='stale_drop'`` reproduces the lazy-heap
    selection of the reference trainer (V4). ``base_model`` continues an
    existing vocabulary (V6): its merges are applied first. ``batch`` active
    pairs are tried in the first round; ``run_limit`` bounds the runs that
    a round brings to the driver. ``alphabet='corpus'`` (V7) gives ids only to the
    bytes that occur in the words; other bytes will be ``<unk>``.
    """
    if alphabet not in ("all", "corpus"):
        raise ValueError(f"unknown alphabet {alphabet!r}")
    model = base_model or BpeModel(specials=list(specials or SPECIAL_TOKENS_19),
                                   alphabet=corpus_alphabet(words, word_col) if alphabet == "corpus" else None)
    if vocab_size - 1 > MAX_SYMBOL_ID:
        raise ValueError(f"vocab_size {vocab_size} above the supported {MAX_SYMBOL_ID + 1}")
    if model.merges:
        from tokenmill.operators.codec import word_symbols
        work = word_symbols(words, model, word_col, n_col)
    else:
        work = words_to_symbols(words, word_col, n_col, byte_ids=model.byte_ids())
    if selection == "stale_drop":
        from tokenmill.operators.train_heap import train_stale_drop
        return train_stale_drop(work, model, vocab_size, checkpoint_every)
    if selection != "exact":
        raise ValueError(f"unknown selection {selection!r}")
    # the word table is materialised first with the session's own settings
    work = cut_lineage(work.select("syms", "n"))
    with session_conf(work.sparkSession, round_conf(work.sparkSession)):
        return train_rounds(work, model, vocab_size, batch, run_limit)


def round_conf(spark: SparkSession) -> dict[str, str]:
    """Settings for the many small round jobs: the pair tables are
    aggregated on distinct words (no skew left after the partial
    aggregation), so adaptive re-planning only adds latency per round;
    partitions follow the cluster's parallelism instead."""
    n = max(2, spark.sparkContext.defaultParallelism)
    return {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(n)}


def train_rounds(work: DataFrame, model: BpeModel, vocab_size: int, active: int, run_limit: int) -> BpeModel:
    """Rounds over symbol strings ``(syms, n[, doc])``, or packed ones with their ``size``, until the vocabulary is full."""
    total = work.agg(F.coalesce(F.sum(F.col("n") * symbols_of(work)), F.lit(0))).first()[0]
    next_id = max([model.first_merge_id] + [n + 1 for _l, _r, n, _f, _t in model.merges]
                  + [i + 1 for i in model.extra_vocab])
    merges, rounds = list(model.merges), 0
    while next_id < vocab_size:
        made, work, active = next_merges(work, next_id, vocab_size - next_id, active, run_limit, model.unknown_id)
        if not made:
            break
        for left, right, new, f, times in made:
            total -= times
            merges.append((left, right, new, f, total))
        next_id += len(made)
        rounds += 1
        if next_id < vocab_size:
            # a string of one symbol has no pairs and is never needed again
            work = cut_lineage(work.filter(symbols_of(work) > 1))
    out = BpeModel(specials=model.specials, merges=merges, byte_offset=model.byte_offset,
                   extra_vocab=model.extra_vocab, alphabet=model.alphabet)
    out.rounds = rounds  # type: ignore[attr-defined]
    return out
