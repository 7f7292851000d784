"""V4: ``stale_drop`` selection, the lazy max-heap behaviour of the
reference trainer, as Spark tables.

Heap entries ``(l, r, f)`` live in a DataFrame. An entry is pushed at the
start (every pair with f >= 2) and whenever a merge *raises* a pair's
count (with the new count). Popping takes entries in ``(f desc, l, r)``
order and keeps the first whose ``f`` equals the pair's current count;
entries before it are stale and dropped. A pair whose count only fell has
no valid entry until it rises again. One merge and one Spark job per round;
counts are updated from the words that contain the merged pair only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.functions.text import sym
from tokenmill.session import cut_lineage


def train_stale_drop(work: DataFrame, model, vocab_size: int, checkpoint_every: int = 8):
    from tokenmill.operators.train import round_conf
    from tokenmill.session import session_conf
    with session_conf(work.sparkSession, round_conf(work.sparkSession)):
        return _rounds(cut_lineage(work), model, vocab_size, checkpoint_every)


def _rounds(work: DataFrame, model, vocab_size: int, checkpoint_every: int):
    from tokenmill.operators.train import END_ID, BpeModel, add_change, pair_change, pair_table
    tokens = work.agg(F.coalesce(F.sum(F.col("n") * F.length("syms")), F.lit(0))).first()[0]
    work = work.filter(F.length("syms") > 1)
    counts = cut_lineage(pair_table(work))
    heap = cut_lineage(counts.filter((F.col("f") >= 2) & (F.col("r") != END_ID)))
    merges = list(model.merges)
    first = next_id = max([model.first_merge_id] + [n + 1 for _l, _r, n, _f, _t in model.merges])
    rounds = 0
    keep: list[DataFrame] = []
    while True:
        best = heap.join(counts, ["l", "r", "f"]).orderBy(F.desc("f"), "l", "r").limit(1)
        # what follows the symbol made last, the word end included, counts its occurrences
        made = counts.filter(F.col("l") == next_id - 1).agg(F.coalesce(F.sum("f"), F.lit(0)).alias("f")) \
            .select(F.lit(-1).alias("l"), F.lit(-1).alias("r"), "f")
        rows = best.unionByName(made).collect()
        if next_id > first:
            tokens -= next(r["f"] for r in rows if r["l"] == -1)
            merges[-1] = (*merges[-1][:4], tokens)
        found = [r for r in rows if r["l"] >= 0]
        if next_id >= vocab_size or not found or found[0]["f"] < 2:
            break
        a, b, f = found[0]["l"], found[0]["r"], found[0]["f"]
        merges.append((a, b, next_id, f, 0))
        change = pair_change(work, [(a, b, next_id)]).persist()
        is_best = (F.col("l") == a) & (F.col("r") == b)
        counts = add_change(counts, change).filter(~is_best).persist()
        raised = change.filter((F.col("f") > 0) & ~is_best & (F.col("r") != END_ID)).select("l", "r")
        after_best = (F.col("f") < f) | ((F.col("f") == f) & ((F.col("l") > a) | ((F.col("l") == a) & (F.col("r") > b))))
        heap = heap.filter(after_best).unionByName(raised.join(counts, ["l", "r"])).distinct().persist()
        work = work.select(F.replace(F.col("syms"), F.lit(sym(a) + sym(b)), F.lit(sym(next_id))).alias("syms"), "n") \
            .filter(F.length("syms") > 1).persist()
        keep += [change, counts, heap, work]
        next_id += 1
        rounds += 1
        if rounds % checkpoint_every == 0:
            work, counts, heap = cut_lineage(work), cut_lineage(counts), cut_lineage(heap)
            for d in keep:
                d.unpersist()
            keep = []
    for d in keep:
        d.unpersist()
    out = BpeModel(specials=model.specials, merges=merges, byte_offset=model.byte_offset, alphabet=model.alphabet,
                   extra_vocab=model.extra_vocab)
    out.rounds = rounds  # type: ignore[attr-defined]
    return out
