"""Chat rendering of conversation turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.constants import CHAT_END, CHAT_START


def render_chat(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", add_generation_prompt: bool = True) -> DataFrame:
    """``<|im_start|>role\\ntext<|im_end|>\\n`` per turn in turn order, optionally
    followed by ``<|im_start|>assistant\\n``. One row per conversation:
    ``(conv_id, prompt, turns)``.

    Each turn is rendered in place (narrow); only the rendered pieces are
    gathered per conversation and sorted by turn.
    """
    piece = F.concat(F.lit(CHAT_START), F.coalesce(F.col(role), F.lit("")), F.lit("\n"),
                     F.coalesce(F.col(text), F.lit("")), F.lit(CHAT_END), F.lit("\n"))
    turns = df.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("t"), piece.alias("p")).alias("x"))
    g = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    joined = F.array_join(F.transform(F.col("xs"), lambda s: s["p"]), "")
    if add_generation_prompt:
        joined = F.concat(joined, F.lit(CHAT_START + "assistant\n"))
    return g.select("conv_id", joined.alias("prompt"), F.size("xs").cast("bigint").alias("turns"))
