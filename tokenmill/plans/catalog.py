"""Registered queries: one Spark job per operator of the inventory, each
with (where SQL can say it) the DuckDB statement that must give the same
rows. ``__spark_entry__`` exposes both dictionaries.

Every query reads whole tables of a data directory; nothing is sampled,
capped or filtered by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tokenmill.plans import (  # noqa: F401
        q_text, q_stats, q_train, q_codec, q_windows, q_vectors,
    )
