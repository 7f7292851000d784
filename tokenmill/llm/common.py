"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tokenmill.session import cut_lineage, ensure_checkpoint_dir  # noqa: F401

#: Arrow batches between Spark and Python hold at most this many rows, so
#: that a batch of very long texts still fits a worker.
BATCH_ROWS = 512
BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts can be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows of a table that came in fewer splits than the cluster has
    cores to all of them; tables in many splits stay as they are. Rows keep
    their ids, so results do not depend on it."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str | StructType) -> DataFrame:
    """Narrow map: ``fn`` gets one Arrow batch and returns column lists or arrays.
    Tables with columns of the caller pass a ``StructType``: any name and type goes."""
    names = schema.names if isinstance(schema, StructType) else [
        f.strip().split(" ")[0].strip("`") for f in _fields(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            out = fn(b)
            yield pa.RecordBatch.from_arrays([_arrow(out[n]) for n in names], names=names)

    return df.mapInArrow(run, schema)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores added until no column in ``taken`` has it (Spark
    ignores case in names)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def _arrow(x):
    return x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x)


def _fields(schema: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            out.append(cur)
            cur = ""
        else:
            cur += ch
    return [*out, cur]


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text of an Arrow string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
