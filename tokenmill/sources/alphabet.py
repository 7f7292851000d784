"""The byte <-> printable character bijection as a 256-row table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.constants import PRINTABLE_BYTE_RANGES


def byte_alphabet(spark: SparkSession) -> DataFrame:
    """``(byte INT, ch STRING)``: printable bytes keep their code point,
    the other 68 take U+0100.. in byte order."""
    b = F.col("id").cast("int")
    keep = None
    for lo, hi in PRINTABLE_BYTE_RANGES:
        cond = b.between(lo, hi)
        keep = cond if keep is None else (keep | cond)
    # rank of a non-printable byte among the non-printable ones, from a running count
    not_keep = F.when(keep, 0).otherwise(1)
    from pyspark.sql import Window
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    df = spark.range(256).select(F.col("id"), keep.alias("keep"),
                                 (F.sum(not_keep).over(w) - 1).alias("k"))
    cp = F.when(F.col("keep"), F.col("id")).otherwise(F.lit(256) + F.col("k"))
    ch = F.decode(F.unhex(F.lpad(F.hex(cp), 4, "0")), "UTF-16BE")
    return df.select(F.col("id").cast("int").alias("byte"), ch.alias("ch"))
