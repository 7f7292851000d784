"""Corpus source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def spread(df: DataFrame, row_groups: bool = False) -> DataFrame:
    """Give a table that arrives in fewer splits than the cluster has cores
    (one small file, one row group) enough partitions for the text work.

    Files of ``row_groups`` are cut into splits by bytes, but a row group is read whole by one
    of them, so a large file can come in many splits of which few have rows. Rows
    are counted per split (footers only), and a table whose largest split is over a
    core's share and a quarter is dealt out as well.

    Large inputs already come in many even splits and are left untouched, so
    at scale this adds no shuffle. Rows carry their ids by then.
    """
    spark = df.sparkSession
    want, splits = spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if splits < want:
        return df.repartition(want)
    if row_groups:
        sizes = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
        rows, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
        if 4 * want * most > 5 * rows:
            return df.repartition(splits)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data directory."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), row_groups=True)


def _file_order_ids(df: DataFrame, columns: list) -> DataFrame:
    """``doc_id`` 0, 1, ... in the order of file path and place in the file,
    whatever the partitions: rows are numbered within their split, and the
    splits' sizes (one row per split) are summed in path and offset order."""
    split = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")]
    rows = df.select(*columns, *split, F.monotonically_increasing_id().alias("_row"))
    sizes = rows.groupBy("_path", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = sizes.select("_path", "_start", "_first", (F.sum("_n").over(Window.orderBy("_path", "_start"))
                                                        - F.col("_n")).alias("_before"))
    return rows.join(before, ["_path", "_start"]).withColumn(
        "doc_id", F.col("_before") + F.col("_row") - F.col("_first")).drop("_path", "_start", "_first", "_before", "_row")


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet",
                text_col: str = "text", title_col: str | None = None,
                id_col: str | None = "doc_id",
                max_examples: int | None = None, split: str | None = None,
                split_col: str = "split") -> DataFrame:
    """Load a corpus as ``(doc_id BIGINT, title STRING, text STRING)``.

    ``fmt`` is any Spark file format (parquet, json, orc, csv, text). For
    ``text`` each line is a document. Without an id column documents are
    numbered from 0 in file order. ``max_examples`` keeps the first N
    documents by id (``None`` or 0 = all); asking for more than exist
    returns them all. Only ids take part in finding the N-th one.

    ``split`` reads one split of a corpus folder that is partitioned by
    ``split_col`` (``split=train/``, ``split=test/``, ...): a partition filter, so files
    of other splits are never opened. A table that has ``split_col`` as a plain
    column is filtered by it; a corpus without it is refused.
    """
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.option("multiLine", "false")
    if fmt == "csv":
        reader = reader.option("header", "true")
    df = reader.load(path)
    if split is not None:
        if split_col not in df.columns:
            raise ValueError(f"{path} has no splits: there is no column {split_col!r}")
        df = df.filter(F.col(split_col) == split)
    if fmt == "text":
        text_col = "value"
    title = (F.col(title_col).cast("string") if title_col and title_col in df.columns
             else F.lit(None).cast("string"))
    columns = [title.alias("title"), F.col(text_col).cast("string").alias("text")]
    if id_col and id_col in df.columns:
        out = df.select(F.col(id_col).cast("bigint").alias("doc_id"), *columns)
        if max_examples:
            last = out.select("doc_id").orderBy("doc_id").limit(int(max_examples)).agg(F.max("doc_id")).first()[0]
            out = out.filter(F.col("doc_id") <= F.lit(last))
    else:
        out = _file_order_ids(df, columns).select("doc_id", "title", "text")
        if max_examples:
            out = out.filter(F.col("doc_id") < int(max_examples))
    return spread(out, row_groups=fmt in ("parquet", "orc") and id_col in df.columns)
