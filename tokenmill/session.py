"""Spark session helpers: sane defaults and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # checkpoint files go when the table that wrote them is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "tokenmill",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults.

    On a cluster, leave ``master`` unset and let spark-submit decide.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", os.environ.get("TOKENMILL_DRIVER_MEM", "16g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``df.checkpoint()`` has a reliable folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that
    setting always wins. Only a local-mode session without one (tests,
    the bench) gets a fresh folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative jobs need a shared "
            "checkpoint folder on a cluster")
    local_dir = tempfile.mkdtemp(prefix="tokenmill-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


ARROW_ROWS = 2048           # rows and bytes of an Arrow batch between Spark and Python at most
ARROW_BYTES = 2 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose Arrow batches are held to a size that does not depend on how long texts are."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df


class session_conf:
    """Temporarily set SQL confs (restored on exit)."""

    def __init__(self, spark: SparkSession, conf: dict[str, str]):
        self.spark, self.conf, self.old = spark, conf, {}

    def __enter__(self):
        for k, v in self.conf.items():
            self.old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False
