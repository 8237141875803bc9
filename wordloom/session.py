"""Session helpers: building a local session for tests/bench, finding the
shared checkpoint folder that iterative jobs use to cut lineage, and the tables
and shuffle files that a job leaves there."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, partitions: int = 8, app: str = "wordloom") -> SparkSession:
    """A session tuned for the operators in this package.

    AQE stays on so skewed word / context keys are split at run time
    (``skewJoin``) and small shuffles are coalesced.  On a cluster the
    caller's own settings (shuffle partitions, checkpoint dir) win because
    ``getOrCreate`` returns the existing session.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("WORDLOOM_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared file system
    (HDFS / object store); a machine-local folder would lose checkpoints with
    the executor.  A private temp folder is only created for local masters
    (tests, bench), never on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster"
        )
    local_dir = tempfile.mkdtemp(prefix="wordloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Shuffle files of the queries run inside are removed as each one ends,
    not when the driver collects garbage.  Lost ones are made again as usual
    while a query runs; its result must be written or collected inside."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_blocks: list[list[str]] = []  # open blocks of ``working_tables`` with the folders they remove


@contextmanager
def working_tables(spark: SparkSession):
    """Tables that ``written`` makes inside are removed at the end: what
    outlives the block must be written for a block further out, or for ever."""
    _blocks.append([])
    try:
        yield
    finally:
        for path in _blocks.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, name: str, *by: str, ends: int | None = 1) -> DataFrame:
    """``df`` written once under the shared folder and read back; its shuffle
    files go.  It is removed with the block ``ends`` steps out (1: the innermost;
    None, or no such block: never)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if ends and ends <= len(_blocks):
        _blocks[-ends].append(path)
    with shuffles_released(spark):
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
