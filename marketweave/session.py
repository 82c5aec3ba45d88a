"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Limits of any size are taken inside the map tasks; Spark stops at 1000 by itself.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2000000000",
    # Recording a call site per expression takes longer than building the plans here.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, app: str = "marketweave", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh path under the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a local session may
    go without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: no shared folder for stage tables")
        root = tempfile.mkdtemp(prefix="marketweave-")
    return f"{root.rstrip('/')}/marketweave-{uuid.uuid4().hex}"


#: Bytes of rows in a batch that goes to a Python worker.  The JVM holds up to three times that
#: beside its heap for each task, and the worker a copy; Spark's own limits are 64 MB and 10,000 rows.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


@contextmanager
def small_batches(spark: SparkSession):
    """What runs inside sends its Python workers batches of at most BATCH bytes, for rows with whole texts."""
    key, size = BATCH
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write a stage table to the shared folder and read it back.

    Later stages start from files, so a lost executor costs a re-read, not a re-parse.
    Zstandard keeps the folder small, and readers free its buffers at once.
    """
    spark = df.sparkSession
    path = f"{root or shared_dir(spark)}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

