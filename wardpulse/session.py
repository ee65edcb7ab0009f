"""Session construction and cluster-safe defaults."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that make the plans behave the same on local[N] and on a cluster:
# AQE re-plans joins from runtime sizes, splits skewed shuffle partitions and
# coalesces small ones; ANSI stays on (failed casts are written as try_cast).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of unreferenced data are deleted (long-running sessions)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "wardpulse",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only a local session that names none (tests, a laptop) gets ``fallback``;
    on a cluster each machine has its own disk, so there it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), "wardpulse-ckpt")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the checkpoint folder and read: what is read more
    than once, in columns and compressed."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of rows for each byte of a Parquet file: ward-years of few values take 10 to 40.
ROWS_BYTES = "32"


@contextmanager
def sized_by_rows(spark: SparkSession) -> Iterator[None]:
    """What is planned meanwhile takes a file for as large as its rows. By the size of the
    file alone a join broadcasts, through the driver, far more than the limit for it; a
    side that is small as it runs is still broadcast by AQE."""
    key = "spark.sql.sources.fileCompressionFactor"
    before = spark.conf.get(key)
    spark.conf.set(key, max(before, ROWS_BYTES, key=float))
    try:
        yield
    finally:
        spark.conf.set(key, before)
