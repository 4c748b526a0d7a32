"""Session settings and lineage cuts."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A fact join is followed by work on the same key; splitting a hot key is worth
    # one more exchange there.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Steps that run side by side share the executors.
    "spark.scheduler.mode": "FAIR",
}


def build_session(
    app: str = "martworks",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach. The cluster names it in
    ``spark.checkpoint.dir``; only a local session may fall back to a fresh
    temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    spark = df.sparkSession
    directory = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(directory)
    return df.checkpoint(eager=True)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder and read back as Parquet, which keeps
    statistics and column pruning for everything that reads it; removed on leaving."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark then removes the shuffle files of steps that
    nothing refers to any more, which bounds the disk a run of several steps takes. The JVM is
    told of what Python has let go by a thread that needs a moment."""
    gc.collect()
    for _ in range(2):
        time.sleep(0.5)
        spark._jvm.java.lang.System.gc()


def concurrently(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run independent steps side by side, each with its jobs in a pool of its own, and give
    their results in order. Spark's own scheduler shares the executors among the pools. Job
    group and other local properties of the caller are inherited. All steps come to an
    end before the first error is raised."""

    def own(number: int, step: Callable[[], object]):
        def run():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"step-{number}")
            return step()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max(1, len(steps))) as threads:
        futures = [threads.submit(own(i, s)) for i, s in enumerate(steps)]
    return [f.result() for f in futures]
