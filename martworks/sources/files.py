"""Directory operations through the Hadoop file system of the session, so every URI
scheme the cluster knows (local, object store) works the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and what counts its rows while it is written: no read after the write."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_of(seen: Observation) -> int:
    return seen.get["rows"]


def _path(spark: SparkSession, uri: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _path(spark, uri)
    return fs.exists(path)


def any_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or anything that a glob names, is there."""
    fs, path = _path(spark, pattern)
    return bool(fs.globStatus(path))


def delete(spark: SparkSession, uri: str) -> bool:
    """Remove a directory tree that this package wrote."""
    fs, path = _path(spark, uri)
    return fs.delete(path, True)


def partition_values(spark: SparkSession, uri: str, column: str) -> list[str]:
    """Values of the ``column=value`` directories directly under ``uri``. One listing
    of the top level; no file is opened."""
    fs, path = _path(spark, uri)
    if not fs.exists(path):
        return []
    prefix = f"{column}="
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix))


def stored_bytes(spark: SparkSession, uri: str) -> int:
    """Bytes of all files below ``uri``, from its listing."""
    fs, path = _path(spark, uri)
    return fs.getContentSummary(path).getLength()


def data_files(spark: SparkSession, uri: str, pattern: str = "*.parquet") -> DataFrame:
    """``(path, length)`` of the files below ``uri``. The reader lists in parallel and
    never opens the files, because their content is not selected."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(uri)
        .select("path", "length")
    )


def storage_metrics(spark: SparkSession, uri: str, pattern: str = "*.parquet") -> DataFrame:
    """Objects, partitions and bytes below ``uri``: one row."""
    directory = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    partition = F.when(directory.rlike(r"/[^/=]+=[^/]*$"), directory)
    return data_files(spark, uri, pattern).agg(
        F.count(F.lit(1)).alias("objects"),
        F.count_distinct(partition).alias("partitions"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )
