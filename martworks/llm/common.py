"""What several corpus operators share: stored steps, token arrays, connected groups."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.session import shared_dir

#: Working memory of a Python step follows the bytes of text it holds at once.
CHUNK_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def crc_mod(column: Column, m: int) -> Column:
    """crc32 of the value as text, modulo ``m``; null for null."""
    return F.crc32(column.cast("string")) % F.lit(m)


def folder(spark: SparkSession) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a step once and go on from the file: the lineage ends here."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Have the driver collect its garbage: Spark then removes the shuffle files of steps that
    nothing refers to any more. Between stored steps of a job this bounds the disk it takes.
    The JVM is told of what Python has let go by a thread that needs a moment."""
    gc.collect()
    for _ in range(3):
        time.sleep(1)
        spark._jvm.java.lang.System.gc()


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_bytes(batch.column(text))[1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    release()


def gathered(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def release() -> None:
    """Give memory back to the system that this worker has used and freed: it waits idle
    for its next task beside other processes."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts together and the offsets of each; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = _constants(256, 11)
_STEP = np.uint64(0x5851F42D4C957F2D)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` in bytes, and the place of
    each text's first word among them (one more entry at the end)."""
    solid = ~_SPACE[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    before = np.concatenate(([False], solid[:-1])) if len(raw) else solid
    after = np.concatenate((solid[1:], [False])) if len(raw) else solid
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, with A-Z in lower case, and the place of
    each text's first word among them (one more entry at the end)."""
    raw, offsets = text_bytes(texts)
    starts, ends, places = word_bounds(raw, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), places
    lengths = ends - starts
    powers = np.full(int(lengths.max()), _STEP)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inside = np.zeros(len(raw) + 1, dtype=np.int32)
    inside[starts] = 1
    number = np.cumsum(inside[:-1]) - 1
    at = np.arange(len(raw)) - starts[np.maximum(number, 0)]
    solid = ~_SPACE[raw] & (number >= 0)
    at[~solid] = 0
    parts = _BYTE[_LOWER[raw]] * powers[at]
    parts[~solid] = 0
    sums = np.add.reduceat(parts, starts)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), places


_SHINGLE = 5
_PLACE = _constants(_SHINGLE, 23) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct five-word shingles; a text with one to four
    words has its whole sequence as its only shingle, one without words has none."""
    words, places = word_hashes(texts)
    n = len(words) - _SHINGLE + 1
    if n > 0:
        sums = sum(words[j : j + n] * _PLACE[j] for j in range(_SHINGLE))
        sums = mix(sums)
    sets = []
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        if b - a >= _SHINGLE:
            sets.append(np.unique(sums[a : b - _SHINGLE + 1]))
        elif b > a:
            short = (words[a:b] * _PLACE[: b - a]).sum(keepdims=True, dtype=np.uint64)
            sets.append(mix(short + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def components(edges: DataFrame, path: str) -> DataFrame:
    """Groups that ``edges`` (a, b: long) connect: (id, component) for every id but the
    smallest of its group, which is the component. Alternates large-star and small-star steps until nothing changes;
    each step is a distributed aggregation and join, stored in the shared folder.
    Minima are combined before they are shuffled, so a hub costs one row per task."""
    step = 0

    def save(df: DataFrame) -> tuple[DataFrame, tuple]:
        nonlocal step
        df = stored(df.where("a <> b").distinct(), f"{path}/{step}")
        step += 1
        seen = df.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        return df, tuple(seen)

    graph, seen = save(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )
    while seen[0]:
        both = graph.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            graph.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large, _ = save(
            both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small, now = save(
            large.join(below, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(below.select("a", F.col("m").alias("b")))
        )
        if now == seen:
            break
        graph, seen = small, now
    return (
        graph.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
    )


#: Bounds of a batch that goes to Python, in place of Spark's defaults of 10,000 rows of
#: any size; a value that the session has set otherwise stays.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": (str(2**31 - 1), str(16 << 20)),
}


def prepare(spark: SparkSession) -> None:
    """Bound the batches that go to Python, and give the executors this package where
    their Python does not find it by itself."""
    for key, (default, own) in BATCHES.items():
        if spark.conf.get(key, default) in (default, f"{default}b"):
            spark.conf.set(key, own)
    root = Path(__file__).resolve().parents[2]
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if any(p and Path(p).resolve() == root for p in known) or "site-packages" in root.parts:
        return
    if getattr(spark.sparkContext, "_martworks_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "martworks.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "martworks").rglob("*.py")):
            out.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    spark.sparkContext._martworks_shipped = True
