"""Repeated passages by content-defined chunks.

A gear rolling hash over the last 16 bytes is taken at every byte, and a text is cut where
the hash is the least of some ``REACH`` neighbours: cuts depend on the text near them only
and come back after an insertion, so the same passage has the same chunks wherever it
stands. Chunks whose digest two documents hold are candidates.

A passage is a stretch of text each word of which lies in ``MIN_WORDS`` words that another
document holds too, byte by byte. Runs of candidates are extended to their true bounds by the
windows of so many words around them, all of whose inner chunks are candidates: these are
compared by digest, one for each word they begin at, and those that two documents hold are
joined to passages. The document with the smallest id keeps a window, the others may lose it.

Every ``REACH`` bytes have a cut, so 16 + 2 * REACH equal bytes have two in common and a
whole chunk between them; ``MIN_WORDS`` words are never shorter, and no window is missed. A
run of one byte again and again is not cut inside. What is said of digests is summed
before it is shuffled, and a digest that very many documents hold costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm import common
from martworks.sources import files

#: Each so many bytes have a cut; a chunk without one ends after MOST bytes.
REACH, MOST = 40, 160
WINDOW = 16
#: Words that have to be the same for a passage.
MIN_WORDS = 51

_GEAR = (common._constants(256, 41) >> np.uint64(48)).astype(np.uint16)


def gear(raw: np.ndarray) -> np.ndarray:
    """At each byte the hash of the WINDOW bytes up to it: each byte's gear value, shifted
    by one bit for each byte since. Summed by doubling windows."""
    h = _GEAR[raw]
    for shift in (1, 2, 4, 8):
        before = np.concatenate((np.zeros(min(shift, len(h)), np.uint16), h[:-shift]))
        h = h + (before << np.uint16(shift))
    return h


def _slide(values: np.ndarray, least, size: int) -> np.ndarray:
    """``least`` of each ``size`` neighbours, by doubling."""
    done = 1
    while done * 2 <= size:
        values = least(values[:-done], values[done:])
        done *= 2
    return least(values[: len(values) - (size - done)], values[size - done :]) if done < size else values


def cuts(raw: np.ndarray, offsets: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Ends of all chunks of the texts that ``offsets`` divides ``raw`` into. Characters
    are not cut. No hash looks back over the start of its text."""
    hashes = gear(raw).astype(np.uint32) + np.uint32(1)
    solid = np.ones(len(raw), bool)
    solid[1:] = (raw[1:] != raw[:-1]) | (hashes[1:] != hashes[:-1])
    marks = np.zeros(0, np.int64)
    if len(raw) >= reach:
        least = _slide(hashes, np.minimum, reach)
        inside = np.zeros(len(least), bool)  # neighbours that lie in one text, as do their hashes
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            inside[start + WINDOW - 1 : max(start, end - reach + 1)] = True
        least[~inside] = 0
        edge = np.zeros(reach - 1, np.uint32)
        most = _slide(np.concatenate((edge, least, edge)), np.maximum, reach)
        marks = np.flatnonzero((hashes == most) & solid) + 1
    ends = np.union1d(marks, offsets[1:][np.diff(offsets) > 0])
    before = np.concatenate(([0], ends[:-1]))
    extra = (ends - before - 1) // MOST
    if extra.any():
        first = np.repeat(before, extra)
        nth = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        ends = np.union1d(ends, first + nth * MOST)
    inner = np.flatnonzero((raw & 0xC0) == 0x80)  # bytes within a character
    while len(ends):
        inside = (ends < len(raw)) & np.isin(ends, inner)
        if not inside.any():
            break
        ends = np.unique(ends + inside)
    return ends


_BYTE = common._constants(256, 43)
_BASE = 0x9E3779B97F4A7C15 | 5
_BACK = pow(_BASE, -1, 1 << 64)


class _Text:
    """Words of the texts of a slice and digests of windows of them, byte by byte."""

    def __init__(self, texts: pa.Array, words: int) -> None:
        self.reach = max(2, min(REACH, (2 * words - 1 - WINDOW) // 2))
        self.raw, self.offsets = common.text_bytes(texts)
        self.starts, self.ends, self.places = common.word_bounds(self.raw, self.offsets)
        powers = np.full(len(self.raw), np.uint64(_BASE))
        powers = np.multiply.accumulate(powers)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[self.raw] * powers, dtype=np.uint64)))
        self.back = np.multiply.accumulate(np.full(len(self.raw) + 1, np.uint64(_BACK)))

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Digests of the bytes from ``a`` up to ``b``."""
        sums = (self.sums[b] - self.sums[a]) * self.back[a]
        return common.mix(sums + (b - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def digests(self, first: np.ndarray, words: int) -> np.ndarray:
        """Of the windows that begin at the words ``first``."""
        return self.spans(self.starts[first], self.ends[first + words - 1])

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends and digests of all chunks, and the place of each text's first among them (one
        more entry at the end)."""
        ends = cuts(self.raw, self.offsets, self.reach)
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        return ends, self.spans(begins, ends), np.searchsorted(ends, self.offsets, side="right")

    def candidates(self, i: int, begins: np.ndarray, ends: np.ndarray, hit: np.ndarray, words: int) -> np.ndarray:
        """First words of the windows of text ``i`` that may stand elsewhere, by its chunks and
        whether other documents hold them. Where a window is equal, so are the chunks that lie
        ``reach`` bytes inside it: all of these have to be held, and one chunk at least."""
        a, b = int(self.places[i]), int(self.places[i + 1])
        if b - a < words or not hit.any():
            return np.zeros(0, np.int64)
        first = np.arange(a, b - words + 1)
        starts, stops = self.starts[first], self.ends[first + words - 1]

        def within(low: np.ndarray, high: np.ndarray, which: np.ndarray) -> np.ndarray:
            """How many of ``which`` chunks lie between ``low`` and ``high``."""
            counts = np.concatenate(([0], np.cumsum(which)))
            x, y = np.searchsorted(begins, low, side="left"), np.searchsorted(ends, high, side="right")
            return counts[np.maximum(x, y)] - counts[x]

        inside = self.reach + 4  # an end may be moved to the end of its character
        lost = within(starts + WINDOW + inside, stops - inside, ~hit)
        return first[(lost == 0) & (within(starts, stops, hit) > 0)]


def _chunk(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Digests of the chunks of each text."""
    for batch in common.chunks(batches, "text"):
        _, digests, places = _Text(batch.column("text"), words).chunks()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("h"),
                pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(digests.view(np.int64))),
            ],
            names=["doc_id", "h", "digests"],
        )


_WINDOWS = "doc_id long, digests array<long>, at array<int>, starts array<int>, ends array<int>, c0 array<int>, c1 array<int>"


def _window(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The windows around runs of chunks that other documents hold too, of rows with text and
    the places of such chunks."""
    for batch in common.chunks(batches, "text"):
        text = _Text(batch.column("text"), words)
        ends, _, places = text.chunks()
        begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
        firsts = []
        for i in range(batch.num_rows):
            x, y = int(places[i]), int(places[i + 1])
            hit = np.zeros(y - x, bool)
            hit[batch.column("hits")[i].values.to_numpy()] = True
            firsts.append(text.candidates(i, begins[x:y], ends[x:y], hit, words))
        sizes = np.array([len(x) for x in firsts])
        first = np.concatenate(firsts)
        a, b = text.starts[first], text.ends[first + words - 1]
        points = np.concatenate(([0], np.cumsum((text.raw & 0xC0) != 0x80)))
        base = np.repeat(points[text.offsets[:-1]], sizes)
        values = (
            text.digests(first, words).view(np.int64), first - np.repeat(text.places[:-1], sizes), points[a] - base,
            points[b] - base, np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b - 1, side="right"),
        )
        at = pa.array(np.cumsum([0, *sizes]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.ListArray.from_arrays(at, pa.array(x if j == 0 else x.astype(np.int32))) for j, x in enumerate(values)),
            ],
            names=["doc_id", "digests", "at", "starts", "ends", "c0", "c1"],
        )


def _repeated(rows: DataFrame) -> DataFrame:
    """Digests that two documents or more hold, of rows (doc_id, digests), and the smallest."""
    return (
        rows.select("doc_id", F.explode(F.array_distinct("digests")).alias("digest"))
        .groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").select("digest", "first")
    )


def passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of ``docs`` (doc_id, text) that other documents hold too, one row each:
    doc_id, start and end (code points, end exclusive), n_words, n_chunks (all that it
    touches), first_doc_id (the smallest id that holds any ``min_words`` words of it), cut
    (array of the parts, as start and end, that a smaller id holds already), first
    (nothing is cut).

    Null and short texts have no passages. Rows that share a doc_id are one document: what
    repeats only among them is no repeat, and each row's passages are listed. Rows
    without doc_id are left out. Other columns are ignored. A document without a
    repeated passage has no row; an empty table gives an empty result."""
    path = common.folder(docs.sparkSession)
    texts = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("h"),  # rows with one id and text have the same marks
    )
    chunks = common.stored(
        texts.mapInArrow(lambda x: _chunk(x, min_words), "doc_id long, h long, digests array<long>"), f"{path}/chunks"
    )
    hits = common.stored(
        chunks.select("doc_id", "h", F.posexplode("digests").alias("k", "digest"))
        .join(_repeated(chunks).select("digest"), "digest", "left_semi")
        .groupBy("doc_id", "h").agg(F.sort_array(F.collect_list("k")).alias("hits")),
        f"{path}/hits",
    )
    del chunks
    files.delete(docs.sparkSession, f"{path}/chunks")
    common.let_go(docs.sparkSession)
    windows = common.stored(
        texts.join(hits, ["doc_id", "h"]).select("doc_id", "text", "hits")
        .mapInArrow(lambda x: _window(x, min_words), _WINDOWS)
        .withColumn("row", F.monotonically_increasing_id()),
        f"{path}/windows",
    )
    common.let_go(docs.sparkSession)
    held = (
        windows.select("row", F.posexplode("digests").alias("k", "digest")).join(_repeated(windows), "digest")
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "first"))).alias("held"))
        .select("row", F.col("held.k").alias("k"), F.col("held.first").alias("first"))
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "end", "n_words", "n_chunks", "first_doc_id", "cut", "first"]
        for batch in batches:
            out: list[tuple] = []
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                get = lambda c: batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                k, first = get("k"), get("first")
                at, starts, ends, c0, c1 = (get(c)[k] for c in ("at", "starts", "ends", "c0", "c1"))
                # Windows that share a word are one passage.
                breaks = np.flatnonzero(np.diff(at) >= min_words) + 1
                for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(k)]):
                    cut: list[list[int]] = []
                    for j in (a + np.flatnonzero(first[a:b] < doc_id)).tolist():
                        x, y = int(starts[j]), int(ends[j])
                        if cut and x <= cut[-1][1]:
                            cut[-1][1] = y
                        else:
                            cut.append([x, y])
                    n_words, n_chunks = int(at[b - 1] - at[a]) + min_words, int(c1[b - 1] - c0[a]) + 1
                    out.append(
                        (doc_id, int(starts[a]), int(ends[b - 1]), n_words, n_chunks, int(first[a:b].min()), cut, not cut)
                    )
            types = [pa.int64()] * 6 + [pa.list_(pa.list_(pa.int64())), pa.bool_()]
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return windows.drop("digests").join(held, "row").mapInArrow(
        runs,
        "doc_id long, start long, end long, n_words long, n_chunks long, first_doc_id long, "
        "cut array<array<bigint>>, first boolean",
    )


def cleaned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the parts that ``found`` (of passages()) cuts; all rows and other
    columns stay. doc_id has to be unique where text is cut."""
    parts = found.groupBy("doc_id").agg(F.sort_array(F.flatten(F.collect_list("cut"))).alias("_cut"))
    kept = F.aggregate(
        "_cut",
        F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")),
        lambda a, c: F.struct(
            F.concat(a["text"], F.substr("text", (a["at"] + 1).cast("int"), (F.get(c, F.lit(0)) - a["at"]).cast("int"))).alias("text"),
            F.get(c, F.lit(1)).alias("at"),
        ),
        lambda a: F.concat(a["text"], F.substr("text", (a["at"] + 1).cast("int"))),
    )
    text = F.when(F.size("_cut") > 0, kept).otherwise(F.col("text"))
    return docs.join(parts, "doc_id", "left").select(
        *(text.alias("text") if c == "text" else F.col(c) for c in docs.columns)
    )
