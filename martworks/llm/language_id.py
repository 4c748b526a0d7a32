"""Language identification by nearest centroids.

A text is a vector of hashed byte trigrams of its lower-case letters, words set off by
blanks: logarithmic counts times inverse document frequency, scaled to length one. Each
language has several centroids, found by clustering its training vectors by cosine; a
text gets the language of the nearest one. It is rejected when its cosine with that
centroid is far below what the language's training texts have.

The model is fitted on at most about ``SAMPLE`` labelled rows, an equal share for each
language, chosen by a hash of the id; only their sparse counts come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

DIMENSIONS = 4096
CENTROIDS = 4
#: Bound of the labelled rows that the model is fitted on.
SAMPLE = 4000
#: A text is rejected below this part of the cosine that nearly all (1 - TAIL) training
#: texts of the language reach.
TAIL, SLACK = 0.002, 0.5

_LETTER = np.full(256, 32, dtype=np.uint32)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Counts by text and hashed trigram, as one dense block."""
    lower = pc.utf8_lower(texts.fill_null("").cast(pa.large_string()))
    raw, offsets = common.text_bytes(lower)
    n = len(texts)
    b = np.concatenate(([32], _LETTER[raw], [32])).astype(np.uint32)
    bounds = np.zeros(len(b), dtype=bool)
    bounds[offsets + 1] = True  # no trigram runs over the end of a text
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    real = (b[1:-1] != 32) & ~(bounds[1:-1] & (b[:-2] != 32)) & ~(bounds[2:] & (b[2:] != 32))
    code = (code[real] * np.uint32(0x9E3779B1)) >> np.uint32(20)
    row = np.repeat(np.arange(n), np.diff(offsets))[real] if len(raw) else np.zeros(0, np.int64)
    return np.bincount(row * DIMENSIONS + code, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray  # cosine below which a text is rejected, by centroid

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts.astype(np.float32)) * self.idf
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, norm, out=x, where=norm > 0)


def _clusters(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centroids by spherical k-means, started far apart from each other."""
    random = np.random.default_rng(seed)
    centres = [x.mean(axis=0)]
    nearest = x @ centres[0]
    while len(centres) < min(k, len(x)):
        chance = np.clip(1 - nearest, 0, None) ** 2
        pick = random.choice(len(x), p=chance / chance.sum()) if chance.sum() > 0 else random.integers(len(x))
        centres.append(x[pick])
        nearest = np.maximum(nearest, x @ centres[-1])
    c = np.stack(centres)
    for _ in range(15):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = np.argmax(x @ c.T, axis=1)
        c = np.stack([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in common.chunks(batches, "text"):
        at, n = [], []
        for counts in trigram_counts(chunk.column("text")):
            places = np.flatnonzero(counts)
            at.append(places.astype(np.uint16).tobytes())
            n.append(counts[places].astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [chunk.column("lang"), chunk.column("h"), pa.array(at, pa.binary()), pa.array(n, pa.binary())],
            names=["lang", "h", "at", "n"],
        )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )


def fit(docs: DataFrame, learn: Column | None = None, sample: int = SAMPLE) -> Model | None:
    """A model of the labelled rows of ``docs`` (doc_id, text, lang) for which ``learn``
    holds; None if there are none. Rows without text, letters, doc_id or lang don't count."""
    rows = _rows(docs)
    rows = rows.where("lang is not null and doc_id is not null")
    if learn is not None:
        rows = rows.where(learn)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = max(20, sample // len(sizes))
    hashed = F.xxhash64("doc_id", F.lit(77))
    # 2^20 hash values; a rate for each language that leaves about its share of rows.
    rate = F.create_map(*(F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1.0, share / n))))
    picked = rows.where(F.pmod(hashed, F.lit(1 << 20)) < rate[F.col("lang")] * (1 << 20))
    counted = picked.select("lang", hashed.alias("h"), "text").mapInArrow(
        _sparse, "lang string, h long, at binary, n binary"
    )
    got = counted.where(F.length("at") > 0).orderBy("h", "lang", "at", "n").limit(2 * sample).collect()
    if not got:
        return None
    counts = np.zeros((len(got), DIMENSIONS), dtype=np.int32)
    for i, r in enumerate(got):
        counts[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["n"], np.int32)
    idf = np.log(1 + len(got) / (1 + (counts > 0).sum(axis=0))).astype(np.float32)
    model = Model([], np.zeros((0, DIMENSIONS), np.float32), idf, np.zeros(0))
    x = model.vectors(counts)
    labels = np.array([r["lang"] for r in got])
    centroids, least = [], []
    for lang in sorted(set(labels.tolist())):
        own = x[labels == lang]
        c = _clusters(own, CENTROIDS)
        centroids.append(c)
        model.languages += [lang] * len(c)
        least += [SLACK * float(np.quantile((own @ c.T).max(axis=1), TAIL))] * len(c)
    model.centroids = np.concatenate(centroids).astype(np.float32)
    model.least = np.array(least)
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (cosine with the nearest centroid), accepted, for every
    row of ``docs`` (doc_id, text). Only the text is used.

    A text that is null or has no letter, and any text without a model, gets ``und``, 0
    and is not accepted. Repeated rows are answered one by one, null ids stay, and an
    empty table gives an empty result."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in common.chunks(batches, "text"):
            n = chunk.num_rows
            best, score = np.zeros(n, np.int64), np.zeros(n)
            if model is not None:
                cosines = model.vectors(trigram_counts(chunk.column("text"))) @ model.centroids.T
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(n), best].astype(np.float64), 0, 1)
            letters = chunk.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            known = letters & (model is not None)
            names = [model.languages[i] if k else "und" for i, k in zip(best.tolist(), known.tolist())]
            accepted = known & (score >= model.least[best]) if model is not None else known
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array(names), pa.array(np.where(known, score, 0.0)), pa.array(accepted)],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    return rows.mapInArrow(label, "doc_id long, lang_pred string, score double, accepted boolean")


def accepted_rows(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose text the model accepts, with all their columns."""
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in common.chunks(batches, "text"):
            cosines = model.vectors(trigram_counts(chunk.column("text"))) @ model.centroids.T
            best = cosines.argmax(axis=1)
            yield chunk.filter(pa.array(cosines[np.arange(len(best)), best] >= model.least[best]))

    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    return lettered.where("false") if model is None else lettered.mapInArrow(keep, schema)
