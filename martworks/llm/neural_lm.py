"""Language-model scores by a log-bilinear model, trained with noise-contrastive estimation.

Words are counted over all training texts. The ``WORDS`` most frequent ones are outputs of
their own; the others fall into classes by how often they occur (powers of two; words seen
once or never form one class), and a word's probability within its class is its share of
the class. The energy of an output w after the words h1 (last) and h2 (before it) is
r(h1) C1 q(w) + r(h2) C2 q(w) + b(w).

Training goes over every training token once, in ``ROUNDS`` rounds: each task runs
stochastic gradient steps of noise-contrastive estimation in numpy on its part of the
texts, and the tasks' parameters are averaged by their tokens before the next round. As the
energy adds up over context places, the normalisers of all contexts are one product of two
matrices of exponentials, and a token's exact log-probability is three table look-ups.

Texts are tokenised once, into blocks with numbers local to the block; the counts of a
block's distinct words come back to it by a join, so no vocabulary is ever held whole.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

WORDS = 1000
#: Frequency classes of the other words; the last one is open.
BANDS = 40
SIZE, NOISE, BATCH, RATE = 24, 64, 2048, 0.05
ROUNDS = 2
BLOCK_BYTES = 16 << 20
#: A word's place is its block's number and, in so many bits, its own in the block.
PLACE_BITS = 24
#: Places of the special outputs, then classes, then words.
START, END = 0, 1
FIRST_BAND = 2
FIRST_WORD = FIRST_BAND + BANDS
OUTPUTS = FIRST_WORD + WORDS

_BLOCK = (
    "block long, doc_ids array<long>, learn array<boolean>, sizes array<int>, codes binary, "
    "hashes array<long>, counts array<int>"
)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of texts: its distinct words with their training counts,
    and the texts as numbers of these words, small numbers for frequent ones."""
    number = 0
    for batch in common.gathered(batches, "text", BLOCK_BYTES):
        parts = [common.word_hashes(x.column("text")) for x in common.chunks([batch], "text")]
        words = np.concatenate([w for w, _ in parts])
        places = np.cumsum(np.concatenate(([0], *(np.diff(p) for _, p in parts))))
        distinct, codes, often = np.unique(words, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        distinct, codes = distinct[order], rank[codes]
        learn = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)
        sizes = np.diff(places)
        counts = np.bincount(codes[np.repeat(learn, sizes)], minlength=len(distinct))
        block = (batch.column("task")[0].as_py() << 16) + number
        number += 1
        common.release()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id")),
                pa.array([learn], pa.list_(pa.bool_())),
                pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([zlib.compress(codes.astype(np.int32).tobytes(), 1)], pa.binary()),
                pa.array([distinct.view(np.int64)], pa.list_(pa.int64())),
                pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
            ],
            names=["block", "doc_ids", "learn", "sizes", "codes", "hashes", "counts"],
        )


@dataclass
class Vocabulary:
    """What encodes a word with count c: its own place if it is one of the most frequent,
    else its class; and the base-10 logarithm of its share of the class."""

    words: np.ndarray  # hashes of the most frequent words, sorted
    places: np.ndarray  # their outputs
    shares: np.ndarray  # by class: log10 of one occurrence's (class 0: one word's) share
    counts: np.ndarray  # training tokens by output
    tokens: int  # all training tokens
    distinct: int

    def encode(self, hashes: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        band = np.clip(np.log2(np.maximum(c, 1)).astype(np.int64), 0, BANDS - 1)
        place = FIRST_BAND + band
        share = self.shares[band] + np.where(band > 0, np.log10(np.maximum(c, 1)), 0.0)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            own = self.words[at] == hashes
            place = np.where(own, self.places[at], place)
            share = np.where(own, 0.0, share)
        return place.astype(np.int16), share


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """From counts (h, c) of all training words and the number of training texts: the
    frequent words and a few sums come to the driver."""
    top = counts.orderBy(F.desc("c"), "h").limit(WORDS).collect()
    least = (top[-1]["c"], top[-1]["h"]) if top else (0, 0)
    rest = counts.where((F.col("c") < least[0]) | ((F.col("c") == least[0]) & (F.col("h") > least[1])))
    band = F.least(F.floor(F.log2(F.col("c").cast("double"))), F.lit(BANDS - 1)).cast("int")
    sums = rest.groupBy(band.alias("band")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    totals, kinds = np.zeros(BANDS), np.zeros(BANDS)
    for r in sums:
        totals[r["band"]], kinds[r["band"]] = r["c"], r["n"]
    # Words seen once share their class with all unseen ones, which count as one word.
    shares = -np.log10(np.maximum(totals, 1))
    shares[0] = -np.log10(kinds[0] + 1)
    by = np.zeros(OUTPUTS)
    by[END] = texts
    by[FIRST_BAND:FIRST_WORD] = totals
    hashes = np.array([r["h"] for r in top], np.int64)
    order = np.argsort(hashes)
    by[FIRST_WORD : FIRST_WORD + len(top)] = [r["c"] for r in top]
    return Vocabulary(
        hashes[order], (FIRST_WORD + np.arange(len(top)))[order], shares, by,
        int(by.sum()), int(len(top) + kinds.sum() + (texts > 0)),
    )


@dataclass
class Model:
    r: np.ndarray  # context vectors
    q: np.ndarray  # output vectors
    c: np.ndarray  # one matrix for each context place
    b: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Energies by context word and output for both places, the bias in the first;
        log-normalisers by pair of context words."""
        one = (self.r @ self.c[0]) @ self.q.T + self.b
        two = (self.r @ self.c[1]) @ self.q.T
        top1, top2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        z = np.log(np.maximum(np.exp(one - top1) @ np.exp(two - top2).T, 1e-300)) + top1 + top2.T
        return one, two, z


def start(counts: np.ndarray, seed: int = 1) -> Model:
    """A model that begins at the unigram distribution: its outputs START and those that
    never occur are left with a negligible probability."""
    rnd = np.random.default_rng(seed)
    p = np.maximum(counts, 0.5) / np.maximum(counts, 0.5).sum()
    p[START] = 1e-12
    return Model(
        rnd.normal(0, 0.3, (OUTPUTS, SIZE)), rnd.normal(0, 0.05, (OUTPUTS, SIZE)),
        np.stack([np.eye(SIZE), np.eye(SIZE)]), np.log(p),
    )


def _contexts(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last word and the one before it at each token of texts that begin at ``places``."""
    one = np.concatenate(([START], ids[:-1]))
    one[places] = START
    two = np.concatenate(([START], one[:-1]))
    two[places] = START
    return one, two


def _scatter(target: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    target[at[first]] += np.add.reduceat(rows[order], first, axis=0)


def train(model: Model, ids: np.ndarray, places: np.ndarray, counts: np.ndarray, seed: int) -> Model:
    """One pass of noise-contrastive estimation over the tokens, in shuffled batches. Each
    batch shares ``NOISE`` words drawn from the unigram distribution."""
    rnd = np.random.default_rng(seed)
    f = np.float32
    r, q, c, b = (x.astype(f) for x in (model.r, model.q, model.c, model.b))
    squares = [np.full(x.shape, 1e-2, f) for x in (r, q, c, b)]
    p = counts.astype(np.float64) / counts.sum()
    logkp = np.log(np.maximum(p, 1e-12) * NOISE).astype(f)
    one, two = _contexts(ids, places)
    cumulative = np.cumsum(p)
    for batch in np.array_split(rnd.permutation(len(ids)), max(1, -(-len(ids) // BATCH))):
        w, h1, h2 = ids[batch], one[batch], two[batch]
        noise = np.searchsorted(cumulative, rnd.random(NOISE) * cumulative[-1])
        r1, r2 = r[h1], r[h2]
        u = r1 @ c[0] + r2 @ c[1]
        # Derivatives of the loss by the energies of the data and of the noise.
        plus = 1 / (1 + np.exp(-(np.einsum("ij,ij->i", u, q[w]) + b[w] - logkp[w]))) - 1
        minus = 1 / (1 + np.exp(-(u @ q[noise].T + b[noise] - logkp[noise])))
        du = plus[:, None] * q[w] + minus @ q[noise]
        gr, gq, gb = np.zeros_like(r), np.zeros_like(q), np.zeros_like(b)
        _scatter(gq, np.concatenate((w, noise)), np.concatenate((plus[:, None] * u, minus.T @ u)))
        gb += np.bincount(w, plus, OUTPUTS).astype(f) + np.bincount(noise, minus.sum(axis=0), OUTPUTS).astype(f)
        _scatter(gr, np.concatenate((h1, h2)), np.concatenate((du @ c[0].T, du @ c[1].T)))
        gc = np.stack((r1.T @ du, r2.T @ du))
        scale = f(1 / len(batch))
        for x, g, s in zip((r, q, c, b), (gr, gq, gc, gb), squares):
            g *= scale
            s += g * g * f(100)
            x -= f(RATE) * g / np.sqrt(s) * f(10)
    return Model(*(x.astype(np.float64) for x in (r, q, c, b)))


def _flat(model: Model) -> np.ndarray:
    """One row for each output: context vector, output vector, bias; the matrices' rows
    lie at the end of the first rows."""
    out = np.zeros((OUTPUTS, 2 * SIZE + 1 + 2 * SIZE))
    out[:, :SIZE], out[:, SIZE : 2 * SIZE], out[:, 2 * SIZE] = model.r, model.q, model.b
    out[:SIZE, 2 * SIZE + 1 : 3 * SIZE + 1], out[:SIZE, 3 * SIZE + 1 :] = model.c
    return out


def _model(flat: np.ndarray) -> Model:
    return Model(
        flat[:, :SIZE], flat[:, SIZE : 2 * SIZE],
        np.stack((flat[:SIZE, 2 * SIZE + 1 : 3 * SIZE + 1], flat[:SIZE, 3 * SIZE + 1 :])), flat[:, 2 * SIZE],
    )


def fit(encoded: DataFrame, vocab: Vocabulary) -> Model:
    """A model trained on all rows of ``encoded`` (ids, learn) with ``learn``. What tasks
    send back is summed by output, a row for each output and task."""
    model = start(vocab.counts)
    if vocab.tokens == 0:
        return model
    width = _flat(model).shape[1]
    for turn in range(ROUNDS):
        now = model

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts, seed = [], turn
            sums, weight = np.zeros((OUTPUTS, width)), 0
            own = now

            def step() -> None:
                nonlocal own, weight
                ids = np.concatenate(texts).astype(np.int64)
                places = np.cumsum([0, *(len(x) for x in texts[:-1])])
                own = train(own, ids, places, vocab.counts, seed)
                weight += len(ids)
                texts.clear()

            held = 0
            for batch in batches:
                for x in batch.column("ids").to_pylist():
                    texts.append(np.frombuffer(x, np.int16))
                    held += len(texts[-1])
                    if held > 2_000_000:
                        step()
                        held = 0
            if texts:
                step()
            if weight:
                sums = _flat(own) * weight
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(OUTPUTS), pa.int64()),
                        pa.array([weight] * OUTPUTS, pa.int64()),
                        pa.array(list(sums), pa.list_(pa.float64())),
                    ],
                    names=["i", "weight", "v"],
                )

        rows = encoded.where("learn").where(F.pmod("row", F.lit(ROUNDS)) == turn).select("ids")
        sums = (
            rows.mapInArrow(part, "i long, weight long, v array<double>")
            .groupBy("i").agg(F.sum("weight").alias("weight"), *(F.sum(F.get("v", F.lit(j))).alias(f"v{j}") for j in range(width)))
            .collect()
        )
        if sums:
            flat = np.zeros((OUTPUTS, width))
            for x in sums:
                flat[x["i"]] = np.array(x[2:]) / x["weight"]
            model = _model(flat)
    return model


def scored(docs: DataFrame, learn: Column) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by what the rows with ``learn`` teach:
    doc_id, learn, n_tokens, n_known, train_tokens, base_score, score (base-10 logarithms
    of the text's probability: by add-one counts, and by the model).

    A null or empty text is its end token alone. Repeated rows are learned from and
    answered one by one; null ids stay. Without training rows every token is unseen.
    Other columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    path = common.folder(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"), F.spark_partition_id().cast("long").alias("task"),
    )
    blocks = common.stored(rows.mapInArrow(_blocks, _BLOCK), f"{path}/blocks")
    texts = blocks.agg(F.sum(F.size(F.filter("learn", lambda x: x)))).first()[0] or 0
    pairs = blocks.select(F.explode(F.arrays_zip("hashes", "counts")).alias("x"))
    counts = common.stored(
        pairs.select(F.col("x.hashes").alias("h"), F.col("x.counts").cast("long").alias("c"))
        .where("c > 0").groupBy("h").agg(F.sum("c").alias("c")),
        f"{path}/counts",
    )
    vocab = vocabulary(counts, texts)
    wanted = blocks.select("block", F.posexplode("hashes").alias("at", "h")).select(
        "h", F.shiftleft("block", PLACE_BITS).bitwiseOR(F.col("at").cast("long")).alias("place")
    )
    known = wanted.join(counts, "h").groupBy(F.shiftright("place", PLACE_BITS).alias("block")).agg(
        F.collect_list(F.struct("place", "c")).alias("known")
    ).select("block", F.col("known.place").alias("at"), F.col("known.c").alias("c"))
    total, distinct = vocab.tokens, vocab.distinct

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "learn", "n_tokens", "n_known", "base_score", "class_score", "ids"]
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i].values
                hashes = get("hashes").to_numpy()
                c = np.zeros(len(hashes), np.int64)
                if batch.column("at")[i].is_valid:
                    c[get("at").to_numpy() & ((1 << PLACE_BITS) - 1)] = get("c").to_numpy()
                place, share = vocab.encode(hashes, c)
                base = np.log10((c + 1) / (total + distinct + 1))
                codes = np.frombuffer(zlib.decompress(batch.column("codes")[i].as_py()), np.int32)
                sizes = get("sizes").to_numpy()
                ends = np.cumsum(sizes)
                sums = [np.concatenate(([0], np.cumsum(x[codes]))) for x in (base, share, c > 0)]
                base, share, seen = (x[ends] - x[ends - sizes] for x in sums)
                flat = place[codes]
                ids = [
                    np.append(flat[b - n : b], np.int16(END)).tobytes() for b, n in zip(ends.tolist(), sizes.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        get("doc_ids"), get("learn"), pa.array(sizes.astype(np.int64) + 1),
                        pa.array(seen.astype(np.int64) + (texts > 0)),
                        pa.array(base + np.log10((texts + 1) / (total + distinct + 1))),
                        pa.array(share), pa.array(ids, pa.binary()),
                    ],
                    names=names,
                )

    encoded = common.stored(
        blocks.select("block", "doc_ids", "learn", "sizes", "codes", "hashes").join(known, "block", "left").mapInArrow(
            encode,
            "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, class_score double, ids binary",
        ).withColumn("row", F.monotonically_increasing_id()),
        f"{path}/encoded",
    )
    model = fit(encoded, vocab)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, z = model.tables()
        for batch in batches:
            texts_ = [np.frombuffer(x, np.int16) for x in batch.column("ids").to_pylist()]
            if not texts_:
                continue
            ids = np.concatenate(texts_).astype(np.int64)
            places = np.cumsum([0, *(len(x) for x in texts_[:-1])])
            h1, h2 = _contexts(ids, places)
            logs = one[h1, ids] + two[h2, ids] - z[h1, h2]
            total_ = np.add.reduceat(logs, places) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x) for x in ("doc_id", "learn", "n_tokens", "n_known", "base_score")),
                    pa.array(total_ + batch.column("class_score").to_numpy()),
                ],
                names=["doc_id", "learn", "n_tokens", "n_known", "base_score", "score"],
            )

    return encoded.mapInArrow(
        score, "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double"
    ).withColumn("train_tokens", F.lit(vocab.tokens).cast("long"))
