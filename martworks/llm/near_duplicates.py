"""Near duplicates by one-permutation hashing with optimal densification.

A text's set holds its distinct five-word shingles. One hash of each shingle gives both
its bin and its rank in the bin, so a set is sketched in one pass; an empty bin takes the
value of the first filled bin in an order of its own (optimal densification). Bands of
the sketch are bucket keys, and within a bucket every member is tied to the smallest one
only: candidate edges form stars, ``BANDS`` per text at most whatever the group's size.

Sets that lie in no common candidate group are not compared. Inside a candidate group all
members are compared exactly on their full sets, by counting along an inverted index in a
bounded unit; only a spanning star of the links found leaves the unit. Groups beyond the
bounds of a unit are compared bucket by bucket, and buckets beyond it block pair by block
pair: nothing is capped.

With 48 bands of 7 bins a pair at a threshold of 0.85 fails to meet with a probability
of (1 - 0.85^7)^48, about 1e-8; at 0.8 with about 1e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

BANDS, ROWS = 48, 7
BINS = BANDS * ROWS
#: Links need 100 * intersection >= PERCENT * union, where a caller names no other share.
PERCENT = 85
#: Bounds of what one task compares at once.
UNIT_DOCS, UNIT_SHINGLES = 4096, 2_000_000
#: Texts that small candidate groups are put together to, for one call.
BIN_SHINGLES = 1_000_000

_SKETCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("d1", pa.int64()),
        ("d2", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def _orders() -> np.ndarray:
    """For each bin, the order in which it asks the others for a value."""
    random = np.random.default_rng(5)
    return np.stack([random.permutation(BINS) for _ in range(BINS)])


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``BINS`` values for each set; zeros for an empty set."""
    values = np.zeros((len(sets), BINS), dtype=np.uint64)
    filled = np.zeros((len(sets), BINS), dtype=bool)
    for i, s in enumerate(sets):
        if len(s):
            bins = ((s >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
            values[i, bins[first]] = s[first]  # sets are sorted: the least of each bin
            filled[i, bins[first]] = True
    open_ = np.flatnonzero(filled.any(axis=1) & ~filled.all(axis=1))
    orders = _orders()
    own = {}
    for attempt in range(BINS):
        if not len(open_):
            break
        if attempt == 0:
            own = {"values": values[open_], "filled": filled[open_], "done": filled[open_].copy()}
        asked = orders[:, attempt]
        take = ~own["done"] & own["filled"][:, asked]
        rows, cols = np.nonzero(take)
        values[open_[rows], cols] = own["values"][rows, asked[cols]]
        own["done"] |= take
        rest = ~own["done"].all(axis=1)
        if not rest.all():
            open_ = open_[rest]
            own = {k: v[rest] for k, v in own.items()}
    return values


_ODD = common._constants(ROWS, 31) | np.uint64(1)
_SALT = common._constants(BANDS, 37)


def band_keys(values: np.ndarray) -> np.ndarray:
    return common.mix((values.reshape(-1, BANDS, ROWS) * _ODD).sum(axis=2, dtype=np.uint64) + _SALT)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in common.chunks(batches, "text"):
        sets = common.shingle_sets(chunk.column("text"))
        keys = band_keys(sketches(sets)).view(np.int64)
        digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        d = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
        full = np.array([len(s) > 0 for s in sets])
        offsets = np.concatenate(([0], np.cumsum(full * BANDS))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(d[:, 0].copy()),
                pa.array(d[:, 1].copy()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel())),
            ],
            schema=_SKETCH,
        )


def links(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """(id, smallest id of its group) for the ids of one unit that link with another.
    Exact: each set is counted against the posting lists of its own shingles."""
    n = len(sets)
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets])
    if n > 1 and sizes.sum():
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        owner = np.repeat(np.arange(n), sizes)
        by_code = np.argsort(codes, kind="stable")
        postings = owner[by_code]
        starts = np.concatenate(([0], np.cumsum(np.bincount(codes))))
        for i in range(n):
            own = codes[bounds[i] : bounds[i + 1]]
            lengths = starts[own + 1] - starts[own]
            own, lengths = own[lengths > 1], lengths[lengths > 1]
            # A partner shares PERCENT of the shingles at least.
            if 100 * len(own) < percent * sizes[i]:
                continue
            at = np.repeat(starts[own] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
            shared = np.bincount(postings[at + np.arange(lengths.sum())], minlength=n)
            linked = np.flatnonzero(100 * shared >= percent * (sizes + sizes[i] - shared))
            for j in linked[(linked > i) & (sizes[linked] > 0)].tolist():
                a, b = find(i), find(j)
                if a != b:
                    parent[b] = a
    seen: dict[int, int] = {}
    for i in range(n):  # rows of one id are one document
        j = seen.setdefault(int(ids[i]), i)
        if find(j) != find(i):
            parent[find(i)] = find(j)
    groups: dict[int, list[int]] = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(int(ids[i]))
    out = []
    for members in groups.values():
        least = min(members)
        out += [(m, least) for m in set(members) if m != least]
    return out


def _compare(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    sets = common.shingle_sets(pa.array(group["text"], pa.large_string()))
    ids = group["id"].to_numpy()
    out: list[tuple[int, int]] = []
    parts = group.groupby("part", sort=False).indices
    for rows in parts.values():
        if len(rows) > 1:
            out += links(ids[rows], [sets[i] for i in rows], percent)
    found = pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    common.release()
    return found


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Groups of near duplicates of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id, kept; one row per row of ``docs``, other columns are ignored. Two texts
    link whose sets share ``percent`` of their union or more.

    Null and word-free texts have an empty set and link with nothing. Equal sets link.
    Rows that repeat a doc_id are one document: its links are those of all its texts,
    and each of its rows is returned. Rows without doc_id link with nothing and are kept
    with a null component. An empty table gives an empty result."""
    spark = docs.sparkSession
    path = common.folder(spark)
    sketched = common.stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_sketch, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"),
        f"{path}/sketches",
    )
    real = sketched.where("n_shingles > 0 and doc_id is not null")
    classes = real.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    placed = common.stored(
        real.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"])
        .select("doc_id", "n_shingles", "rep"),
        f"{path}/placed",
    )
    # Texts of one id that lie in different classes.
    twice = (
        placed.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a")).where("a <> b").select("doc_id")
    )
    twice = placed.join(twice, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    heads = real.join(classes, ["d1", "d2"]).where("doc_id = rep")
    entries = heads.select("doc_id", F.explode("bands").alias("key"))
    buckets = (
        entries.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    )
    stars = (
        entries.join(buckets, "key").where("doc_id <> hub")
        .select(F.col("doc_id").alias("a"), F.col("hub").alias("b"))
    )
    coarse = common.stored(common.components(stars, f"{path}/coarse"), f"{path}/coarse-groups")
    members = coarse.union(coarse.groupBy("component").agg(F.min("component").alias("c")))
    members = members.join(
        heads.groupBy(F.col("doc_id").alias("id")).agg(F.max("n_shingles").alias("n")), "id"
    )
    sizes = members.groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"))
    grouped = common.stored(
        members.join(sizes, "component").withColumn(
            "small", (F.col("m") <= UNIT_DOCS) & (F.col("shingles") <= UNIT_SHINGLES)
        ),
        f"{path}/members",
    )
    total = grouped.where("small").agg(F.sum("n")).first()[0] or 0
    bins = max(1, -(-total // BIN_SHINGLES))
    units = grouped.where("small").select(
        "id", F.pmod(F.xxhash64("component"), F.lit(bins)).alias("unit"), F.col("component").alias("part"),
    )
    if not grouped.where("not small").isEmpty():
        units = units.union(_units_of_large(entries, grouped.where("not small"), bins))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    found = (
        units.join(texts, "id").groupBy("unit")
        .applyInPandas(lambda group: _compare(group, percent), "a long, b long")
    )
    linked = common.components(found.union(twice), f"{path}/linked")
    linked = linked.select(F.col("id").alias("rep"), "component")
    answers = (
        placed.select("doc_id", "rep").distinct().join(linked, "rep", "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    )
    return sketched.select("doc_id", "n_shingles").join(answers, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def _units_of_large(entries: DataFrame, members: DataFrame, first: int) -> DataFrame:
    """Units for groups that one task does not hold: their buckets, each set of members
    once; buckets beyond a unit's bounds as pairs of blocks."""
    inside = entries.join(members.select(F.col("id").alias("doc_id"), "n"), "doc_id")
    stats = inside.groupBy("key").agg(
        F.count("*").alias("m"),
        F.sum("n").alias("shingles"),
        F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("print"),
    ).where("m > 1")
    once = stats.groupBy("m", "shingles", "print").agg(F.min("key").alias("key"))
    blocks = F.greatest(
        F.lit(1),
        F.ceil(F.col("m") / F.lit(UNIT_DOCS // 2)),
        F.ceil(F.col("shingles") / F.lit(UNIT_SHINGLES // 2)),
    ).cast("int")
    rows = inside.join(once.withColumn("blocks", blocks), "key").withColumn(
        "own", F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    )
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    # Non-negative units below `first` are bins of small groups.
    return rows.select(
        F.col("doc_id").alias("id"), (-1 - F.abs(pair / 2).cast("long")).alias("unit"), F.col("key").alias("part")
    )
