"""Merkle manifest of a table: leaves, roots and membership proofs.

Each row is a leaf; the leaves of a source, in the order of their ids, are folded sixteen at
a time to a subroot, and the subroots, in the order of their sources, to the root. Places of
leaves come from range partitions and counts, so a source of any size is spread over tasks.
4,096 neighbouring leaves are a superblock, three levels of the tree. The nodes above the
superblocks are few and made level by level with aggregations; each superblock is then
cogrouped with the outer nodes its proofs need, and one call reduces its leaves, joins the
inner and the outer part of each proof and folds it to the root again.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martworks.llm import common

FAN = 16
#: Levels of the tree inside a superblock.
INNER = 3
BLOCK = FAN**INNER
#: Columns of a leaf, in order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EVERY = 5


def encoded(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def digest(parts: list[Column]) -> Column:
    return F.sha2(F.concat(*parts), 256)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame, every: int = TAMPERED_EVERY) -> DataFrame:
    """key (of the source: empty for null, so that null comes first), doc_id, leaf, and
    tampered: the leaf of the row with its text in lower case, where crc32 of the id is
    divisible by ``every``; null elsewhere."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"), text.alias("text"),
    )
    before = [encoded(F.col(c)) for c in LEAF[:-1]]
    chosen = common.crc_mod(F.col("doc_id"), every) == 0
    return rows.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("key"), "doc_id",
        digest([*before, encoded(F.col("text"))]).alias("leaf"),
        F.when(chosen, digest([*before, encoded(lowered(F.col("text")))])).alias("tampered"),
    )


def placed(rows: DataFrame, key: str, order: list[str], path: str) -> DataFrame:
    """``rows`` with ``place``, their number by ``order`` within ``key``, and ``n``, the rows
    of the key. Rows are dealt by ranges of key and order, counted by range and key, and
    moved by the counts of the ranges before: no task holds a key whole."""
    ordered = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    at = F.monotonically_increasing_id()
    ordered = common.stored(
        ordered.withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)), f"{path}/ordered"
    )
    counted = ordered.groupBy(key, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(key)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select(
        key, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("n")
    )
    counted = common.stored(counted, f"{path}/counted")
    place = F.col("_at") - F.col("_first") + F.col("_before")
    return ordered.join(counted, [key, "_part"]).withColumn("place", place).drop("_at", "_part", "_first", "_before")


def _levels(n: str) -> Column:
    """Levels above ``n`` leaves: the least power of the fan-out that holds them."""
    return F.when(F.col(n) <= 1, 0).otherwise(F.length(F.conv((F.col(n) - 1).cast("string"), 10, 16)))


def _runs(nodes: DataFrame) -> DataFrame:
    """Runs of up to sixteen nodes (key, place, digest): their digests joined in order."""
    parts = F.sort_array(F.collect_list(F.struct("place", "digest")))
    run = nodes.groupBy("key", F.floor(F.col("place") / FAN).cast("long").alias("up"), "levels").agg(parts.alias("parts"))
    return run.select("key", "levels", F.col("up").alias("place"), F.array_join(F.col("parts.digest"), "").alias("run"))


def upper(nodes: DataFrame, level: int, path: str) -> tuple[DataFrame, DataFrame]:
    """From the nodes of ``level`` (key, levels, place, digest) to the tops of all keys:
    the runs that are folded on the way (key, level, place, run) and the tops (key,
    digest). A key whose tree ends at this level or below is its own top."""
    spark = nodes.sparkSession
    highest = nodes.agg(F.max("levels")).first()[0] or 0
    runs, tops = [], [nodes.where(F.col("levels") <= level).select("key", "digest")]
    while level < highest:
        run = common.stored(_runs(nodes.where(F.col("levels") > level)), f"{path}/runs-{level}")
        runs.append(run.select("key", F.lit(level).alias("level"), "place", "run"))
        nodes = run.select("key", "levels", "place", F.sha2("run", 256).alias("digest"))
        level += 1
        tops.append(nodes.where(F.col("levels") == level).select("key", "digest"))
    empty = spark.createDataFrame([], "key string, level int, place long, run string")
    return _union(runs, empty), _union(tops, tops[0])


def _union(frames: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = frames[0] if frames else empty
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def reduced(digests: list[str], levels: int) -> list[list[str]]:
    """Runs of each of the lowest ``levels`` levels over ``digests``, joined; the hash of a
    run is its place in the level above."""
    out = []
    for _ in range(levels):
        out.append(["".join(digests[i : i + FAN]) for i in range(0, len(digests), FAN)])
        digests = [_hash(run) for run in out[-1]]
    return out


def fold(digest: str, path: list[tuple[str, int]]) -> str:
    """The root that ``digest`` leads to when it takes its place in each run of ``path``."""
    for run, at in path:
        digest = _hash(run[: 64 * at] + digest + run[64 * (at + 1) :])
    return digest


def _superblock(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """All that one superblock's leaves and the runs above it say about its documents."""
    rows = rows.sort_values("place", kind="stable")
    outer = outer.sort_values("nth")
    above = list(zip(outer["run"], outer["at"]))
    siblings = "".join(run[: 64 * at] + run[64 * (at + 1) :] for run, at in above)
    own, root = rows["leaf"].tolist(), rows["root"].iloc[0]
    inner = reduced(own, int(rows["inner"].iloc[0]))
    proofs, folded = [], []
    for i, (leaf, tampered) in enumerate(zip(own, rows["tampered"])):
        path, at = [], i
        for runs in inner:
            path.append((runs[at // FAN], at % FAN))
            at //= FAN
        proofs.append(_hash("".join(run[: 64 * k] + run[64 * (k + 1) :] for run, k in path) + siblings))
        folded.append(fold(tampered or leaf, path + above))
    return pd.DataFrame(
        {
            "doc_id": rows["doc_id"].astype("Int64").mask(rows["no_id"]), "leaf": own, "subroot": rows["subroot"],
            "root": root, "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded],
        }
    )


_RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf,
    subroot, root, proof_sha256 (hash of the siblings on the way to the root),
    folded_root (the root folded from the tampered leaf where there is one, and the untampered
    siblings) and verified (it is the root).

    Nulls are leaves like others: a null id comes before all others in its source and is not
    tampered with, a null source is a source, a null text is `-` and stays so. Rows with
    one id are ordered by leaf; equal rows stand next to each other. A document alone has the
    hash of no siblings. Texts of any length are hashed in one go where Spark reads them. Other
    columns are ignored. An empty table gives an empty result."""
    spark = docs.sparkSession
    path = common.folder(spark)
    # Numbered when stored: equal rows then have an order of their own, and can be divided.
    rows = common.stored(leaves(docs).withColumn("row", F.monotonically_increasing_id()), f"{path}/leaves")
    rows = placed(rows, "key", ["doc_id", "leaf", "row"], f"{path}/places")
    rows = rows.withColumn("levels", _levels("n")).withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))
    rows = common.stored(rows.drop("n", "row"), f"{path}/placed")

    nodes = rows.select("key", "levels", "place", F.col("leaf").alias("digest"))
    for level in range(INNER):
        # A tree that has ended has one node, which stays as it is.
        up = F.when(F.col("levels") > level, F.sha2("run", 256)).otherwise(F.col("run"))
        nodes = _runs(nodes).select("key", "levels", "place", up.alias("digest"))
    blocks = common.stored(nodes, f"{path}/blocks")  # the top of each superblock
    runs, subroots = upper(blocks, INNER, f"{path}/sources")
    subroots = common.stored(subroots.withColumnRenamed("digest", "subroot"), f"{path}/subroots")

    # The tree over the sources is one more tree, whose only key is empty.
    named = placed(subroots.withColumn("all", F.lit("")), "all", ["key"], f"{path}/ranks")
    named = common.stored(named.withColumn("levels", _levels("n")), f"{path}/named")
    tops = named.select(F.col("all").alias("key"), "levels", "place", F.col("subroot").alias("digest"))
    over, top = upper(tops, 0, f"{path}/top")
    root = top.first()  # one row, none for an empty table
    root = root.digest if root else None

    # What each superblock needs of the runs above it: (key, block, nth, at, run).
    ways = blocks.where(F.col("levels") > INNER).select(
        "key", F.col("place").alias("block"),
        F.explode(F.sequence(F.lit(INNER), F.col("levels") - 1)).alias("level"),
    )
    ways = _met(ways, "block", INNER, runs, ["key", "level", "up"]).select("key", "block", "nth", "at", "run")
    ranked = named.where("levels > 0").select(
        "key", "place", F.explode(F.sequence(F.lit(0), F.col("levels") - 1)).alias("level")
    )
    ranked = _met(ranked, "place", 0, over.drop("key"), ["level", "up"]).select("key", "nth", "at", "run")
    own = blocks.select("key", F.when(F.col("levels") > INNER, F.col("place")).otherwise(0).alias("block"))
    # Levels below a source's subroot are fewer than 16, so the ones above come after them.
    ranked = own.join(ranked, "key").select("key", "block", (F.col("nth") + 16).alias("nth"), "at", "run")
    outer = ways.unionByName(ranked)
    rows = rows.join(subroots, "key").select(
        "key", "block", "place", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
        "leaf", "tampered", F.least("levels", F.lit(INNER)).alias("inner"), "subroot", F.lit(root).alias("root"),
    )
    return rows.groupBy("key", "block").cogroup(outer.groupBy("key", "block")).applyInPandas(_superblock, _RESULT)


def _met(ways: DataFrame, node: str, base: int, runs: DataFrame, on: list[str]) -> DataFrame:
    """``ways`` (level) joined with the run that the ancestor of ``node``, a place in level
    ``base``, is in at each level; ``nth`` is the level, ``at`` the ancestor's place in the run."""
    above = F.expr(f"shiftright({node}, cast(4 * (level - {base}) as int))")
    ways = ways.withColumn("_at", above).withColumn("up", F.shiftright("_at", 4))
    return ways.join(runs.withColumnRenamed("place", "up"), on).withColumn("nth", F.col("level")).withColumn(
        "at", F.col("_at").bitwiseAND(FAN - 1).cast("int")
    )
