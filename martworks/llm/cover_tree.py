"""Near duplicates of embedding vectors: exact threshold pairs by cover trees.

Vectors of unit length link when their cosine reaches the threshold, that is when their
distance is at most ``EPSILON``. A cover tree nests balls whose radii halve from level to
level; two trees are gone through together: a pair of nodes whose covering radii keep all
their points apart is pruned, a pair whose points all lie within the threshold is counted
without being opened, any other pair is opened until leaves are compared vector by vector
in double precision.

Spread over tasks: each label's space is cut into cells around centres, and a vector goes
to its nearest centre's cell, and as a guest to the later cells whose covering ball comes
within the threshold of it. The centres (at most ``CENTRES`` in all) are chosen from a
sample bounded by ``SAMPLE``; they decide where a pair is found, never whether. Cells are
cut into blocks of bounded expected size, and each pair of blocks is a task of its own.
Equal vectors are one vector with a count; links are counted, not listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

COSINE = 0.93
#: Bounds of the vectors that centres are chosen from, and of the centres.
SAMPLE, CENTRES = 20_000, 2048
#: Vectors of a label for each centre it gets, and in a block on average.
PER_CENTRE, BLOCK = 2000, 2000
LEAF = 32
#: Rounding never prunes a pair or counts one: bounds are loosened by this.
SLACK = 1e-6


class CoverTree:
    """Nested balls over the rows of ``x``: node 0 is the root; ``centre``, ``radius``
    (that covers all of the node's points), ``members`` and ``children`` by node."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.members: list[np.ndarray] = []
        self.children: list[list[int]] = []
        if len(x):
            self._add(np.arange(len(x)), 0, 2.0)

    def _add(self, members: np.ndarray, centre: int, radius: float) -> int:
        node = len(self.centre)
        own = self.x[members]
        actual = 0.0
        if len(members) > 1:
            actual = _distance(float((own @ self.x[centre]).min())) + SLACK / 10
        self.centre.append(centre)
        self.radius.append(actual)
        self.members.append(members)
        self.children.append([])
        if len(members) <= LEAF or actual < SLACK:
            return node
        while radius / 2 >= actual:  # levels at which the node is its own only child
            radius /= 2
        # Separate centres at half the radius, each point with the first that covers it.
        near = 1 - radius**2 / 8  # cosine at that distance
        left = np.ones(len(members), bool)
        first = centre
        while True:
            covered = left & (own @ self.x[first] >= near)
            covered |= left & (members == first)
            self.children[node].append(self._add(members[covered], first, radius / 2))
            left &= ~covered
            at = int(left.argmax())
            if not left[at]:
                return node
            first = int(members[at])


def _distance(cosine: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


class _Groups:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def dual_links(
    left: CoverTree, right: CoverTree | None, weights: np.ndarray, cosine: float = COSINE
) -> tuple[np.ndarray, np.ndarray]:
    """Links between the points of two trees, or within one (``right`` None). Points are
    numbered through: the right tree's follow the left's. Returns the weight that each
    point is linked with, and the smallest number of each point's group."""
    within = right is None
    other = left if within else right
    shift = 0 if within else len(left.x)
    counts = np.zeros(len(left.x) + (0 if within else len(other.x)))
    groups = _Groups(len(counts))
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    todo: list[tuple[int, int, float]] = []
    sizes = [np.array([len(m) for m in t.members], np.int64) for t in (left, other)]
    starts = [np.cumsum(n) - n for n in sizes]
    flat = [np.concatenate([*t.members, np.zeros(0, np.int64)]) for t in (left, other)]
    leaf = [
        np.array([not c and len(m) <= LEAF for c, m in zip(t.children, t.members)], bool) for t in (left, other)
    ]
    centres = [np.array(t.centre, np.int64) for t in (left, other)]
    radii = [np.array(t.radius) for t in (left, other)]

    def compare_leaves(a: np.ndarray, b: np.ndarray) -> None:
        """Point by point, for many pairs of leaves at once."""
        products = sizes[0][a] * sizes[1][b]
        for some in np.array_split(np.arange(len(a)), max(1, int(products.sum()) >> 15)):
            n = products[some]
            pair = np.repeat(some, n)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            across = sizes[1][b[pair]]
            i = flat[0][starts[0][a[pair]] + nth // across]
            j = flat[1][starts[1][b[pair]] + nth % across]
            if within:
                once = (a[pair] != b[pair]) | (i < j)
                i, j = i[once], j[once]
            compare_points(i, j)

    def compare_points(i: np.ndarray, j: np.ndarray) -> None:
        hit = np.einsum("ij,ij->i", left.x[i], other.x[j]) >= cosine
        i, j = i[hit], j[hit] + shift
        np.add.at(counts, i, weights[j])
        np.add.at(counts, j, weights[i])
        for u, v in zip(i.tolist(), j.tolist()):
            groups.join(u, v)

    def meet(p: list[int], q: list[int], same: bool) -> None:
        """Keep the pairs of nodes that may hold a link, some rows at a time."""
        p, q = np.array(p), np.array(q)
        cq, rq = other.x[centres[1][q]], radii[1][q]
        rows = max(1, (1 << 18) // len(q))
        for k in range(0, len(p), rows):
            part = p[k : k + rows]
            c, r = left.x[centres[0][part]], radii[0][part]
            d = np.sqrt(np.clip(2 - 2 * (c @ cq.T), 0, None))
            near = d <= r[:, None] + rq + epsilon + SLACK
            if same:
                near &= np.arange(k, k + len(part))[:, None] <= np.arange(len(q))
            i, j = np.nonzero(near)
            a, b = part[i], q[j]
            leaves = leaf[0][a] & leaf[1][b]
            compare_leaves(a[leaves], b[leaves])
            rest = ~leaves
            todo.extend(zip(a[rest].tolist(), b[rest].tolist(), d[i, j][rest].tolist()))

    if len(left.x) and len(other.x):
        meet([0], [0], within)
    while todo:
        p, q, d = todo.pop()
        mine, theirs = left.members[p], other.members[q]
        same = within and p == q
        if d + left.radius[p] + other.radius[q] <= epsilon - SLACK:
            mine_all, theirs_all = weights[mine].sum(), weights[theirs + shift].sum()
            counts[mine] += theirs_all - (weights[mine] if same else 0)
            if not same:
                counts[theirs + shift] += mine_all
            for i in mine.tolist():
                groups.join(i, int(theirs[0]) + shift)
            for j in theirs.tolist():
                groups.join(int(mine[0]), j + shift)
        elif not left.children[p] and not other.children[q]:
            linked = left.x[mine] @ other.x[theirs].T >= cosine
            if same:
                np.fill_diagonal(linked, False)
            counts[mine] += linked @ weights[theirs + shift]
            if not same:
                counts[theirs + shift] += linked.T @ weights[mine]
            for i, j in zip(*np.nonzero(linked)):
                groups.join(int(mine[i]), int(theirs[j]) + shift)
        elif same:
            meet(left.children[p], left.children[p], True)
        elif not other.children[q] or left.children[p] and left.radius[p] >= other.radius[q]:
            meet(left.children[p], [q], False)
        else:
            meet([p], other.children[q], False)
    return counts, np.array([groups.find(i) for i in range(len(counts))], dtype=np.int64)


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors of usable rows, with a digest of the vector as given."""
    for batch in batches:
        rows, parts, digests = [], [], []
        for i, (label, v) in enumerate(zip(batch.column("label").to_pylist(), batch.column("vector").to_pylist())):
            if label is None or not v or None in v:
                continue
            x = np.array(v, dtype=np.float64)
            if not np.isfinite(x).all() or not x.any():
                continue
            digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
            x = x / np.abs(x).max()
            parts.append(x / np.linalg.norm(x))
            rows.append(i)
        at = pa.array(rows, pa.int32())
        d = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id").take(at),
                batch.column("label").take(at),
                pa.array([len(x) for x in parts], pa.int32()),
                pa.array(d[:, 0].copy(), pa.int64()),
                pa.array(d[:, 1].copy(), pa.int64()),
                pa.array([x.tobytes() for x in parts], pa.binary()),
            ],
            names=["vec_id", "label", "dim", "d1", "d2", "x"],
        )


def _farthest(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n centres spread over the rows of x: each is the point farthest from those
    before, as in the top levels of a cover tree."""
    chosen = [0]
    away = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < n and away.max() > 1e-9:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def _centres(vectors: DataFrame) -> dict[tuple, np.ndarray]:
    """Centres by label and dimension. A label without centres has one cell."""
    kinds = vectors.groupBy("label", "dim").agg(F.count("*").alias("n"))
    largest = kinds.where(f"n > {2 * PER_CENTRE}").orderBy(F.desc("n"), "label", "dim").limit(CENTRES // 2).collect()
    if not largest:
        return {}
    total = sum(r["n"] for r in largest)
    wanted = {
        (r["label"], r["dim"]): max(2, min(r["n"] // PER_CENTRE, CENTRES * r["n"] // (2 * total))) for r in largest
    }
    share = min(1.0, SAMPLE / total)
    sample = (
        vectors.withColumn("h", F.xxhash64("d1", "d2"))
        .where(F.pmod("h", F.lit(1 << 20)) < max(1, int(share * (1 << 20))))
        .select("h", "label", "dim", "x").orderBy("h", "label").limit(SAMPLE).collect()
    )
    by: dict[tuple, list[np.ndarray]] = {}
    for r in sample:
        if (r["label"], r["dim"]) in wanted:
            by.setdefault((r["label"], r["dim"]), []).append(np.frombuffer(r["x"]))
    return {k: _farthest(np.stack(v), wanted[k]) for k, v in by.items()}


def _by_kind(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    keys: dict[tuple, list[int]] = {}
    for i, k in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist())):
        keys.setdefault(k, []).append(i)
    data = batch.column("x").to_pylist()
    for k, rows in keys.items():
        yield k, np.array(rows), np.stack([np.frombuffer(data[i]) for i in rows])


def linked(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links of all rows of ``embeddings`` (vec_id, embedding, label): vec_id, n_links,
    component_id, kept. Vectors are compared when their labels are equal and not null.

    Vectors that are null, empty or zero or hold null or non-finite components, and
    vectors of different dimension, link with nothing. Equal vectors link. Rows that
    repeat a vec_id are separate vectors under one id: each row has the links of its
    vector, and the id's groups are one. Rows without vec_id link with nothing and are
    kept with a null component. Other columns are ignored; an empty table gives an empty
    result."""
    spark = embeddings.sparkSession
    path = common.folder(spark)
    source = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.col("label").cast("string").alias("label"),
    ).withColumn("row", F.monotonically_increasing_id())
    given = common.stored(source.select("vec_id", "row", "label", "vector"), f"{path}/rows")
    unit = common.stored(
        given.where("vec_id is not null").select(F.col("row").alias("vec_id"), "label", "vector").mapInArrow(
            _unit, "vec_id long, label string, dim int, d1 long, d2 long, x binary"
        ).withColumnRenamed("vec_id", "row").join(given.select("row", "vec_id"), "row"),
        f"{path}/unit",
    )
    keys = ["label", "dim", "d1", "d2"]
    classes = common.stored(
        unit.groupBy(*keys).agg(
            F.min("vec_id").alias("rep"), F.min("row").alias("node"), F.count("*").alias("copies")
        ),
        f"{path}/classes",
    )
    heads = common.stored(
        unit.join(classes, keys).where("row = node").select(*keys, "node", "rep", "copies", "x"), f"{path}/heads"
    )
    counted = _joined(heads, path, cosine)
    counts = counted.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    edges = counted.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    answers = common.stored(
        unit.join(classes, keys).select("row", "vec_id", "node", "rep", "copies")
        .join(counts, "node", "left")
        .withColumn("n_links", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).cast("long")),
        f"{path}/answers",
    )
    # Groups of ids: classes are tied to their smallest id, links to the ids of both ends.
    reps = classes.select("node", "rep")
    links = (
        edges.join(reps.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a")
        .join(reps.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b")
        .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    )
    own = answers.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    groups = common.components(links.union(own), f"{path}/groups")
    return (
        given.select("row", "vec_id").join(answers.select("row", "n_links"), "row", "left")
        .join(groups.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"),
        )
    )


def _joined(heads: DataFrame, path: str, cosine: float) -> DataFrame:
    """(node, other, n): the weight that a node is linked with in one task (other null),
    and a spanning star of the links found there (other not null)."""
    centres = _centres(heads)
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    columns = [f.name for f in heads.schema]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = np.full(batch.num_rows, -1, np.int32), np.zeros(batch.num_rows)
            for kind, rows, x in _by_kind(batch):
                if kind in centres:
                    c = centres[kind]
                    nearest = (x @ c.T).argmax(axis=1)
                    cell[rows], away[rows] = nearest, np.linalg.norm(x - c[nearest], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(away)], names=[*columns, "cell", "away"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in heads.schema)
    settled = common.stored(heads.mapInArrow(settle, f"{kinds}, cell int, away double"), f"{path}/settled")
    cells = settled.groupBy("label", "dim", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    covering: dict[tuple, np.ndarray] = {k: np.full(len(c), -np.inf) for k, c in centres.items()}
    for r in cells.where("cell >= 0").collect():  # at most CENTRES rows
        covering[r["label"], r["dim"]][r["cell"]] = r["radius"]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The later cells that each vector may have links in."""
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            at, to = [], []
            for kind, rows, x in _by_kind(batch):
                if kind in centres:
                    c = centres[kind]
                    d = np.sqrt(np.clip(2 - 2 * (x @ c.T), 0, None))
                    reach = d <= covering[kind] + epsilon + 1e-6
                    reach &= np.arange(len(c)) > cell[rows][:, None]
                    # Nearer to the own centre by more than the threshold allows.
                    own = d[np.arange(len(rows)), cell[rows]][:, None]
                    apart = np.linalg.norm(c[cell[rows]][:, None] - c[None], axis=2) if len(rows) * c.size <= 1 << 22 \
                        else np.stack([np.linalg.norm(c - c[k], axis=1) for k in cell[rows]])
                    reach &= (d**2 - own**2) <= 2 * apart * (epsilon + 1e-6)
                    i, j = np.nonzero(reach)
                    at.append(rows[i])
                    to.append(j)
            index = np.concatenate(at) if at else np.zeros(0, np.int64)
            out = batch.take(pa.array(index, pa.int64()))
            target = pa.array(np.concatenate(to).astype(np.int32) if to else np.zeros(0, np.int32))
            yield out.set_column(out.schema.get_field_index("cell"), "cell", target)

    guests = settled.mapInArrow(visit, settled.schema)
    every = settled.withColumn("guest", F.lit(False)).union(guests.withColumn("guest", F.lit(True)))
    sizes = every.groupBy("label", "dim", "cell").agg(
        F.sum((~F.col("guest")).cast("long")).alias("owners"), F.sum(F.col("guest").cast("long")).alias("visitors")
    )
    place = ["label", "dim", "cell"]
    wide = every.join(sizes, place)
    own_blocks = F.greatest(F.lit(1), F.ceil(F.col("owners") / BLOCK)).cast("int")
    block = F.pmod(F.xxhash64("node"), F.when(F.col("guest"), F.greatest(F.lit(1), F.ceil(F.col("visitors") / BLOCK)))
                   .otherwise(own_blocks).cast("long")).cast("int")
    wide = wide.withColumn("blocks", own_blocks).withColumn("block", block)
    # Owners meet owners of all blocks; guests meet owners of all blocks.
    wide = wide.withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.when(
        F.col("guest"), F.struct(F.lit(1).alias("k"), F.col("other_block").alias("a"), F.col("block").alias("b"))
    ).otherwise(
        F.struct(F.lit(0).alias("k"), F.least("block", "other_block").alias("a"), F.greatest("block", "other_block").alias("b"))
    )
    wide = wide.withColumn("task", task)
    # Owners also go to the tasks of the guests' blocks.
    hosts = wide.where("not guest and visitors > 0 and block = other_block").withColumn(
        "guests", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("visitors") / BLOCK)).cast("int") - 1))
    ).withColumn("task", F.struct(F.lit(1).alias("k"), F.col("block").alias("a"), F.col("guests").alias("b")))
    picked = [*place, "task", "guest", "block", "node", "copies", "x"]
    tasks = wide.select(*picked).union(hosts.select(*picked))

    def work(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(v) for v in group["x"]])
        weights = group["copies"].to_numpy(np.float64)
        node = group["node"].to_numpy()
        task = group["task"].iloc[0]
        k, a, b = (task["k"], task["a"], task["b"]) if isinstance(task, dict) else tuple(task)
        if k == 0 and a == b:
            left, right = np.arange(len(group)), None
        else:
            first = ~group["guest"].to_numpy(bool) if k else (group["block"] == a).to_numpy()
            left, right = np.flatnonzero(first), np.flatnonzero(~first)
        order = left if right is None else np.concatenate((left, right))
        counts, least = dual_links(
            CoverTree(x[left]), None if right is None else CoverTree(x[right]), weights[order], cosine
        )
        node = node[order]
        hit, tied = counts > 0, least != np.arange(len(least))
        other = pd.array(np.concatenate((node[hit], node[least[tied]])), dtype="Int64")
        other[: hit.sum()] = pd.NA
        return pd.DataFrame(
            {
                "node": np.concatenate((node[hit], node[tied])),
                "other": other,
                "n": np.concatenate((counts[hit], np.zeros(tied.sum()))).astype(np.int64),
            }
        )

    found = tasks.groupBy(*place, "task").applyInPandas(work, "node long, other long, n long")
    return common.stored(found, f"{path}/found")
