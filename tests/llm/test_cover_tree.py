from __future__ import annotations

import math

import numpy as np
import pytest

from martworks.llm import cover_tree


def brute(rows, cosine=0.93):
    """{position: n_links} and {vec_id: component} of (vec_id, vector, label) rows."""
    good = []
    for k, (i, v, label) in enumerate(rows):
        ok = i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        if ok:
            good.append((k, i, np.array(v, np.float64), label))
    n = dict.fromkeys(range(len(rows)), 0)
    parent = {i: i for i, _, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            x, y = good[a][2], good[b][2]
            if good[a][3] == good[b][3] and len(x) == len(y):
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    n[good[a][0]] += 1
                    n[good[b][0]] += 1
                    p, q = sorted((find(good[a][1]), find(good[b][1])))
                    parent[q] = p
    return n, {i: find(i) for i in parent}


SCHEMA = "vec_id long, embedding array<float>, label int, kept string, node int"


def check(spark, rows):
    n, group = brute(rows)
    got = cover_tree.linked(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)).collect()
    want = sorted(((i, n[k], group[i]) for k, (i, _, _) in enumerate(rows)), key=repr)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == want
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def _clustered(n, seed, dim=16, spread=0.25):
    rnd = np.random.default_rng(seed)
    heads = rnd.normal(size=(max(2, n // 12), dim))
    x = heads[rnd.integers(len(heads), size=n)] + spread * rnd.normal(size=(n, dim))
    return [(i, [float(np.float32(c)) for c in v], int(rnd.integers(3))) for i, v in enumerate(x)]


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    n, group = brute(rows)
    got = cover_tree.linked(table).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (n[k], group[i]) for k, (i, _, _) in enumerate(rows)}


def test_cells_and_blocks(spark, monkeypatch):
    for name, value in (("PER_CENTRE", 20), ("BLOCK", 25), ("SAMPLE", 120)):
        monkeypatch.setattr(cover_tree, name, value)
    rows = _clustered(400, 1)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(60)]  # a common vector
    rows += [(2000, [2 * c for c in rows[5][1]], rows[5][2])]
    check(spark, rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0),
        (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 0),
        (12, [1.0, 0.1], 0), (12, [-1.0, 0.0], 0), (13, [-1.0, 0.01], 0), (None, [1.0, 0.0], 0), (14, [1e30, 1e29], 0),
    ]
    check(spark, rows)
    assert cover_tree.linked(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("spread", [0.0, 0.02, 0.1, 0.3, 1.0])
def test_dual_traversal(spread):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(6, 8))[rnd.integers(6, size=260)] + spread * rnd.normal(size=(260, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    weights = rnd.integers(1, 5, 260).astype(float)
    linked = x @ x.T >= 0.93
    np.fill_diagonal(linked, False)
    tree = cover_tree.CoverTree(x)
    for node, members in enumerate(tree.members):
        assert np.linalg.norm(x[members] - x[tree.centre[node]], axis=1).max() <= tree.radius[node] + 1e-12
        if tree.children[node]:
            assert sorted(np.concatenate([tree.members[c] for c in tree.children[node]])) == sorted(members)
    counts, least = cover_tree.dual_links(tree, None, weights)
    assert (counts == linked @ weights).all()
    left, right = cover_tree.CoverTree(x[:100]), cover_tree.CoverTree(x[100:])
    counts, _ = cover_tree.dual_links(left, right, weights)
    assert (counts[:100] == linked[:100, 100:] @ weights[100:]).all()
    assert (counts[100:] == linked[100:, :100] @ weights[:100]).all()
    assert all(least[i] <= i for i in range(260))
