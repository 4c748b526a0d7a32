from __future__ import annotations

import random

import brute
import numpy as np

from martworks.llm import common, near_duplicates
from martworks.llm.near_duplicates import near_duplicates as run


def test_whole_table_against_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute.groups(rows)
    got = run(documents).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def _edited(n, seed, edits):
    """Copies of one text with up to ``edits`` words replaced: linked in part only."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**9)}"
        out.append((i, " ".join(words)))
    return out


def test_many_near_copies(spark):
    rows = _edited(300, 3, 8)
    want = brute.groups(rows)
    got = run(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_groups_beyond_a_unit(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "UNIT_DOCS", 40)
    rows = _edited(150, 5, 8)
    want = brute.groups(rows)
    got = run(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_sketches_estimate_similarity():
    rnd = np.random.default_rng(1)
    a = np.unique(rnd.integers(1, 1 << 63, 400).astype(np.uint64))
    b = np.unique(np.concatenate((a[:340], rnd.integers(1, 1 << 63, 60).astype(np.uint64))))
    one, two = near_duplicates.sketches([a, b])
    assert abs((one == two).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.1
    assert near_duplicates.sketches([a[:1]])[0].min() == a[0]


def test_odd_rows(odd):
    got = run(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert by[5].component_id == 4 and not by[5].kept and by[4].kept
    assert by[7].component_id == 6
    assert by[None].component_id is None and by[None].kept
    assert [r.component_id for r in got if r.doc_id == 9] == [9, 9]
    assert run(odd.where("false")).count() == 0


def test_one_id_with_two_texts(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "u v w x y z"), (3, "u v w x y z")]
    got = run(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1}


def test_components(spark, folder):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = common.components(spark.createDataFrame(chain, "a long, b long"), folder).collect()
    assert {r.id: r.component for r in got} == {**{i: 0 for i in range(1, 41)}, 101: 100}
