from __future__ import annotations

import hashlib
import random
import zlib

from brute import lowered

from martworks.llm import merkle


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(digests):
    levels = []
    while len(digests) > 1:
        levels.append([digests[i : i + 16] for i in range(0, len(digests), 16)])
        digests = [_hash("".join(run)) for run in levels[-1]]
    return levels, digests[0]


def _path(levels, i):
    out = []
    for runs in levels:
        out.append((runs[i // 16], i % 16))
        i //= 16
    return out


def _brute(rows):
    """The manifest of (doc_id, source, lang, n_chars, text) rows in plain Python."""
    sources = {}
    for row in rows:
        tampered = None
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
            text = None if row[4] is None else lowered(row[4])
            tampered = _hash("".join(map(_encoded, (*row[:4], text))))
        sources.setdefault(row[1], []).append((row[0], _hash("".join(map(_encoded, row))), tampered))
    trees = {}
    for source, own in sources.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[source] = _tree([x[1] for x in own])
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    top, root = _tree([trees[s][1] for s in order])
    out = []
    for k, source in enumerate(order):
        for i, (doc_id, leaf, tampered) in enumerate(sources[source]):
            path = _path(trees[source][0], i) + _path(top, k)
            proof = _hash("".join("".join(run[:at] + run[at + 1 :]) for run, at in path))
            node = tampered or leaf
            for run, at in path:
                node = _hash("".join([*run[:at], node, *run[at + 1 :]]))
            out.append((doc_id, leaf, trees[source][1], root, proof, node, node == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def _check(spark, rows):
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(_brute(rows), key=repr)


def test_trees_of_all_sizes(spark):
    rows = [(i, "large", None, i, f"Text {i}") for i in range(4500)]  # two superblocks
    rows += [(10_000 + i, f"s{i % 37}", "en", None, None if i % 7 == 0 else "AbC" * (i % 5)) for i in range(900)]
    rows += [(i % 3, None, "x", 1, "É") for i in range(40)]  # equal rows, no source
    rows += [(None, "n", "x", 1, "É"), (None, "n", "x", 1, "A"), (-5, "", "x", 1, "A"), (2**60 + 1, "n", "x", 1, "B")]
    random.Random(3).shuffle(rows)
    _check(spark, rows)


def test_small_tables(spark):
    _check(spark, [(1, "a", "b", 1, "X")])
    _check(spark, [(1, "a", "b", 1, "X"), (2, "a", "b", 1, "X")])
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tampering_is_found(spark, documents):
    rows = merkle.manifest(documents).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in rows:
        text = texts[r.doc_id]
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and text is not None and text != lowered(text)
        assert r.verified == (not changed)
        assert (r.folded_root == r.root) == r.verified
    assert 0 < sum(not r.verified for r in rows) < len(rows) / 4


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd.collect()]
    got = merkle.manifest(odd).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(_brute(rows), key=repr)
    assert merkle.manifest(odd.limit(0)).collect() == []


def test_place_counts_within_keys(spark, folder):
    rows = [(k, i) for k in ("a", "b", "") for i in range(300)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "key string, i long").repartition(7)
    out = merkle.placed(df, "key", ["i"], folder).collect()
    assert all(r.place == r.i and r.n == 300 for r in out) and len(out) == 900
