from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import LONG

from martworks.llm import common, suffix_repeats


def _brute(rows, length=50):
    """What repeats_removed() says of (doc_id, text) rows, string by string."""
    least = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for p in range(len(b) - length + 1):
                s = b[p : p + length]
                least[s] = min(i, least.get(s, i))
    out = []
    for i, b in data:
        lost = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - length + 1):
                if least[b[p : p + length]] < i:
                    lost[p : p + length] = b"\1" * length
        spans = sum(x and not y for x, y in zip(lost, b"\0" + lost))
        kept = bytes(x for x, y in zip(b, lost) if not y)
        out.append((i, len(b), sum(lost), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _rows(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _words(n, seed, letters="abcdefghijklmnop"):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices(letters, k=rnd.randint(2, 9))) for _ in range(n))


def _planted():
    rnd = random.Random(5)
    line = "This line stands in very many documents, between other words each time. "
    rows = []
    for i in range(120):
        text = _words(rnd.randint(1, 80), i)
        if i % 2:
            cut = rnd.randint(0, len(text))
            text = text[:cut] + line + text[cut:]
        if i % 5 == 0 and rows:
            _, other = rnd.choice(rows)
            start = rnd.randint(0, max(0, len(other) - 90))
            text += other[start : start + rnd.randint(45, 90)]
        rows.append((rnd.randint(0, 10**12), text))
    rows += [(i, rows[0][1]) for i in range(3)]  # copies
    rows += [(5000 + i, rows[7][1][: 40 + i] + "é" + rows[7][1][40 + i :]) for i in range(8)]  # near copies
    rows += [(7000, "ab" * 200), (7001, "ab" * 150), (7002, "b" * 49), (7003, "b" * 50), (7004, "b" * 51), (7005, "你好世界" * 9)]
    rows += [(7006, "你好世界" * 9 + "x"), (7007, "\0" * 60), (7008, "\0" * 55 + "y")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("many", [suffix_repeats.MANY, 3])
def test_against_all_strings(spark, many):
    rows = _planted()
    assert _rows(suffix_repeats.repeats_removed(_docs(spark, rows), many=many)) == _brute(rows)


def test_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "BUCKET", 64)
    monkeypatch.setattr(suffix_repeats, "SORTED", 10)
    monkeypatch.setattr(common, "CHUNK_BYTES", 500)
    rows = _planted()
    assert _rows(suffix_repeats.repeats_removed(_docs(spark, rows).repartition(5))) == _brute(rows)


def test_ids_that_repeat_or_lack(spark):
    one, two = _words(30, 1), _words(40, 2)
    rows = [(4, one), (4, one), (4, one + two), (9, two), (9, one), (None, one), (None, two), (2, None), (3, ""), (1, "short")]
    rows += [(20, one), (20, one)]
    assert _rows(suffix_repeats.repeats_removed(_docs(spark, rows))) == _brute(rows)
    none = _docs(spark, [(None, one), (1, None)])
    assert _rows(suffix_repeats.repeats_removed(none)) == _brute([(None, one), (1, None)])


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.text is None or len(r.text) < 10_000]
    small = odd.where("text is null or length(text) < 10000")
    assert _rows(suffix_repeats.repeats_removed(small)) == _brute(rows)
    got = {r.doc_id: r for r in suffix_repeats.repeats_removed(odd).collect()}
    assert got[6].n_removed == 0 and got[7].n_removed == len(LONG) and got[7].n_spans == 1
    assert got[7].kept_sha256 == hashlib.sha256(b" tail").hexdigest()
    assert suffix_repeats.repeats_removed(odd.limit(0)).collect() == []


def test_groups_are_the_maximal_repeats():
    rnd = random.Random(2)
    for _ in range(60):
        base = bytes(rnd.choices(b"abc\0", k=50))
        texts = []
        for _ in range(rnd.randint(1, 6)):
            a = rnd.randint(0, 20)
            texts.append(bytes(rnd.choices(b"xy", k=rnd.randint(0, 3))) + base[a : a + rnd.randint(18, 30)])
        want = {}
        for i, t in enumerate(texts):
            for x in range(len(t)):
                for y in range(x + 18, len(t) + 1):
                    want.setdefault(t[x:y], []).append((i, x))
        out = {}
        for s, places in want.items():
            before = {texts[i][p - 1] if p else (i, p) for i, p in places}
            after = {texts[i][p + len(s)] if p + len(s) < len(texts[i]) else (i, p) for i, p in places}
            if len(places) > 1 and len(before) > 1 and len(after) > 1:
                out[s] = sorted(places)
        assert dict(suffix_repeats.groups(texts, 18)) == out


def test_equal_strings_have_a_mark_in_common():
    text = _words(400, 3).encode()
    for seed in range(20):
        rnd = random.Random(seed)
        p = rnd.randint(0, len(text) - 50)
        one, two = (_words(5, seed + k).encode() + text[p : p + 50] + _words(5, seed + k + 9).encode() for k in (1, 100))
        found = []
        for t in (one, two):
            raw, offsets = common.text_bytes(pa.array([t.decode()]))
            m = suffix_repeats.Marks(raw, offsets)
            start = t.index(text[p : p + 50])
            inside = (m.start <= start) & (m.end >= start + 50) & (m.at >= start) & (m.at + 16 <= start + 50)
            found.append({(int(h), int(a) - start) for h, a in zip(m.mark[inside], m.at[inside])})
        assert found[0] & found[1]


def test_joined():
    got = suffix_repeats.joined(np.array([5, 0, 20, 12]), np.array([12, 3, 25, 13]))
    assert got.tolist() == [[0, 3], [5, 13], [20, 25]]
