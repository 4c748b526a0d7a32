from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from martworks.llm import common, content_chunks


def _chunks(text):
    raw, offsets = common.text_bytes(pa.array([text]))
    data, a, out = raw.tobytes(), 0, []
    for b in content_chunks.cuts(raw, offsets).tolist():
        out.append(data[a:b].decode())  # no character is cut
        a = b
    return out


def _words(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(2, 9))) for _ in range(n))


def test_rolling_hash():
    rnd = np.random.default_rng(1)
    raw = rnd.integers(0, 256, 300).astype(np.uint8)
    h = content_chunks.gear(raw)
    for i in (0, 5, 15, 16, 299):
        want = 0
        for b in raw[max(0, i - 15) : i + 1].tolist():
            want = ((want << 1) + int(content_chunks._GEAR[b])) % (1 << 16)
        assert h[i] == want


def test_chunks_join_to_the_text_and_resist_shifts():
    text = _words(800, 1) + " é 你好🙂 " * 30 + "x" * 1000
    own = _chunks(text)
    assert "".join(own) == text
    assert max(len(c.encode()) for c in own) <= content_chunks.MOST + 3
    moved = _chunks("something inserted " + text)
    assert len(set(own) & set(moved)) > 0.9 * len(set(own))
    mean = len(_words(4000, 2)) / len(_chunks(_words(4000, 2)))
    assert 15 < mean < 45


def test_texts_of_a_batch_do_not_touch():
    texts = [_words(100, 3), "", None, _words(60, 4), "short"]
    raw, offsets = common.text_bytes(pa.array(texts))
    ends = content_chunks.cuts(raw, offsets)
    a, lists = 0, []
    for i, t in enumerate(texts):
        e = ends[(ends > offsets[i]) & (ends <= offsets[i + 1])]
        lists.append(np.diff(np.concatenate(([offsets[i]], e))).tolist())
        assert lists[-1] == [len(c.encode()) for c in _chunks(t or "")]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_planted_passages(spark):
    rnd = random.Random(7)
    rows, planted = [(i, _words(rnd.randint(20, 400), 1000 + i)) for i in range(200)], []
    for k in range(100):  # passages of 51 words and more, each in two texts at any place
        passage = _words(51 + k % 10, 5000 + k)
        for i in (300 + 2 * k, 301 + 2 * k):
            rows.append((i, f"{_words(rnd.randint(1, 90), i)} {passage} {_words(rnd.randint(1, 90), 9000 + i)}"))
            planted.append(i)
    line = _words(9, 42)
    rows += [(600 + i, f"{line}\n{_words(80, 7000 + i)}") for i in range(50)]  # a common short line
    shorter = _words(30, 43)
    rows += [(700 + i, f"{_words(30, 7500 + i)} {shorter} {_words(40, 7600 + i)}") for i in range(9)]
    found = content_chunks.passages(_docs(spark, rows)).collect()
    assert {r.doc_id for r in found} <= set(planted)
    assert len({r.doc_id for r in found}) >= 0.96 * len(planted)
    texts = dict(rows)
    for r in found:
        assert texts[r.doc_id][r.start : r.end] in texts[r.doc_id ^ 1]
        assert r.first_doc_id == r.doc_id & ~1 and r.first == (r.doc_id == r.first_doc_id)
        assert r.n_words >= content_chunks.MIN_WORDS


def test_cleaning_leaves_one_copy(spark):
    text = _words(300, 8)
    rows = [(1, text), (2, text), (3, "new start " + text), (4, _words(50, 9)), (5, None)]
    docs = _docs(spark, rows)
    out = {r.doc_id: r.text for r in content_chunks.cleaned(docs, content_chunks.passages(docs)).collect()}
    assert out[1] == text and out[2] == "" and out[4] == rows[3][1] and out[5] is None
    assert len(out[3]) < 200


def test_odd_rows(odd):
    found = content_chunks.passages(odd).collect()
    assert {r.doc_id for r in found} == {6, 7}  # rows of one id do not repeat each other
    assert content_chunks.passages(odd.where("false")).count() == 0


def test_every_passage_over_fifty_words_is_found_at_its_bounds(spark):
    rows, want = [], set()
    for k in range(300):  # short words: such passages hold few whole chunks, or none
        rnd = random.Random(k)
        passage = " ".join("".join(rnd.choices("abcdefghij", k=rnd.randint(1, 3))) for _ in range(51 + k % 5))
        for i in (2 * k, 2 * k + 1):
            before = f"{_words(rnd.randint(1, 60), 20_000 + i)} X{i}"
            text = f"{before} {passage} Y{i} {_words(rnd.randint(1, 60), 30_000 + i)}"
            rows.append((i, text))
            want.add((i, len(before) + 1, len(before) + 1 + len(passage), 51 + k % 5, i & ~1))
    for i in range(40):  # fifty words are none; capitals and blanks count
        rows += [(1000 + 2 * i, _words(50, i) + f" a{i}"), (1001 + 2 * i, f"b{i} " + _words(50, i))]
        rows += [(2000 + 2 * i, _words(55, 500 + i)), (2001 + 2 * i, _words(27, 500 + i) + "  " + _words(55, 500 + i).upper())]
    found = content_chunks.passages(_docs(spark, rows)).collect()
    assert {(r.doc_id, r.start, r.end, r.n_words, r.first_doc_id) for r in found} == want
    assert len(found) == len(want) and all(r.n_chunks >= 1 for r in found)
