from __future__ import annotations

import math
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from martworks.llm import common, neural_lm


def _base(rows):
    """{doc_id: (n_tokens, n_known, base)} and N, from (doc_id, text, learn)."""
    tokens = {i: [*brute.WORD.findall(brute.lowered(t or "")), None] for i, t, _ in rows}
    counts = Counter(w for i, _, learn in rows if learn for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    out = {
        i: (len(ws), sum(counts[w] > 0 for w in ws), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in tokens.items()
    }
    return out, n


@pytest.fixture(scope="module")
def scores(documents):
    learn = common.crc_mod(F.col("doc_id"), 7) != 2
    return neural_lm.scored(documents, learn).collect()


def test_base_scores(documents, scores):
    learn = {r.doc_id: r.learn for r in scores}
    want, n = _base([(r.doc_id, r.text, learn[r.doc_id]) for r in documents.collect()])
    assert len(scores) == len(want)
    for r in scores:
        assert (r.n_tokens, r.n_known, r.train_tokens) == (*want[r.doc_id][:2], n)
        assert math.isclose(r.base_score, want[r.doc_id][2], rel_tol=1e-9)
    assert 0.08 < sum(not r.learn for r in scores) / len(scores) < 0.22


def test_better_than_counts_on_held_out_texts(scores):
    held = [r for r in scores if not r.learn]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in scores)


def test_distribution_is_normalised():
    rnd = np.random.default_rng(3)
    counts = rnd.integers(1, 50, neural_lm.OUTPUTS).astype(float)
    model = neural_lm.start(counts)
    ids = rnd.integers(neural_lm.FIRST_WORD, neural_lm.OUTPUTS, 5000)
    model = neural_lm.train(model, ids, np.array([0, 2500]), counts, 0)
    one, two, z = model.tables()
    for h1, h2 in ((0, 0), (50, 70), (900, 0)):
        assert math.isclose(np.exp(one[h1] + two[h2] - z[h1, h2]).sum(), 1, rel_tol=1e-6)


def test_training_learns_order():
    rnd = np.random.default_rng(4)
    first = neural_lm.FIRST_WORD
    ids = np.empty(60_000, np.int64)
    ids[0::2] = first + rnd.integers(0, 20, 30_000)
    ids[1::2] = ids[0::2] + 100  # the second word of a pair follows from the first
    counts = np.bincount(ids, minlength=neural_lm.OUTPUTS).astype(float)
    model = neural_lm.start(counts)

    def loss(m):
        one, two, z = m.tables()
        h1, h2 = neural_lm._contexts(ids, np.array([0]))
        return -(one[h1, ids] + two[h2, ids] - z[h1, h2]).mean()

    before = loss(model)
    for turn in range(3):
        model = neural_lm.train(model, ids, np.array([0]), counts, turn)
    assert loss(model) < before - 0.5


def test_classes_share_their_words():
    """Within each class the shares of its words, and of one unseen word, add up to one."""
    words, bands = {10: 7, 11: 6, 12: 1, 13: 1, 14: 1}, neural_lm.BANDS
    shares = np.zeros(bands)
    shares[2], shares[0] = -math.log10(13), -math.log10(4)
    vocab = neural_lm.Vocabulary(np.zeros(0, np.int64), np.zeros(0, np.int64), shares, np.zeros(neural_lm.OUTPUTS), 0, 0)
    hashes, c = np.array([*words, 99]), np.array([*words.values(), 0])
    place, share = vocab.encode(hashes, c)
    for p in set(place.tolist()):
        assert math.isclose((10 ** share[place == p]).sum(), 1)


def test_odd_rows(odd):
    learn = F.col("doc_id") != 11
    got = neural_lm.scored(odd, learn).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1
    assert by[13].n_tokens == 8 and by[13].n_known == 8
    assert by[6].n_tokens == 30_001
    assert not by[None].learn and by[11].n_known < by[11].n_tokens
    assert all(math.isfinite(r.score) for r in got)
    nothing = neural_lm.scored(odd, F.lit(False)).collect()
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in nothing)
    assert neural_lm.scored(odd.where("false"), learn).count() == 0
