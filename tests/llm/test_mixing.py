from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from martworks.llm import mixing


def _order(rows):
    return sorted(rows, key=lambda r: (r.mix_slot, r.mix_order))


def _lags(slots, weights, until):
    """The largest distance of any source from its weight after any of the first slots."""
    total, done, worst = sum(weights.values()), Counter(), 0
    for t, s in enumerate(slots[:until], 1):
        done[s] += 1
        worst = max(worst, *(abs(done[x] - t * w / total) for x, w in weights.items()))
    return worst


def _edf(blocks, weights):
    """Earliest deadline first, slot by slot: the source of each slot. Releases and deadlines
    are counted in whole slots, as long as no source is used up."""
    total, names = sum(weights.values()), sorted(weights)
    done, out = Counter(), []
    for t in range(sum(blocks.values())):
        w = {s: weights[s] / total for s in names}
        ready = [s for s in names if done[s] / w[s] < t + 1 - 1e-9]
        pick = min(ready, key=lambda s: ((done[s] + 1) / w[s], s))
        done[pick] += 1
        out.append(pick)
        if done[pick] == blocks[pick]:
            return out
    return out


def _schedule(spark, blocks, weights):
    left = spark.createDataFrame(list(blocks.items()), "source string, blocks long")
    right = mixing.shares(spark.createDataFrame(list(weights.items()), "source string, weight double"))
    rows = sorted(mixing.schedule(left, right).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(sum(blocks.values())))
    seen = Counter()
    for r in rows:  # blocks of a source follow each other
        assert r.block == seen[r.source]
        seen[r.source] += 1
    assert seen == Counter(blocks)
    return [r.source for r in rows]


@pytest.mark.parametrize("n", [1, 2, 6, 60, 300])
def test_no_source_strays_a_block(spark, n):
    rnd = random.Random(n)
    weights = {f"s{i:03}": rnd.choice([rnd.random(), 0.01, 5.0]) for i in range(n)}
    total, slots = sum(weights.values()), 1500
    blocks = {s: int(slots * w / total) + 2 for s, w in weights.items()}
    got = _schedule(spark, blocks, weights)
    want = _edf(blocks, weights)
    assert got[: len(want)] == want  # up to the first source that is used up
    assert _lags(got, weights, len(want)) < 1


def test_weights_that_strayed_before(spark):
    weights = {f"s{i}": w for i, w in enumerate((0.623, 0.962, 0.023, 0.933, 0.017, 0.993))}
    total = sum(weights.values())
    got = _schedule(spark, {s: int(500 * w / total) + 2 for s, w in weights.items()}, weights)
    assert _lags(got, weights, 400) < 1


def test_a_source_that_is_used_up_leaves_its_share(spark):
    weights = {"a": 3.0, "b": 1.0, "c": 1.0}
    got = _schedule(spark, {"a": 6, "b": 40, "c": 40}, weights)
    last = max(i for i, s in enumerate(got) if s == "a")
    assert last <= 10
    assert _lags(got[last + 1 :], {"b": 1.0, "c": 1.0}, 60) < 2  # each less than one off at either end


def test_weights_without_sense(spark):
    for odd in ([None] * 3, [0.0] * 3, [-1.0, float("nan"), None]):
        got = _schedule(spark, {"a": 5, "b": 5, None: 5}, dict(zip(("a", "b", None), odd)))
        assert _lags([str(s) for s in got], {"a": 1, "b": 1, "None": 1}, 15) < 1


def test_whole_table(documents):
    got = mixing.mixed(documents, block_words=2000).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in documents.collect())
    text = {r.doc_id: r.text for r in documents.collect()}
    assert all(text[r.doc_id] == r.text and r.mix_source == r.source for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.mix_source].append(r)
    words = {}
    for source, rows in by.items():  # blocks follow each other and begin at their words
        at = 0
        for r in _order(rows):
            assert r.mix_block == at // 2000 and r.mix_order == at % 2000
            at += r.text.count(" ") + r.text.count("\n") + 1
        words[source] = at
    slots = defaultdict(set)
    for r in got:
        slots[r.mix_slot].add((r.mix_source, r.mix_block))
    assert all(len(x) == 1 for x in slots.values())
    weights = {s: n**mixing.TEMPERATURE for s, n in words.items()}
    blocks = {s: -(-n // 2000) for s, n in words.items()}
    want = _edf(blocks, weights)
    assert all(want[k] == next(iter(slots[k]))[0] for k in range(len(want)) if k in slots)


def test_target_weights_hold(spark):
    rows = [(i, "w", "big" if i % 3 else "small") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("big", 0.5), ("small", 0.5)], "source string, weight double")
    got = _order(mixing.mixed(docs, weights, block_words=1).collect())
    assert len(got) == 3000 and len({r.mix_slot for r in got}) == 3000
    assert _lags([r.source for r in got], {"big": 1.0, "small": 1.0}, 1990) < 1


def test_sources_without_a_weight_have_the_smallest(spark):
    docs = spark.createDataFrame([(i, "w", f"s{i % 5}") for i in range(500)], "doc_id long, text string, source string")
    given = spark.createDataFrame([("s0", 2.0), ("s1", 1.0)], "source string, weight double")
    got = _order(mixing.mixed(docs, given, block_words=1).collect())
    weights = {"s0": 2.0, "s1": 1.0, "s2": 1.0, "s3": 1.0, "s4": 1.0}
    assert _lags([r.source for r in got], weights, 290) < 1


def test_long_corpora_have_longer_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 50)
    docs = spark.createDataFrame([(i, "a b", f"s{i % 9}") for i in range(900)], "doc_id long, text string, source string")
    got = mixing.mixed(docs, block_words=1).collect()
    assert len(got) == 900 and len({(r.source, r.mix_block) for r in got}) <= 50 + 9


def test_odd_rows(odd, spark):
    got = mixing.mixed(odd)
    assert got.columns[: len(odd.columns)] == odd.columns
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(map(str, (r.doc_id for r in odd.collect())))
    assert mixing.mixed(odd.where("false")).count() == 0
    clash = odd.withColumn("mix_slot", F.lit("x")).withColumn("parts", F.lit(1)).withColumn("h", F.lit(1))
    assert mixing.mixed(clash).where("mix_slot >= 0").count() == odd.count()
    few = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    assert mixing.mixed(odd, few).count() == odd.count()
