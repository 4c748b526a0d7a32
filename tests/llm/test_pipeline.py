"""The stages on a small table against plain Python, each on what the one before kept."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from martworks.llm import language_id, packing, pii


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        tables.append(docs)
    return tables


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_of_documents(stages):
    for table in stages[1:-1]:
        assert table.columns == stages[0].columns


def test_language_stage_keeps_what_the_model_accepts(stages):
    model = language_id.fit(stages[0])
    want = {r.doc_id for r in language_id.predict(stages[0], model).where("accepted").collect()}
    assert set(_texts(stages[1])) == want
    assert len(want) > 0.98 * stages[0].count()


def test_one_of_each_group_stays(stages):
    before = _texts(stages[1])
    groups = brute.groups(list(before.items()), corpus_pipeline.NEAR_PERCENT)
    assert _texts(stages[2]) == {i: before[i] for i, (_, least) in groups.items() if i == least}
    assert len(_texts(stages[2])) < len(before)


def test_near_stage_drops_pairs_from_four_fifths(spark, sf_dir):
    rows, want = [], []
    for k in range(40):  # the last 9 to 28 of 200 words differ
        words, tail = [f"w{k}x{i}" for i in range(200)], 9 + k % 20
        a, b = " ".join(words), " ".join(words[:-tail] + [f"t{k}x{i}" for i in range(tail)])
        rows += [(2 * k, a), (2 * k + 1, b)]
        x, y = brute.shingles(a), brute.shingles(b)
        near = 100 * len(x & y) >= 80 * len(x | y)
        want += [2 * k] if near else [2 * k, 2 * k + 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert sorted(_texts(kept)) == want
    assert len(brute.groups(rows, 80)) - len({c for _, c in brute.groups(rows, 80).values()}) == 80 - len(want)
    assert any(80 <= 100 * s < 85 for s in (
        len(brute.shingles(rows[i][1]) & brute.shingles(rows[i + 1][1]))
        / len(brute.shingles(rows[i][1]) | brute.shingles(rows[i + 1][1])) for i in range(0, 80, 2)
    ))


def test_personal_data_goes(stages):
    before, after = _texts(stages[2]), _texts(stages[3])
    assert after == {i: pii.redacted_text(t) for i, t in before.items()}
    assert not any(brute.base_spans(t) for t in after.values())
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_mixture_has_all_rows(stages):
    assert sorted(stages[4].collect()) == sorted(stages[3].collect())


def test_packing_holds_every_id_once(stages):
    t = Tokenizer.from_file(packing.default_tokenizer())
    texts = _texts(stages[4])
    lengths = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in texts.items()}
    seen = {i: np.zeros(n, int) for i, n in lengths.items()}
    for r in stages[5].collect():
        seen[r.doc_id][r.start : r.start + r.length] += 1
    assert set(seen) == set(lengths) and all((x == 1).all() for x in seen.values())


def test_run_equals_its_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    keys = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(got.select(*keys).collect()) == sorted(stages[-1].select(*keys).collect())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, odd, sf_dir, name, stage):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", "kept", "row", "unit", "score")
    got = stage(spark, docs, sf_dir).collect()
    if name == "language_id":
        assert {r.doc_id for r in got}.isdisjoint({1, 2, 3, 8})
    elif name == "near_duplicates":
        ids = [r.doc_id for r in got]
        assert sorted(map(str, ids)) == sorted(map(str, (1, 2, 3, 4, 6, 8, 9, None, 11, 12, 13)))
    elif name == "packing":
        assert {r.doc_id for r in got} == {r.doc_id for r in docs.collect()}
    else:
        assert len(got) == docs.count()
    assert stage(spark, docs.where("false"), sf_dir).count() == 0
