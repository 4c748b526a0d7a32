from __future__ import annotations

from pyspark.sql import functions as F

from martworks.llm import common, language_id, queries


def test_held_out_accuracy(spark, documents):
    got = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(documents.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out and lang is not null").collect()
    assert len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert sum(r.accepted for r in held) / len(held) > 0.99
    assert all(0 <= r.score <= 1 for r in held)


def test_only_learning_rows_and_text_count(documents):
    learn = common.crc_mod(F.col("doc_id"), 4) != 2
    model = language_id.fit(documents, learn)
    other = documents.withColumn("lang", F.when(learn, F.col("lang")).otherwise("xx"))
    assert language_id.fit(other, learn).languages == model.languages
    a = language_id.predict(documents, model).collect()
    b = language_id.predict(documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model).collect()
    assert sorted(a) == sorted(b)


def test_odd_rows(odd, documents):
    model = language_id.fit(documents)
    got = language_id.predict(odd, model).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3, 8):
        assert (by[i].lang_pred, by[i].score, by[i].accepted) == ("und", 0.0, False)
    assert by[11].lang_pred in ("en", "de", "fr", "es")
    assert language_id.predict(odd.where("false"), model).count() == 0
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}
    assert language_id.fit(odd.where("false")) is None
    kept = language_id.accepted_rows(odd, model)
    assert kept.columns == odd.columns
    accepted = sorted(str(r.doc_id) for r in got if r.accepted)
    assert sorted(str(r.doc_id) for r in kept.collect()) == accepted


def test_gibberish_is_rejected(spark, documents):
    model = language_id.fit(documents)
    rows = [(1, "zxqj kvwz qqxz jjkq wvxz " * 30), (2, "你好世界 " * 50)]
    got = language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert not any(r.accepted for r in got)
