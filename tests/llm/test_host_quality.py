from __future__ import annotations

import brute

from martworks.llm import host_quality


def test_measures_against_brute_force(documents):
    got = {r.doc_id: r for r in host_quality.measures(documents).collect()}
    for d in documents.collect():
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.measures(d.text), d.doc_id


def test_host_verdict(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, "few words", "bad") for i in range(40)]
    rows += [(200, good, "bad"), (201, "few", "small"), (202, good, "small"), (203, good, "small")]
    got = {r.doc_id: r for r in host_quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].kept and not got[100].kept
    assert not got[200].base_failed and not got[200].kept  # its host fails
    assert got[202].kept and 0 < got[202].host_rate < 0.5
    assert got[200].host_documents == 41 and got[200].host_failures == 40


def test_odd_rows(odd):
    got = host_quality.judged(odd).collect()
    assert len(got) == odd.count()
    want = {r[0]: brute.measures(r[1]) for r in brute.ODD}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.host_documents >= 1
    assert host_quality.judged(odd.where("false")).count() == 0
