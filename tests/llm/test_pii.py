from __future__ import annotations

import time

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martworks.llm import pii


def test_whole_table_against_brute_force(documents):
    got = {r.doc_id: r for r in pii.report(pii.find(documents)).collect()}
    hits = 0
    for d in documents.collect():
        spans, r = brute.base_spans(d.text), got[d.doc_id]
        assert r.base_sha256 == brute.span_digest(spans)
        for kind in pii.BASE:
            assert getattr(r, f"n_{kind}") == sum(s[0] == kind for s in spans)
        listed = [x for x in r.spans.split(",") if x]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(listed)
        hits += len(spans)
    assert hits > 0 and len(got) == documents.count()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+%_ 0123456789()é\n", max_size=80))
def test_patterns(text):
    assert [s[:3] for s in pii.spans_of(text) if s[4]] == brute.base_spans(text)


def test_added_kinds():
    text = "IBAN DE89 3704 0044 0532 0130 00, wrong DE88 3704 0044 0532 0130 00; amex card 378282246310005 and 378282246310005"
    kinds = [(s[0], text[s[1] : s[2]]) for s in pii.spans_of(text)]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in kinds
    assert sum(k == "iban" for k, _ in kinds) == 1
    assert ("card", "378282246310005") in kinds
    assert not pii.spans_of("code 378282246310005")


def test_odd_rows(odd):
    got = pii.report(pii.find(odd)).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[1].spans == by[2].spans == by[6].spans == ""
    assert by[1].base_sha256 == brute.span_digest([])
    assert (by[12].n_email, by[12].n_ip, by[12].n_card, by[12].n_phone) == (1, 1, 1, 1)
    assert pii.find(odd.where("false")).count() == 0


def test_redaction(odd):
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.schema == odd.schema
    by = {r.doc_id: r for r in out.collect()}
    assert by[12].text == "mail <EMAIL>, ip <IP> card <CARD> phone <PHONE>"
    assert by[12].n_chars == len(by[12].text) and by[1].text is None


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-_1@. ", max_size=60))
def test_addresses(text):
    assert [s[:3] for s in pii.spans_of(text) if s[0] in ("email", "ip")] == [
        s for s in brute.base_spans(text) if s[0] in ("email", "ip")
    ]


@pytest.mark.parametrize(
    "text",
    ["1" * 10**6, "1." * 500_000, "a" * 500_000 + "@" + "b" * 500_000, "a@" * 500_000, "+1(" * 300_000, "1 " * 500_000,
     "AB12 CDEF " * 100_000, "a@b." * 250_000],
)
def test_time_grows_with_the_text(text):
    began = time.process_time()
    pii.spans_of(text)
    assert time.process_time() - began < 5
